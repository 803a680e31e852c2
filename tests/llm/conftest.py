from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) pairs or whole rows."""

    def build(rows, schema=SCHEMA):
        if schema == SCHEMA:
            rows = [r if len(r) == 5 else (*r, "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def folder(spark, tmp_path_factory):
    """A folder of tables like the given ones, from DataFrames by name."""

    def build(**tables):
        path = tmp_path_factory.mktemp("tables")
        for name, frame in tables.items():
            frame.write.parquet(f"{path}/{name}.parquet")
        return str(path)

    return build


@pytest.fixture
def dice():
    return random.Random(20)


def prose(dice, count, vocabulary=400):
    """Words that repeat about as much as those of a language do."""
    return " ".join(f"w{int(vocabulary * dice.random() ** 2)}" for _ in range(count))
