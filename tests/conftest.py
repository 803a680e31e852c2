from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

from tillmetrics.sources import schemas as S  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows given as dicts, in the declared schema; missing columns are NULL."""

    def build(schema, rows, extra=()):
        fields = [*schema.fields, *extra]
        kind = S.T.StructType([S.T.StructField(f.name, f.dataType, True) for f in fields])
        money = S.T.DecimalType

        def cell(field, row):
            value = row.get(field.name)
            if isinstance(field.dataType, money) and value is not None:
                return Decimal(str(value))
            return value

        return spark.createDataFrame([[cell(f, r) for f in fields] for r in rows], kind)

    return build


@pytest.fixture(scope="session")
def rows():
    """Collected rows as plain tuples, sorted."""

    def collect(df, *columns):
        return ordered(tuple(r) for r in (df.select(*columns) if columns else df).collect())

    return collect


def ordered(rows):
    return sorted(rows, key=lambda row: [str(value) for value in row])


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)
