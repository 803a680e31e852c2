"""Every query of the metrics library against its SQL, on the smallest of the given folders."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import connect, differences  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tillmetrics.checks.catalog import QUERIES  # noqa: E402
from tillmetrics.checks.oracles import ORACLES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert differences(spark, duck, FOLDER, name) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries())


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["week_start", "category", "revenue", "pct_of_week"]
    assert found.count() > 0


def test_comparison_notices_a_wrong_cent(spark, duck, monkeypatch):
    sql = oracle_sql()["daily_refunds"].replace("/ 100 as refunds", "/ 100 + 0.01 as refunds")
    assert sql != oracle_sql()["daily_refunds"]
    monkeypatch.setattr("compare.oracle_sql", lambda: {"daily_refunds": sql})
    assert "only SQL" in differences(spark, duck, FOLDER, "daily_refunds")


@pytest.mark.parametrize("source", ["sales", "marketing", "returns"])
def test_report_accounts_for_every_raw_row(spark, source):
    report = queries()[f"{source}_report"](spark, FOLDER).first().asDict()
    fixed = report.pop("negative_refund_fixed", 0)
    assert report.pop("raw_rows") == sum(report.values())
    assert fixed <= report["clean_rows"]
