"""What large runs depend on: few and narrow shuffles, none kept, nothing worked out twice."""

from __future__ import annotations

import datetime as dt
import re
import time

import pytest
from pyspark.sql import functions as F
from test_skew import as_if_large

from tillmetrics import RETAIL
from tillmetrics.checks.catalog import QUERIES
from tillmetrics.operators import clean, lookup
from tillmetrics.plans import views
from tillmetrics.session import prepare
from tillmetrics.sources.export import checksums, export_csv, read_csv, unchanged, watched
from tillmetrics.sources.market import GIVEN, Market

D = "cast({} as decimal(10,2))"


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    """Small tables of the given shapes; every seventh order comes twice, and so does every 50th line."""
    prepare(spark)
    root = str(tmp_path_factory.mktemp("given"))
    i = "cast(id as int)"
    made = {
        "region": (3, f"{i} as r_regionkey", "concat('R', id) as r_name"),
        "nation": (6, f"{i} as n_nationkey", "cast(id % 3 as int) as n_regionkey"),
        "customer": (
            40,
            "id as c_custkey",
            "concat('Name ', id) as c_name",
            "cast(id % 6 as int) as c_nationkey",
            "element_at(array('FURNITURE', 'BUILDING'), cast(id % 2 + 1 as int)) as c_mktsegment",
        ),
        "supplier": (5, "id as s_suppkey", "concat('S', id) as s_name", "cast(id % 6 as int) as s_nationkey"),
        "part": (
            30,
            "id as p_partkey",
            "concat('part ', id % 20) as p_name",
            "element_at(array('SMALL', 'PROMO', 'LARGE'), cast(id % 3 + 1 as int)) as p_type",
            "900 + id / 10D as p_retailprice",
        ),
        "orders": (
            420,
            "id - id div 7 as o_orderkey",
            "(id - id div 7) % 40 as o_custkey",
            "100D + id - id div 7 as o_totalprice",
            "cast(date_add(date'1998-01-01', cast((id - id div 7) % 60 as int)) as timestamp_ntz) as o_orderdate",
        ),
        "lineitem": (
            1500,
            "(id - id div 50) % 360 as l_orderkey",
            "(id - id div 50) * 7 % 30 as l_partkey",
            "id % 1 as l_suppkey",
            "cast((id - id div 50) div 360 as int) as l_linenumber",
            "1D + (id - id div 50) % 9 as l_quantity",
            "1000D + (id - id div 50) as l_extendedprice",
            "((id - id div 50) % 10) / 100D as l_discount",
            "if((id - id div 50) % 3 = 0, 'R', 'N') as l_returnflag",
        ),
    }
    assert set(made) == set(GIVEN)
    for name, (n, *columns) in made.items():
        spark.range(0, n, 1, 3).selectExpr(*columns).write.parquet(f"{root}/{name}.parquet")
    return root


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (blocks.apply(i).getName() for i in range(blocks.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffles_go_with_their_query(spark):
    prepare(spark)
    before = shuffle_files(spark)
    assert spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count().count() == 1000
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_a_second_append_changes_nothing(spark, given):
    """Contents are the same, and no step leaves its shuffles behind."""
    before = shuffle_files(spark)
    found = QUERIES["incremental_idempotent"](spark, given).collect()
    assert len(found) == 6 and all(r["same"] and r["days_again"] == 0 for r in found)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_lines_are_shuffled_without_their_id(spark, given):
    m = Market(spark, given)
    for frame in (m.raw_sales_export, m.orders, m.returns, m.raw_returns_export):
        joins = frame._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
        assert "line_hash" in joins and "line_id" not in joins and "returned" not in joins.split("Filter")[0]


def test_due_returns_are_those_of_the_full_export(spark, given, rows):
    m = Market(spark, given)
    lag = m.settings.return_lag_days
    days = spark.createDataFrame([(dt.date(1998, 2, 1 + i),) for i in range(4)], "date date")
    booked = m.orders.filter("order_line_id % 3 > 0")  # ids come twice, as lines do
    headers = m.headers.join(days.select(F.date_sub("date", lag).alias("order_day")), "order_day", "left_semi")
    due = m.returns_due(headers, booked)
    full = m.raw_returns_export.join(days.withColumnRenamed("date", "exported_on"), "exported_on", "left_semi")
    full = full.join(booked, "order_line_id", "left_semi")
    assert due.columns == m.raw_returns_export.columns
    assert rows(due) == rows(full, *due.columns) and 20 < len(rows(full)) < m.raw_returns_export.count()


def test_returns_of_few_orders_shuffle_no_lines(spark, given, tmp_path):
    m = Market(spark, given)
    m.headers.limit(3).write.parquet(f"{tmp_path}/headers")
    headers = spark.read.schema(m.headers.schema).parquet(f"{tmp_path}/headers")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 8 << 10)
    try:
        plan = plan_of(m.returns_due(headers, m.orders))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [order_id" in plan, plan


def test_copies_meet_where_they_met_their_customer(spark):
    """Rows without an email are copies only of those that lack it alike; one shuffle of rows in all."""
    emails = [None, "", None, "", "c@x", "c@x", "C@x", "who@x", None, "z@x"]
    sales = spark.createDataFrame(
        [(i, 1 if i < 8 else 2, e) for i, e in enumerate(emails)], "raw_id bigint, order_id bigint, customer_email string"
    ).selectExpr(
        "*",
        "'2026-01-05' as order_date",
        "'p' as product_name",
        "if(raw_id in (1, 5), 'nothing', 'books') as category",
        "1 as quantity",
        f"{D.format(2)} as unit_price",
        "cast(null as decimal(4,3)) as discount",
    )
    customers = spark.createDataFrame([(7, "c@x"), (5, "c@x"), (9, "z@x")], "customer_id bigint, email string")
    products = spark.createDataFrame([(3, "Books", "p")], "product_id bigint, category string, product_name string")
    with as_if_large(spark):
        labelled = clean.label_sales(sales, customers, products, RETAIL.categories, -1)
        plan = plan_of(labelled)
        found = {r["raw_id"]: (r["customer_id"], r["copies"], r["reject_reason"]) for r in labelled.collect()}
        few = clean.label_sales(sales, customers, products, RETAIL.categories, -1, (), True)
        assert sorted(map(tuple, few.collect())) == sorted(map(tuple, labelled.collect()))
    assert found == {
        0: (-1, 2, None),
        1: (-1, 2, "unmatched_category"),
        4: (7, 2, None),
        6: (-1, 1, None),
        7: (-1, 1, None),
        8: (-1, 1, None),
        9: (9, 1, None),
    }
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    # rows to customers and to products; ids of each grouped and to the rows
    assert sorted(keys) == ["_key", "_key", "_key", "_key", "category", "email"], plan


def test_a_broadcast_is_measured(spark):
    names = spark.range(2000).selectExpr("'Books' as category", "concat('name ', id) as product_name", "id as product_id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for most, fits in (("1m", True), ("64k", False), (str(1 << 20), True), ("-1", False)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            assert lookup.fits_broadcast(lookup.product_ids(names)) == fits, most
            assert lookup.fits_broadcast(names.limit(0)) == (most != "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_watched_rows_have_the_checksums_of_their_files(spark, tmp_path, rows):
    some = spark.range(0, 3000, 1, 4).selectExpr(
        "id", "if(id % 5 = 0, null, concat('a\\\\', id, char(31))) as t", f"{D.format('id / 7 - 50')} as m",
        "cast(id as decimal(30,4)) as wide", "date_add(date'2020-01-01', cast(id as int)) as d",
    )
    relations = {"some": some, "grouped": some.groupBy("t").agg(F.sum("m").alias("m")), "none": some.limit(0)}
    kept, found = watched(relations)
    assert {n: f.columns for n, f in kept.items()} == {n: f.columns for n, f in relations.items()}
    written = export_csv(kept, str(tmp_path), compression="gzip")
    expected = checksums(relations)
    assert rows(found()) == rows(expected)
    assert rows(found(), "relation", "rows") == [("grouped", 2401), ("none", 0), ("some", 3000)]
    assert found().dtypes == expected.dtypes
    read = checksums({n: read_csv(spark, p, relations[n]) for n, p in written.items()})
    assert {same for _, same in rows(unchanged(found(), read))} == {True}
    changed = checksums({"some": some.withColumn("m", F.when(F.col("id") == 7, F.lit(1)).otherwise(F.col("m")))})
    assert rows(unchanged(found().filter("relation = 'some'"), changed)) == [("some", False)]


def test_checksums_are_sums_of_md5(spark, rows):
    import hashlib

    values = [(1, "x"), (2, None), (2, None), (-3, "")]
    a = b = 0
    for n, t in values:
        digest = hashlib.md5("\x1f".join([f"={n}", "~" if t is None else f"={t}"]).encode()).hexdigest()
        a, b = a + int(digest[:15], 16), b + int(digest[16:31], 16)
    found = checksums({"t": spark.createDataFrame(values, "a int, b string")})
    assert rows(found) == [("t", 4, str(a), str(b))]


def test_exported_files_are_read_once(spark, given):
    result = QUERIES["export_csv_roundtrip"](spark, given)
    plan = plan_of(result)
    assert "FileScan csv" not in plan and plan.count("FileScan parquet") <= 2
    found = result.collect()
    assert len(found) == 16 and all(r["same"] for r in found)
    held = {r["relation"]: r["rows"] for r in found}
    m = Market(spark, given)
    assert held["raw_sales_export"] == m.raw_sales_export.count() > held["fact_orders"] == m.orders.count()


def test_return_views_share_one_aggregate(spark, given, tmp_path, rows):
    star = Market(spark, given).star()
    kept = []

    def keep(name, frame):
        kept.append(name)
        frame.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{tmp_path}/{name}")

    shown = views.views(star, keep)
    assert kept == ["outcomes_by_day"]
    for name in ("vw_return_summary", "vw_return_weekly"):
        assert rows(shown[name]) == rows(views.views(star)[name]) != []
        assert shown[name].schema == views.views(star)[name].schema
    assert "order_line_id" not in plan_of(shown["vw_return_summary"])
