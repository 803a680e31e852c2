"""A third of all rows on one key: results stay whole and the hot key is split."""

from __future__ import annotations

import shutil
from contextlib import contextmanager
from decimal import Decimal

import duckdb
import pytest
from compare import TABLES, connect, differences
from conftest import day
from pyspark.sql import functions as F

from tillmetrics import RETAIL
from tillmetrics.operators import calendar as cal
from tillmetrics.operators import clean
from tillmetrics.plans import views
from tillmetrics.session import prepare

N = 60_000
GUEST = -1

# Small tables stand for large ones: nothing is broadcast by size, and a
# partition of some kilobytes already counts as large.
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def as_if_large(spark):
    before = {name: spark.conf.get(name) for name in LARGE}
    for name, value in LARGE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def run(df):
    """Runs the plan once; returns its rows and the plan as adaptive execution left it."""
    collected = df.collect()
    return collected, df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def dims(spark):
    prepare(spark)
    customers = spark.range(3000).select(
        F.col("id").alias("customer_id"),
        F.concat(F.lit("c"), "id").alias("email"),
        F.when(F.col("id") % 2 == 0, F.lit("Spain")).otherwise(F.lit("France")).alias("region"),
        F.lit(day("2026-01-01")).alias("signup_date"),
    )
    products = spark.range(2000).select(
        F.col("id").alias("product_id"),
        F.lit("Books").alias("category"),
        F.concat(F.lit("p"), "id").alias("product_name"),
    )
    return customers, products


@pytest.fixture(scope="module")
def raw(spark):
    """A third of the lines buy one product, a third come from one customer, a ninth have none."""
    i = F.col("id")
    return spark.range(0, N, 1, 8).select(
        i.alias("raw_id"),
        i.alias("order_id"),
        F.lit("2026-01-05").alias("order_date"),
        F.when(i % 3 == 0, F.lit("c7"))
        .when(i % 9 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("c"), i % 3000))
        .alias("customer_email"),
        F.when(i % 3 == 1, F.lit("p11")).otherwise(F.concat(F.lit("p"), i % 2000)).alias("product_name"),
        F.lit("books").alias("category"),
        F.lit(1).alias("quantity"),
        F.lit(2).cast("decimal(10,2)").alias("unit_price"),
        F.lit(None).cast("decimal(4,3)").alias("discount"),
    )


def test_hot_lookup_keys_are_split(spark, raw, dims):
    with as_if_large(spark):
        labelled = clean.label_sales(raw, *dims, RETAIL.categories, GUEST)
        found, plan = run(labelled)
    assert plan.count("skew=true") == 2, plan
    assert len(found) == N
    for row in found:
        i = row["raw_id"]
        assert row["reject_reason"] is None
        assert row["product_id"] == (11 if i % 3 == 1 else i % 2000)
        assert row["customer_id"] == (7 if i % 3 == 0 else GUEST if i % 9 == 1 else i % 3000)


def test_hot_copies_collapse_before_the_shuffle(spark, raw, dims):
    """One row exported N times over."""
    copies = raw.withColumns(
        {"order_id": F.lit(1), "customer_email": F.lit("c7"), "product_name": F.lit("p11")}
    )
    with as_if_large(spark):
        labelled = clean.label_sales(copies, *dims, RETAIL.categories, GUEST)
        assert [tuple(r) for r in labelled.select("raw_id", "copies").collect()] == [(0, N)]
        report = clean.sales_report(labelled).first()
    assert (report["raw_rows"], report["duplicates_dropped"], report["clean_rows"]) == (N, N - 1, 1)


@pytest.fixture(scope="module")
def orders(spark):
    """One customer, product, day and order hold a third of the lines each."""
    i = F.col("id")
    return spark.range(0, N, 1, 8).select(
        i.alias("order_line_id"),
        F.when(i % 3 == 0, F.lit(0)).otherwise(i).alias("order_id"),
        F.when(i % 3 == 1, F.lit(7)).otherwise(i % 3000).alias("customer_id"),
        F.when(i % 3 == 2, F.lit(11)).otherwise(i % 2000).alias("product_id"),
        F.when(i % 3 == 0, F.lit(20260105)).otherwise(F.lit(20260101) + (i % 28).cast("int")).alias("date_id"),
        F.lit(1).cast("smallint").alias("quantity"),
        F.lit(2).cast("decimal(12,2)").alias("line_revenue"),
    )


def test_region_summary_with_a_hot_customer(spark, orders, dims):
    with as_if_large(spark):
        found, plan = run(views.region_summary(orders, dims[0]))
    assert "skew=true" in plan
    ids = range(N)
    customer = [7 if i % 3 == 1 else i % 3000 for i in ids]
    order = [0 if i % 3 == 0 else i for i in ids]
    for row in found:
        lines = [i for i in ids if (customer[i] % 2 == 0) == (row["region"] == "Spain")]
        assert row["customers"] == len({customer[i] for i in lines})
        assert row["orders"] == len({order[i] for i in lines})
        assert row["revenue"] == Decimal(2 * len(lines))


def test_hot_customer_is_one_row_before_the_cohort_join(spark, orders, dims):
    with as_if_large(spark):
        found = views.customer_order_counts(orders, dims[0]).collect()
    counts = {r["customer_id"]: r["n_orders"] for r in found}
    assert len(counts) == 3000
    assert counts[7] == N // 3 + len({i for i in range(N) if i % 3 == 2 and i % 3000 == 7})


def test_weekly_views_with_a_hot_product_and_day(spark, orders, dims):
    dates = cal.calendar(cal.day_range(spark, day("2026-01-01"), day("2026-01-31")))
    returns = orders.filter("order_line_id % 2 = 0").select(
        "order_line_id", "date_id", F.col("line_revenue").cast("decimal(10,2)").alias("refund_amount")
    )
    # one line with very many returns
    returns = returns.unionAll(returns.withColumn("order_line_id", F.lit(4)))
    with as_if_large(spark):
        weekly, plan = run(views.category_weekly(orders, dates, dims[1]))
        outcome = views.return_summary(orders, dims[1], returns).first()
        daily = views.daily_revenue(orders, dates, returns).collect()
    assert "skew=true" in plan
    assert sum(r["revenue"] for r in weekly) == Decimal(2 * N)
    assert (outcome["order_lines"], outcome["returned_lines"]) == (N, N // 2)
    assert outcome["refund_amount"] == Decimal(2 * N)
    assert sum(r["units"] for r in daily) == N
    assert sum(r["refunds"] for r in daily) == Decimal(2 * N)


GIVEN = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The given tables with a third of the lines copies of one, and a third of the orders
    from one customer and on one day; every part has the same name."""
    folder = tmp_path_factory.mktemp("skewed")
    for table in TABLES:
        shutil.copyfile(f"{GIVEN}/{table}.parquet", folder / f"{table}.parquet")
    lines, orders, parts = (f"'{GIVEN}/{t}.parquet'" for t in ("lineitem", "orders", "part"))
    con = duckdb.connect()
    con.sql(
        f"""copy (select * from {lines} union all select one.* from
            (select * from {lines} where l_returnflag = 'R' limit 1) one, range(3000))
            to '{folder}/lineitem.parquet'"""
    )
    con.sql(
        f"""copy (select * replace (if(o_orderkey % 3 = 0, 7, o_custkey) as o_custkey,
            if(o_orderkey % 3 = 1, timestamp '1997-01-01', o_orderdate) as o_orderdate)
            from {orders}) to '{folder}/orders.parquet'"""
    )
    con.sql(
        f"copy (select * replace ('red widget' as p_name) from {parts})"
        f" to '{folder}/part.parquet'"
    )
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "daily_revenue",
        "category_weekly",
        "region_summary",
        "customer_repeat_rate",
        "return_summary",
        "return_weekly",
        "clean_sales",
        "clean_returns",
        "sales_report",
        "returns_report",
        "pk_violations",
    ],
)
def test_queries_on_skewed_tables(spark, skewed, name):
    assert differences(spark, connect(skewed), skewed, name) == ""
