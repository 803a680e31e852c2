"""Data-quality checks. Each returns counts, so a clean table gives zeros, not nothing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.settings import UNKNOWN
from tillmetrics.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES, UNIQUE_KEYS

Star = Mapping[str, DataFrame]


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def impossible_order(of: Callable[[str], Column] = F.col) -> Column:
    """A quantity, price or revenue that no order line has; `of` gives the column of a name."""
    return (of("quantity") <= 0) | (of("unit_price") <= 0) | (of("line_revenue") < 0)


def negative_refund(of: Callable[[str], Column] = F.col) -> Column:
    return of("refund_amount") < 0


def incomplete(name: str, of: Callable[[str], Column] = F.col) -> Column:
    """A NULL in any required column of a table."""
    required = [f.name for f in TABLES[name].fields if not f.nullable]
    return reduce(lambda a, b: a | b, [of(c).isNull() for c in required])


def bad_orders(orders: DataFrame) -> DataFrame:
    """Number of order lines with an impossible quantity, price or revenue."""
    return orders.agg(F.count_if(impossible_order()).alias("bad_rows"))


def bad_returns(returns: DataFrame) -> DataFrame:
    """Number of returns with a negative refund."""
    return returns.agg(F.count_if(negative_refund()).alias("bad_rows"))


def bad_facts(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """Facts that must not exist, per table."""
    return _stack(
        [
            bad_orders(orders).withColumn("relation", F.lit("fact_orders")),
            bad_returns(returns).withColumn("relation", F.lit("fact_returns")),
        ]
    )


def days_without_calendar(days: DataFrame, dates: DataFrame) -> DataFrame:
    """Number of processed days the calendar does not hold."""
    return (
        days.select("date")
        .distinct()
        .join(F.broadcast(dates.select("date")), "date", "left_anti")  # one row per day
        .agg(F.count("*").alias("missing_days"))
    )


def key_violations(tables: Star) -> DataFrame:
    """Keys held by more than one row, per primary or unique key."""
    keys = [*PRIMARY_KEYS.items(), *UNIQUE_KEYS.items()]
    return _stack(
        [
            tables[name]
            .groupBy(*key)
            .agg(F.count("*").alias("n"))
            .agg(
                F.lit(name).alias("relation"),
                F.lit(",".join(key)).alias("key"),
                F.count_if(F.col("n") > 1).alias("violations"),
            )
            for name, key in keys
            if name in tables
        ]
    )


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child key values without a parent, with the number of rows that use them.

    Child rows are counted per key before the join, so a key used by a large part
    of the fact is one row in it. The parent is first reduced to the keys in use:
    with few of them (the returns of a day) that is a filter on its scan, where
    an anti-join alone would have to shuffle all of it.
    """
    used = child.groupBy(column).agg(F.count("*").alias("rows"))
    known = parent.select(column).join(used.select(column), column, "left_semi")
    return used.join(known, column, "left_anti")


def reference_violations(tables: Star) -> DataFrame:
    """Fact rows whose dimension (or order line) does not exist, per foreign key.

    Keys of all references meet in one union, tagged with the table they refer to and the
    reference they come from: one shuffle, however many references a fact has. Rows are counted
    per key before it, so a key used by a large part of a fact is one row for each task.
    """
    parents = {name: place for place, name in enumerate(dict.fromkeys(p for *_, p in FOREIGN_KEYS))}
    column_of = {parent: column for _, column, parent in FOREIGN_KEYS}

    def tagged(place: int, reference: int, column: str) -> Column:
        return F.struct(
            F.lit(place).alias("parent"),
            F.lit(reference).alias("reference"),
            F.col(column).cast("long").alias("key"),
        )

    own = -1  # the parent's own keys
    keys = [
        tables[name].select(tagged(place, own, column_of[name]).alias("x")).select("x.*")
        for name, place in parents.items()
    ]
    for child in dict.fromkeys(c for c, *_ in FOREIGN_KEYS):
        uses = [
            tagged(parents[parent], i, column)
            for i, (name, column, parent) in enumerate(FOREIGN_KEYS)
            if name == child
        ]
        keys.append(tables[child].select(F.explode(F.array(*uses)).alias("x")).select("x.*"))
    used = [F.count_if(F.col("reference") == i).alias(f"used_{i}") for i in range(len(FOREIGN_KEYS))]
    met = (
        _stack(keys)
        .groupBy("parent", "key")
        .agg(F.count_if(F.col("reference") == own).alias("known"), *used)
    )
    lost = (F.col("known") == 0) | F.col("key").isNull()
    totals = met.agg(
        *[F.sum(F.when(lost, F.col(f"used_{i}"))).alias(f"lost_{i}") for i in range(len(FOREIGN_KEYS))]
    )
    rows = [
        F.struct(
            F.lit(child).alias("relation"),
            F.lit(column).alias("key"),
            F.coalesce(f"lost_{i}", F.lit(0).cast("long")).alias("violations"),
        )
        for i, (child, column, _) in enumerate(FOREIGN_KEYS)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def null_violations(tables: Star) -> DataFrame:
    """NULLs per declared NOT NULL column; every table is read once."""
    per_table = []
    for name, frame in tables.items():
        required = [f.name for f in TABLES[name].fields if not f.nullable]
        counts = frame.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        per_table.append(
            counts.unpivot([], required, "column", "nulls").withColumn("relation", F.lit(name))
        )
    return _stack(per_table).select("relation", "column", "nulls")


def id_summary(tables: Star) -> DataFrame:
    """Rows, distinct ids and id range of each fact table."""
    summaries = []
    for name in ("fact_orders", "fact_marketing_spend", "fact_returns"):
        (key,) = PRIMARY_KEYS[name]
        summaries.append(
            tables[name]
            .groupBy(F.col(key).alias("id"))
            .agg(F.count("*").alias("n"))
            .agg(
                F.lit(name).alias("relation"),
                F.sum("n").alias("rows"),
                F.count("*").alias("distinct_ids"),
                F.min("id").alias("first_id"),
                F.max("id").alias("last_id"),
            )
        )
    return _stack(summaries)


# --- invariants of the views ----------------------------------------------------------


def net_revenue_mismatches(daily: DataFrame) -> DataFrame:
    off = F.abs(F.col("net_revenue") - (F.col("gross_revenue") - F.col("refunds"))) > 0.01
    return daily.agg(F.count("*").alias("days"), F.count_if(off).alias("mismatches"))


def week_share_mismatches(weekly: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Weeks whose category shares do not add up to about 100.

    Takes rows with ``year``, ``week_of_year`` and ``pct_of_week``: the week start
    of the view differs between categories and does not identify a week.
    """
    total = weekly.groupBy("year", "week_of_year").agg(F.sum("pct_of_week").alias("pct"))
    return total.agg(
        F.count("*").alias("weeks"),
        F.count_if(F.abs(F.col("pct") - 100) > tolerance).alias("mismatches"),
    )


def rates_out_of_bounds(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count("*").alias("categories"),
        F.count_if(~F.col("return_rate_pct").between(0, 100)).alias("out_of_bounds"),
    )


def unknown_regions(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count("*").alias("regions"),
        F.count_if(F.col("region") == UNKNOWN).alias("unknown_regions"),
    )
