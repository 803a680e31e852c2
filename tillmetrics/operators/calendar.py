"""Calendar dimension and day arithmetic.

A calendar holds one row per day, so its size is bounded by the time span and
not by the data; ``MAX_DAYS`` enforces the bound. That is what allows the joins
to ask for a broadcast of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmetrics.functions.columns import date_key

MAX_DAYS = 200_000


def days_between(bounds: DataFrame) -> DataFrame:
    """One row per day of the one-row frame ``(first, last)``; none when it is empty or reversed."""
    span = F.datediff("last", "first")
    usable = bounds.filter(F.col("first") <= F.col("last")).withColumn(
        "first",
        F.when(span < MAX_DAYS, F.col("first")).otherwise(
            F.raise_error(F.lit(f"calendar longer than {MAX_DAYS} days"))
        ),
    )
    return usable.select(F.explode(F.sequence("first", "last")).alias("date"))


def day_range(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return days_between(bounds)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of each ``date``; Monday is day 0 and weeks are ISO weeks."""
    day = F.col("date")
    return days.select(
        date_key(day).alias("date_id"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def missing_days(loaded: DataFrame, today: dt.date, since: dt.date | None = None) -> DataFrame:
    """Every fully elapsed day after the last loaded one, today excluded.

    ``since`` is the first day to take when nothing is loaded yet.
    """
    first = F.date_add(F.max("date"), 1)
    if since is not None:
        first = F.coalesce(first, F.lit(since).cast("date"))
    bounds = loaded.agg(
        first.alias("first"), F.lit(today - dt.timedelta(days=1)).cast("date").alias("last")
    )
    return days_between(bounds)


def append_days(loaded: DataFrame, days: DataFrame) -> DataFrame:
    """The calendar with those of ``days`` it does not hold yet."""
    new = days.distinct().join(loaded.select("date"), "date", "left_anti")
    return loaded.unionByName(calendar(new))


def eligible_on(customers: DataFrame, day: dt.date, guest_email: str) -> DataFrame:
    """Customers signed up by ``day``, the guest row excluded."""
    return customers.filter(
        (F.col("signup_date") <= F.lit(day).cast("date")) & (F.col("email") != guest_email)
    )


def eligible_daily(customers: DataFrame, dates: DataFrame, guest_email: str) -> DataFrame:
    """How many customers were eligible on every day of the calendar.

    Signups are counted per day first; the running total then runs over one row
    per day, never over customers x days. Signups before the calendar count from
    its first day on.
    """
    per_day = (
        customers.filter(F.col("email") != guest_email)
        .groupBy(F.col("signup_date").alias("date"))
        .agg(F.count("*").alias("signups"))
    )
    timeline = (
        dates.select("date", F.lit(True).alias("listed"))
        .join(per_day, "date", "full")
        .withColumn(
            "eligible",
            F.coalesce(F.sum("signups").over(Window.orderBy("date")), F.lit(0)),
        )
    )
    return timeline.filter("listed").select("date", "eligible")
