"""Queries that surface trends a top-line total hides."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmetrics.functions.columns import percent, ratio
from tillmetrics.plans.views import category_week_revenue, line_outcomes


def days_of_weeks(first: dt.date, last: dt.date) -> list[int]:
    """Day ids of all weeks, by calendar year and ISO week, that have a day in a period.

    A calendar year's last days may share the week number of its first ones.
    """

    def week(day: dt.date) -> tuple[int, int]:
        return day.year, day.isocalendar().week

    def days(start: dt.date, end: dt.date) -> list[dt.date]:
        return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]

    wanted = {week(day) for day in days(first, last)}
    around = days(dt.date(first.year, 1, 1), dt.date(last.year, 12, 31))
    return [d.year * 10000 + d.month * 100 + d.day for d in around if week(d) in wanted]


def category_decline(
    orders: DataFrame, dates: DataFrame, products: DataFrame, end: dt.date, window_days: int
) -> DataFrame:
    """Each category against the total: first and last week of the trailing window.

    A category that sold nothing in one of the two weeks counts 0 there. A week counts if its
    first sold day lies in the window, so only days of weeks that have one there are read.
    """
    first = end - dt.timedelta(days=window_days)
    since = F.lit(first)
    week = Window.partitionBy("year", "week_of_year")
    weekly = (
        category_week_revenue(
            orders.filter(F.col("date_id").isin(days_of_weeks(first, end))), dates, products
        )
        .withColumn("total", F.sum("revenue").over(week))
        .withColumn("week", F.min("week_start").over(week))
        .filter((F.col("week") >= since) & (F.col("week") <= F.lit(end)))
    )
    # At most a category x weeks of the window from here on.
    edges = weekly.agg(F.min("week").alias("first_week"), F.max("week").alias("last_week"))
    joined = weekly.crossJoin(F.broadcast(edges))  # edges is a single row

    def at(edge: str, value: str) -> Column:
        return F.max(F.when(F.col("week") == F.col(edge), F.col(value)))

    totals = joined.groupBy("first_week", "last_week").agg(
        at("first_week", "total").alias("total_first"),
        at("last_week", "total").alias("total_last"),
    )
    zero = F.lit(0).cast("decimal(32,2)")
    return (
        joined.groupBy("category")
        .agg(
            F.coalesce(at("first_week", "revenue"), zero).alias("first_revenue"),
            F.coalesce(at("last_week", "revenue"), zero).alias("last_revenue"),
        )
        .crossJoin(F.broadcast(totals))  # a single row again
        .select(
            "category",
            "first_week",
            "last_week",
            "first_revenue",
            "last_revenue",
            percent(F.col("first_revenue"), F.col("total_first")).alias("first_share"),
            percent(F.col("last_revenue"), F.col("total_last")).alias("last_share"),
            "total_first",
            "total_last",
        )
    )


def cost_rise(costs: DataFrame, months: int = 5, min_months: int = 4) -> DataFrame:
    """Per channel, whether the last full month cost more than the first of the recent months.

    The newest month is taken as still running, so the one before it is compared
    with the oldest of the last ``months`` that have a cost.
    """
    newest = Window.partitionBy("channel").orderBy(F.desc("month"))
    recent = (
        costs.filter(F.col("cac").isNotNull())
        .withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= months)
    )
    last_full = F.col("rank") == 2
    return (
        recent.groupBy("channel")
        .agg(
            F.count("*").alias("months"),
            F.min("month").alias("first_month"),
            F.min_by("cac", "month").alias("first_cac"),
            F.max(F.when(last_full, F.col("month"))).alias("last_full_month"),
            F.max(F.when(last_full, F.col("cac"))).alias("last_cac"),
        )
        .filter(F.col("months") >= min_months)
        .select(
            "channel",
            "first_month",
            "first_cac",
            "last_full_month",
            "last_cac",
            (F.col("last_cac") > F.col("first_cac")).alias("rises"),
        )
    )


def return_peak(weekly_returns: DataFrame, threshold_pct: int) -> DataFrame:
    """Worst week of each category against a threshold."""
    return (
        weekly_returns.groupBy("category")
        .agg(F.max("return_rate_pct").alias("peak_rate_pct"))
        .withColumn("above_threshold", F.col("peak_rate_pct") > threshold_pct)
    )


def return_window(
    orders: DataFrame,
    products: DataFrame,
    returns: DataFrame,
    first: dt.date,
    last: dt.date,
) -> DataFrame:
    """Return rate per category for orders placed in a period, beside all other categories."""
    low, high = (day.year * 10000 + day.month * 100 + day.day for day in (first, last))
    placed = orders.filter(F.col("date_id").between(low, high))
    per_category = (
        line_outcomes(placed, returns)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.count("*").alias("order_lines"),
            F.count_if(F.col("returns") > 0).alias("returned_lines"),
        )
    )
    totals = per_category.agg(
        F.sum("order_lines").alias("all_lines"), F.sum("returned_lines").alias("all_returned")
    )
    return per_category.crossJoin(F.broadcast(totals)).select(  # totals is a single row
        "category",
        "order_lines",
        "returned_lines",
        percent(F.col("returned_lines"), F.col("order_lines")).alias("return_rate_pct"),
        percent(
            F.col("all_returned") - F.col("returned_lines"),
            F.col("all_lines") - F.col("order_lines"),
        ).alias("others_rate_pct"),
    )


def calendar_effect(
    orders: DataFrame,
    dates: DataFrame,
    first: dt.date,
    last: dt.date,
    holiday_from: tuple[int, int] = (11, 20),
    holiday_to: tuple[int, int] = (12, 31),
) -> DataFrame:
    """Mean orders per day: weekend against weekday, holiday season against the rest."""
    per_day = orders.groupBy("date_id").agg(F.countDistinct("order_id").alias("orders"))
    month_day = F.col("month") * 100 + F.col("day")
    holiday = month_day.between(
        holiday_from[0] * 100 + holiday_from[1], holiday_to[0] * 100 + holiday_to[1]
    )
    days = (
        dates.filter(F.col("date").between(F.lit(first), F.lit(last)))
        .join(per_day, "date_id", "left")
        .select(
            F.explode(
                F.create_map(F.lit("weekend"), "is_weekend", F.lit("holiday"), holiday)
            ).alias("effect", "applies"),
            F.coalesce("orders", F.lit(0)).alias("orders"),
        )
    )
    return (
        days.groupBy("effect", "applies")
        .agg(F.count("*").alias("days"), F.sum("orders").alias("orders"))
        .select("effect", "applies", "days", ratio(
            F.col("orders").cast("decimal(20,0)"), F.col("days")
        ).alias("avg_orders"))
    )
