"""The seven reporting views and the aggregates they are made of.

Each is a function from star tables to a DataFrame. Facts are reduced before
they meet anything else wherever the result allows it, so the joins that follow
see one row per day, customer or line rather than whole facts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmetrics.functions.columns import month_start, percent, ratio
from tillmetrics.settings import UNKNOWN

Star = Mapping[str, DataFrame]


def _days(dates: DataFrame, *columns: str) -> DataFrame:
    # One row per calendar day (operators.calendar.MAX_DAYS), so a broadcast is safe.
    return F.broadcast(dates.select("date_id", *columns))


# --- daily revenue ------------------------------------------------------------------


def daily_refunds(returns: DataFrame) -> DataFrame:
    return returns.groupBy("date_id").agg(F.sum("refund_amount").alias("refunds"))


def daily_revenue(orders: DataFrame, dates: DataFrame, returns: DataFrame) -> DataFrame:
    """Orders, units and revenue per day that sold something; refunds on the day they came back."""
    sold = orders.groupBy("date_id").agg(
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units"),
        F.sum("line_revenue").alias("gross"),
    )
    refunds = F.coalesce("refunds", F.lit(0).cast("decimal(20,2)"))
    return (
        sold.join(_days(dates, "date", "day_name", "is_weekend"), "date_id")
        .join(daily_refunds(returns), "date_id", "left")
        .select(
            "date",
            "day_name",
            "is_weekend",
            "orders",
            "units",
            F.round("gross", 2).alias("gross_revenue"),
            F.round(refunds, 2).alias("refunds"),
            F.round(F.col("gross") - refunds, 2).alias("net_revenue"),
            ratio(F.col("gross"), F.col("orders")).alias("aov"),
        )
    )


# --- category share per week --------------------------------------------------------


def category_week_revenue(
    orders: DataFrame, dates: DataFrame, products: DataFrame, iso_year: bool = False
) -> DataFrame:
    """Revenue per (year, week, category); ``week_start`` is the first day the category sold.

    The year is the calendar year, which splits the ISO week across New Year.
    ``iso_year`` uses the year the ISO week belongs to instead.
    """
    year = F.extract(F.lit("YEAROFWEEK"), F.col("date")) if iso_year else F.col("year")
    return (
        orders.select("date_id", "product_id", "line_revenue")
        .join(_days(dates, "date", "year", "week_of_year"), "date_id")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy(year.alias("year"), "week_of_year", "category")
        .agg(F.min("date").alias("week_start"), F.sum("line_revenue").alias("revenue"))
    )


def category_week_shares(
    orders: DataFrame, dates: DataFrame, products: DataFrame, iso_year: bool = False
) -> DataFrame:
    """Category revenue with the category's share of its (year, week)."""
    week = Window.partitionBy("year", "week_of_year")  # one row per category
    whole = F.sum("revenue").over(week)
    return category_week_revenue(orders, dates, products, iso_year).withColumn(
        "pct_of_week", percent(F.col("revenue"), whole)
    )


def category_weekly(
    orders: DataFrame, dates: DataFrame, products: DataFrame, iso_year: bool = False
) -> DataFrame:
    """Category revenue per week and its share of that week."""
    return category_week_shares(orders, dates, products, iso_year).select(
        "week_start", "category", F.round("revenue", 2).alias("revenue"), "pct_of_week"
    )


# --- regions and cohorts --------------------------------------------------------------


def region_summary(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers who ordered, their orders and revenue per region.

    Lines are reduced to one row per customer and order, then per region and order, so orders
    of several customers count once. Customers are counted from their own ids, which each map
    task reduces to distinct ones: no row is multiplied for a second distinct count.
    """
    placed = customers.filter(F.col("region") != UNKNOWN).select("customer_id", "region")
    bought = (
        orders.groupBy("customer_id", "order_id")
        .agg(F.sum("line_revenue").alias("revenue"))
        .join(placed, "customer_id")
        .groupBy("region", "order_id")
        .agg(F.sum("revenue").alias("revenue"))
        .groupBy("region")
        .agg(F.count("order_id").alias("orders"), F.sum("revenue").alias("revenue"))
    )
    buyers = (
        placed.distinct()
        .join(orders.select("customer_id").distinct(), "customer_id", "left_semi")
        .groupBy("region")
        .agg(F.count("*").alias("customers"))
    )
    return bought.join(buyers, "region").select(
        "region",
        "customers",
        "orders",
        F.round("revenue", 2).alias("revenue"),
        ratio(F.col("revenue"), F.col("orders")).alias("aov"),
    )


def customer_order_counts(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders per customer with the month of signup; customers without orders count 0.

    Orders are counted before the join, so a customer with very many orders is
    already a single row there.
    """
    counts = (
        orders.select("customer_id", "order_id")
        .distinct()
        .groupBy("customer_id")
        .agg(F.count("*").alias("n_orders"))
    )
    return (
        customers.filter(F.col("region") != UNKNOWN)
        .select("customer_id", month_start(F.col("signup_date")).alias("cohort_month"))
        .join(counts, "customer_id", "left")
        .withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
    )


def customer_repeat_rate(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of each signup cohort that ordered at least twice."""
    return (
        customer_order_counts(orders, customers)
        .groupBy("cohort_month")
        .agg(
            F.count("*").alias("customers"),
            F.count_if(F.col("n_orders") >= 2).alias("repeat_customers"),
        )
        .withColumn("repeat_rate_pct", percent(F.col("repeat_customers"), F.col("customers")))
        .orderBy("cohort_month")
    )


# --- acquisition cost -----------------------------------------------------------------


def monthly_spend(spend: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        spend.join(_days(dates, "date"), "date_id")
        .groupBy(month_start(F.col("date")).alias("month"), "channel")
        .agg(F.sum("spend").alias("spend"))
    )


def monthly_new_customers(customers: DataFrame) -> DataFrame:
    return (
        customers.filter(F.col("acquisition_channel") != UNKNOWN)
        .groupBy(
            month_start(F.col("signup_date")).alias("month"),
            F.col("acquisition_channel").alias("channel"),
        )
        .agg(F.count("*").alias("new_customers"))
    )


def marketing_cost(spend: DataFrame, dates: DataFrame, customers: DataFrame) -> DataFrame:
    """Spend, new customers and cost per new customer by month and paid channel."""
    return (
        monthly_spend(spend, dates)
        .join(monthly_new_customers(customers), ["month", "channel"], "left")
        .select(
            "month",
            "channel",
            F.round("spend", 2).alias("spend"),
            F.coalesce("new_customers", F.lit(0)).alias("new_customers"),
            ratio(F.col("spend"), F.col("new_customers")).alias("cac"),
        )
        .orderBy("month", "channel")
    )


# --- returns ----------------------------------------------------------------------------


def line_outcomes(orders: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per order line with the returns booked on it.

    A left join of lines with returns, written as a single aggregation over both:
    one shuffle on the line id, partial sums before it, nothing to sort, and
    neither repeated line ids nor many returns of one line can multiply rows.
    ``copies`` is 1 as long as the line id is the key it should be.
    """
    none = F.lit(None)
    sold = orders.select(
        "order_line_id",
        "product_id",
        "date_id",
        F.lit(1).alias("line"),
        F.lit(0).alias("returned"),
        none.cast("decimal(10,2)").alias("refund_amount"),
    )
    back = returns.select(
        "order_line_id",
        none.cast("bigint").alias("product_id"),
        none.cast("int").alias("date_id"),
        F.lit(0).alias("line"),
        F.lit(1).alias("returned"),
        "refund_amount",
    )
    return (
        sold.unionByName(back)
        .groupBy("order_line_id")
        .agg(
            F.max("product_id").alias("product_id"),
            F.max("date_id").alias("date_id"),
            F.sum("line").alias("copies"),
            F.sum("returned").alias("returns"),
            F.sum("refund_amount").alias("refund"),
        )
        .filter(F.col("copies") > 0)
    )


def sold_weeks(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Per sold day, the first day anything sold in its (year, week).

    The minimum over all lines of a week equals the minimum over its sold days,
    so the window runs over calendar days and not over the fact.
    """
    week = Window.partitionBy("year", "week_of_year")
    return (
        orders.select("date_id")
        .distinct()
        .join(_days(dates, "date", "year", "week_of_year"), "date_id")
        .select("date_id", F.min("date").over(week).alias("week_start"))
    )


def order_weeks(orders: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Category and week of every order line."""
    return (
        orders.select("order_line_id", "product_id", "date_id")
        .join(F.broadcast(sold_weeks(orders, dates)), "date_id")  # at most one row per day
        .join(products.select("product_id", "category"), "product_id")
        .select("order_line_id", "category", "week_start")
    )


def outcomes_by_day(orders: DataFrame, products: DataFrame, returns: DataFrame) -> DataFrame:
    """Order lines, returned ones and refunds by category and day of the order.

    Both return views are sums of it, so it need be worked out only once for them.
    """
    return (
        line_outcomes(orders, returns)
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "date_id")
        .agg(
            F.count("*").alias("order_lines"),
            F.count_if(F.col("returns") > 0).alias("returned_lines"),
            F.sum(F.col("refund") * F.col("copies")).alias("refund"),
        )
    )


def return_weekly(
    orders: DataFrame, dates: DataFrame, products: DataFrame, returns: DataFrame
) -> DataFrame:
    """Share of order lines that came back, by category and week of the order."""
    return _return_weekly(outcomes_by_day(orders, products, returns), orders, dates)


def _return_weekly(outcomes: DataFrame, orders: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        outcomes.join(F.broadcast(sold_weeks(orders, dates)), "date_id")
        .groupBy("week_start", "category")
        .agg(
            F.sum("order_lines").alias("order_lines"),
            F.sum("returned_lines").alias("returned_lines"),
        )
        .withColumn("return_rate_pct", percent(F.col("returned_lines"), F.col("order_lines")))
    )


def return_summary(orders: DataFrame, products: DataFrame, returns: DataFrame) -> DataFrame:
    """Lifetime return rate and refunds by category."""
    return _return_summary(outcomes_by_day(orders, products, returns))


def _return_summary(outcomes: DataFrame) -> DataFrame:
    return (
        outcomes.groupBy("category")
        .agg(
            F.sum("order_lines").alias("order_lines"),
            F.sum("returned_lines").alias("returned_lines"),
            F.sum("refund").alias("refund"),
        )
        .select(
            "category",
            "order_lines",
            "returned_lines",
            percent(F.col("returned_lines"), F.col("order_lines")).alias("return_rate_pct"),
            F.round(F.coalesce("refund", F.lit(0)), 2).alias("refund_amount"),
        )
    )


def order_line_detail(orders: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Category, day and revenue of every order line."""
    return (
        orders.select("order_line_id", "product_id", "date_id", "line_revenue")
        .join(_days(dates, "date"), "date_id")
        .join(products.select("product_id", "category"), "product_id")
        .select("order_line_id", "category", "date", "line_revenue")
    )


def return_decision_cohort(
    orders: DataFrame, dates: DataFrame, products: DataFrame, days: DataFrame, lag_days: int
) -> DataFrame:
    """Order lines that turn ``lag_days`` old on one of ``days``; each line has one such day."""
    # One row per processed day: bounded like the calendar it comes from.
    deciding = F.broadcast(
        days.select(
            F.col("date").alias("decided_on"), F.date_sub("date", lag_days).alias("date")
        )
    )
    due = _days(dates, "date").join(deciding, "date")
    return (
        orders.select("order_line_id", "product_id", "date_id", "line_revenue")
        .join(F.broadcast(due), "date_id")
        .join(products.select("product_id", "category"), "product_id")
        .select("order_line_id", "category", "date", "line_revenue", "decided_on")
    )


# --- reading the views -------------------------------------------------------------------


def latest_days(daily: DataFrame, n: int = 30) -> DataFrame:
    """The most recent ``n`` days of daily revenue."""
    return (
        daily.select("date", "gross_revenue", "refunds", "net_revenue")
        .orderBy(F.desc("date"))
        .limit(n)
    )


def latest_costs(costs: DataFrame, channel: str, n: int = 5) -> DataFrame:
    """The most recent ``n`` months with a cost for one channel, oldest first."""
    known = costs.filter((F.col("channel") == channel) & F.col("cac").isNotNull())
    return known.select("month", "cac").orderBy(F.desc("month")).limit(n).orderBy("month")


def views(
    star: Star, keep: Callable[[str, DataFrame], DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The seven views over a star, by name.

    ``keep`` may write what several views share (under the name given) and read it back.
    """
    orders, returns, spend = (
        star["fact_orders"],
        star["fact_returns"],
        star["fact_marketing_spend"],
    )
    dates, products, customers = star["dim_date"], star["dim_products"], star["dim_customers"]
    outcomes = outcomes_by_day(orders, products, returns)
    if keep is not None:
        outcomes = keep("outcomes_by_day", outcomes)
    return {
        "vw_daily_revenue": daily_revenue(orders, dates, returns),
        "vw_category_weekly": category_weekly(orders, dates, products),
        "vw_region_summary": region_summary(orders, customers),
        "vw_customer_repeat_rate": customer_repeat_rate(orders, customers),
        "vw_marketing_cac_monthly": marketing_cost(spend, dates, customers),
        "vw_return_summary": _return_summary(outcomes),
        "vw_return_weekly": _return_weekly(outcomes, orders, dates),
    }


def publish_views(star: Star) -> list[str]:
    """(Re)registers tables and views for ``spark.sql``; safe to repeat."""
    relations = {**star, **views(star)}
    for name, frame in relations.items():
        frame.createOrReplaceTempView(name)
    return list(relations)
