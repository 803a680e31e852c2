"""Every operator as a query over a folder of the given tables.

``QUERIES[name](spark, folder)`` gives a DataFrame whose columns are of simple
types only, so that it can be compared with the SQL in ``oracles``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.functions import columns as fn
from tillmetrics.operators import calendar as cal
from tillmetrics.operators import clean, lookup, quality
from tillmetrics.plans import findings, pipeline, views
from tillmetrics.session import prepare
from tillmetrics.sources.export import (
    CHECKSUMS,
    checksums,
    export_csv,
    read_csv,
    row_counts,
    unchanged,
    watched,
)
from tillmetrics.sources.files import read_file
from tillmetrics.sources.market import GUEST_ID, Market
from tillmetrics.sources.schemas import RAW_SALES, UNREADABLE
from tillmetrics.sources.warehouse import BATCH, Warehouse, shared_folder, stamp

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ELIGIBLE_DAY = dt.date(1998, 6, 30)
COST_CHANNEL = "MACHINERY"
APPENDED_DAYS = 14
# Columns of a sales file.
SALES_FILE = [f.name for f in RAW_SALES.fields if f.name not in ("raw_id", UNREADABLE, "loaded_at")]


def plain(frame: DataFrame) -> DataFrame:
    """Integers as bigint and decimals as double; everything else as it is."""

    def simple(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double")
        if isinstance(field.dataType, (T.ShortType, T.IntegerType)):
            return F.col(field.name).cast("bigint")
        return F.col(field.name)

    return frame.select(*[simple(f) for f in frame.schema.fields])


def query(build: Callable[[Market], DataFrame]) -> Callable[[Market], DataFrame]:
    """Registers a function of the market under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Market(prepare(spark), folder)))

    QUERIES[build.__name__] = run
    return build


# --- scans and loads ------------------------------------------------------------------


@query
def scan_raw_sales(m: Market) -> DataFrame:
    return m.raw_sales_export.drop("exported_on")


@query
def scan_raw_marketing(m: Market) -> DataFrame:
    return m.raw_marketing.drop("exported_on")


@query
def scan_raw_returns(m: Market) -> DataFrame:
    return m.raw_returns_export.drop("exported_on")


@query
def dim_customers(m: Market) -> DataFrame:
    return m.customers


@query
def dim_products(m: Market) -> DataFrame:
    return m.products


@query
def dim_date(m: Market) -> DataFrame:
    return m.dates


def _tables(m: Market) -> dict[str, DataFrame]:
    return {
        **m.star(),
        "raw_sales_export": m.raw_sales_export,
        "raw_marketing_spend": m.raw_marketing,
        "raw_returns": m.raw_returns_export,
    }


@query
def relation_row_counts(m: Market) -> DataFrame:
    return row_counts({**_tables(m), **views.views(m.star())})


@query
def export_csv_roundtrip(m: Market) -> DataFrame:
    # The views read the star several times over, so it is written once, and so is what views share.
    # All else is worked out on its way to the files, and its checksums with it.
    w = Warehouse(m.spark, shared_folder(m.spark, "star"))
    star = {name: w.stage(name, frame) for name, frame in m.star().items()}
    relations, exported = watched({**_tables(m), **star, **views.views(star, w.stage)})
    written = export_csv(relations, shared_folder(m.spark, "csv"), compression="gzip")
    # Written, so that the files are read once for both uses below.
    read = {name: read_csv(m.spark, path, relations[name]) for name, path in written.items()}
    found = w.stage("found", checksums(read))
    return found.select("relation", "rows").join(unchanged(exported(), found), "relation")


@query
def relation_checksums(m: Market) -> DataFrame:
    return checksums(m.star())


# --- cleaning -------------------------------------------------------------------------


@query
def csv_unreadable_records(m: Market) -> DataFrame:
    """Sales exported as text with discounts like 10% and names with line breaks, read and cleaned:
    records, those that can't be read, and what the readable ones hold."""
    sales = m.raw_sales_export
    text = {f: F.col(f).cast("string") for f in SALES_FILE if f in sales.columns}
    text["discount"] = F.when(
        F.col("raw_id") % 31 == 0, F.concat(text["discount"], F.lit("%"))
    ).otherwise(text["discount"])
    text["product_name"] = F.when(
        F.col("raw_id") % 37 == 0, F.concat("product_name", F.lit("\n"), "product_name")
    ).otherwise(F.col("product_name"))
    written = export_csv(
        {"sales": sales.select(*[text[c].alias(c) for c in SALES_FILE])},
        shared_folder(m.spark, "files"),
        compression="gzip",
    )
    w = Warehouse(m.spark, shared_folder(m.spark, "unreadable"))
    read = read_file(m.spark, "raw_sales_export", written["sales"])
    w.land("raw_sales_export", read.withColumn(BATCH, F.lit(dt.date(2000, 1, 1))), delivery="file")
    bad = F.col("unreadable").isNotNull()
    return w.raw()["raw_sales_export"].agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(bad).alias("unreadable"),
        F.sum(F.when(~bad, F.col("discount"))).alias("discounts"),
        F.sum(F.when(~bad, F.col("unit_price"))).alias("prices"),
    )


@query
def standardize_dates(m: Market) -> DataFrame:
    return m.raw_sales.select(
        "raw_id", "order_date", fn.parse_date(F.col("order_date")).alias("order_day")
    )


@query
def normalize_category(m: Market) -> DataFrame:
    return m.raw_sales.select(
        "raw_id",
        "category",
        fn.normalize(F.col("category"), m.settings.categories).alias("normalized"),
    )


@query
def normalize_channel(m: Market) -> DataFrame:
    return m.raw_marketing.select(
        "raw_id",
        "channel",
        fn.normalize(F.col("channel"), m.settings.channels).alias("normalized"),
    )


@query
def line_revenue(m: Market) -> DataFrame:
    return m.lines.select(
        "line_id",
        fn.line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount")).alias(
            "line_revenue"
        ),
    )


@query
def fix_negative_refunds(m: Market) -> DataFrame:
    refund = F.col("refund_amount")
    return m.raw_returns.select(
        "raw_id", fn.fixed_refund(refund).alias("refund_amount"), (refund < 0).alias("fixed")
    )


@query
def fill_reason(m: Market) -> DataFrame:
    return m.raw_returns.select("raw_id", fn.filled_reason(F.col("reason")).alias("reason"))


@query
def reject_unparseable_date(m: Market) -> DataFrame:
    sources = {
        "sales": (m.raw_sales, "order_date"),
        "marketing": (m.raw_marketing, "spend_date"),
        "returns": (m.raw_returns, "return_date"),
    }
    rejected = [
        clean.unparseable_dates(raw, column).select(
            F.lit(source).alias("source"), "raw_id", F.col(column).alias("date_text")
        )
        for source, (raw, column) in sources.items()
    ]
    return rejected[0].unionByName(rejected[1]).unionByName(rejected[2])


@query
def reject_invalid_quantity(m: Market) -> DataFrame:
    return clean.invalid_quantities(m.raw_sales).select("raw_id", "quantity")


@query
def reject_invalid_price(m: Market) -> DataFrame:
    return clean.invalid_prices(m.raw_sales).select("raw_id", "unit_price")


@query
def reject_unmatched_vocab(m: Market) -> DataFrame:
    sales = clean.unmatched_vocabulary(m.raw_sales, "category", m.settings.categories)
    spend = clean.unmatched_vocabulary(m.raw_marketing, "channel", m.settings.channels)
    return sales.select(
        F.lit("sales").alias("source"), "raw_id", F.col("category").alias("value")
    ).unionByName(
        spend.select(F.lit("marketing").alias("source"), "raw_id", F.col("channel").alias("value"))
    )


@query
def reject_unmatched_product(m: Market) -> DataFrame:
    return clean.unmatched_products(m.raw_sales, m.products, m.settings.categories).select(
        "raw_id", "category", "product_name"
    )


def _labelled_sales(m: Market) -> DataFrame:
    return clean.label_sales(
        m.raw_sales, m.customers, m.products, m.settings.categories, GUEST_ID
    )


def _labelled_marketing(m: Market) -> DataFrame:
    return clean.label_marketing(m.raw_marketing, m.settings.channels)


def _labelled_returns(m: Market) -> DataFrame:
    return clean.label_returns(m.raw_returns)


@query
def sales_reject_reason(m: Market) -> DataFrame:
    return _labelled_sales(m).select("raw_id", "reject_reason")


@query
def dedupe_sales(m: Market) -> DataFrame:
    return clean.dedupe_sales(m.raw_sales.drop("account_id", "exported_on"))


@query
def dedupe_marketing(m: Market) -> DataFrame:
    return clean.dedupe_marketing(m.raw_marketing.drop("exported_on"))


@query
def dedupe_returns(m: Market) -> DataFrame:
    return clean.dedupe_returns(m.raw_returns.drop("product_id", "exported_on"))


@query
def lookup_product(m: Market) -> DataFrame:
    known = m.raw_sales.withColumn(
        "category", fn.normalize(F.col("category"), m.settings.categories)
    )
    return lookup.lookup_product(known, m.products).select(
        "raw_id", "category", "product_name", "product_id"
    )


@query
def lookup_customer_guest(m: Market) -> DataFrame:
    return lookup.lookup_customer(m.raw_sales, m.customers, GUEST_ID).select(
        "raw_id", "customer_email", "customer_id"
    )


@query
def clean_sales(m: Market) -> DataFrame:
    return clean.sales_facts(_labelled_sales(m))


@query
def clean_marketing(m: Market) -> DataFrame:
    return clean.marketing_facts(_labelled_marketing(m))


@query
def clean_returns(m: Market) -> DataFrame:
    return clean.returns_facts(_labelled_returns(m))


@query
def sales_report(m: Market) -> DataFrame:
    return clean.sales_report(_labelled_sales(m))


@query
def marketing_report(m: Market) -> DataFrame:
    return clean.marketing_report(_labelled_marketing(m))


@query
def returns_report(m: Market) -> DataFrame:
    return clean.returns_report(_labelled_returns(m))


# --- metrics --------------------------------------------------------------------------


@query
def daily_revenue(m: Market) -> DataFrame:
    return views.daily_revenue(m.orders, m.dates, m.returns)


@query
def daily_refunds(m: Market) -> DataFrame:
    return views.daily_refunds(m.returns)


@query
def category_week_revenue(m: Market) -> DataFrame:
    return views.category_week_revenue(m.orders, m.dates, m.products)


@query
def category_weekly(m: Market) -> DataFrame:
    return views.category_weekly(m.orders, m.dates, m.products)


@query
def region_summary(m: Market) -> DataFrame:
    return views.region_summary(m.orders, m.customers)


@query
def customer_order_counts(m: Market) -> DataFrame:
    return views.customer_order_counts(m.orders, m.customers)


@query
def customer_repeat_rate(m: Market) -> DataFrame:
    return views.customer_repeat_rate(m.orders, m.customers)


@query
def monthly_spend(m: Market) -> DataFrame:
    return views.monthly_spend(m.spend, m.dates)


@query
def monthly_new_customers(m: Market) -> DataFrame:
    return views.monthly_new_customers(m.customers)


@query
def marketing_cac_monthly(m: Market) -> DataFrame:
    return views.marketing_cost(m.spend, m.dates, m.customers)


@query
def order_line_detail(m: Market) -> DataFrame:
    return views.order_line_detail(m.orders, m.dates, m.products)


@query
def order_weeks(m: Market) -> DataFrame:
    return views.order_weeks(m.orders, m.dates, m.products)


@query
def return_summary(m: Market) -> DataFrame:
    return views.return_summary(m.orders, m.products, m.returns)


@query
def return_weekly(m: Market) -> DataFrame:
    return views.return_weekly(m.orders, m.dates, m.products, m.returns)


@query
def latest_30_days(m: Market) -> DataFrame:
    return views.latest_days(views.daily_revenue(m.orders, m.dates, m.returns), 30)


@query
def cac_last_5_months(m: Market) -> DataFrame:
    return views.latest_costs(
        views.marketing_cost(m.spend, m.dates, m.customers), COST_CHANNEL, 5
    )


# --- incremental ------------------------------------------------------------------------


def _loaded_days(m: Market) -> DataFrame:
    """The calendar as it stands when the last order day has just been loaded."""
    return cal.calendar(cal.days_between(m.order_span))


def _after_last_return(m: Market) -> dt.date:
    return m.last_order_day() + dt.timedelta(days=m.settings.return_lag_days + 1)


@query
def missing_dates(m: Market) -> DataFrame:
    return cal.missing_days(_loaded_days(m), _after_last_return(m))


@query
def dim_date_append(m: Market) -> DataFrame:
    loaded = _loaded_days(m)
    return cal.append_days(loaded, cal.missing_days(loaded, _after_last_return(m)))


@query
def high_water_marks(m: Market) -> DataFrame:
    marks = m.dates.agg(F.max("date").alias("last_date"))
    return marks.crossJoin(  # two single rows
        m.orders.agg(
            F.max("order_id").alias("last_order_id"),
            F.max("order_line_id").alias("last_order_line_id"),
        )
    )


@query
def surrogate_ids(m: Market) -> DataFrame:
    return quality.id_summary(
        {
            "fact_orders": clean.sales_facts(_labelled_sales(m)),
            "fact_marketing_spend": clean.marketing_facts(_labelled_marketing(m)),
            "fact_returns": clean.returns_facts(_labelled_returns(m)),
        }
    )


@query
def stamped_ids(m: Market) -> DataFrame:
    """Numbers given to an export that has none: as many as rows, without a gap."""
    day = F.lit(dt.date(2000, 1, 1))
    stamped = stamp(m.raw_marketing.drop("raw_id").withColumn(BATCH, day), F.col(BATCH))
    first = F.shiftleft(F.datediff(day, F.lit(dt.date(1970, 1, 1))).cast("bigint"), 47)
    place = F.col("raw_id") - first
    return stamped.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("raw_id").alias("ids"),
        F.min(place).alias("first_place"),
        F.max(place).alias("last_place"),
    )


@query
def land_two_deliveries(m: Market) -> DataFrame:
    """Two deliveries of one day, the second one landed twice: rows and ids of each."""
    w = Warehouse(m.spark, shared_folder(m.spark, "deliveries"))
    rows = m.raw_marketing.withColumn(BATCH, F.lit(dt.date(2000, 1, 1)))
    odd = F.expr("(raw_id div 2) % 2 = 1")
    for name, part in (("early", ~odd), ("late", odd), ("late", odd)):
        w.land("raw_marketing_spend", rows.filter(part).drop("raw_id"), delivery=name)
    landed = w.read("raw_marketing_spend")
    return landed.groupBy("delivery").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("raw_id").alias("ids"),
        F.sum("spend").cast("double").alias("spend"),
    )


@query
def eligible_customers_on_day(m: Market) -> DataFrame:
    return cal.eligible_on(m.customers, ELIGIBLE_DAY, m.settings.guest_email)


@query
def eligible_customers_daily(m: Market) -> DataFrame:
    return cal.eligible_daily(m.customers, m.dates, m.settings.guest_email)


@query
def return_decision_cohort(m: Market) -> DataFrame:
    days = cal.days_between(m.order_span)
    return views.return_decision_cohort(
        m.orders, m.dates, m.products, days, m.settings.return_lag_days
    )


@query
def full_refresh_counts(m: Market) -> DataFrame:
    first, last = m.order_span.first()
    w = Warehouse(m.spark, shared_folder(m.spark, "refresh"))
    _seed(m, w, first, last)
    return checksums(w.star()).unionByName(row_counts(w.raw()), allowMissingColumns=True)


@query
def incremental_append_counts(m: Market) -> DataFrame:
    w, first_run = _append_history(m)
    return _counts_between(first_run, w.star())


@query
def incremental_idempotent(m: Market) -> DataFrame:
    w, _ = _append_history(m)
    first_run = _frozen(w)
    again = pipeline.append_missing(
        w, m.last_order_day() + dt.timedelta(days=1), m.settings, land_returns=_land_returns(m)
    )
    return _counts_between(first_run, w.star()).withColumn("days_again", F.lit(len(again)))


def _land_returns(m: Market, history_until: dt.date | None = None) -> pipeline.LandReturns:
    """A returns department: on each day it exports the returns of the lines due on it."""

    def land(w: Warehouse, days: DataFrame) -> None:
        # Due lines are that old on one of the days: one row per day. Orders of those days are
        # written, so that Spark knows their number before it shuffles lines to them.
        sold = days.select(F.date_sub("date", m.settings.return_lag_days).alias("order_day"))
        headers = w.stage("orders_due", m.headers.join(F.broadcast(sold), "order_day", "left_semi"))
        of_days = F.broadcast(sold.select(fn.date_key(F.col("order_day")).alias("date_id")))
        booked = w.read("fact_orders").join(of_days, "date_id", "left_semi")
        batch = F.col("exported_on") if history_until is None else F.lit(history_until)
        w.land(
            "raw_returns",
            m.returns_due(headers, booked).withColumn(BATCH, batch),
            delivery="decided returns",
            few_days=True,
        )

    return land


def _seed(m: Market, w: Warehouse, first: dt.date, until: dt.date) -> None:
    """Lands all exports, the history until a day as one batch, and refreshes up to that day."""
    batch = F.greatest("exported_on", F.lit(until))
    pipeline.load_dimensions(w, m.customers, m.products)
    for table, rows in (("raw_sales_export", m.raw_sales_export), ("raw_marketing_spend", m.raw_marketing)):
        w.land(table, rows.withColumn(BATCH, batch), delivery="all", few_days=True)
    pipeline.full_refresh(w, first, until, m.settings, _land_returns(m, until))


def _append_history(m: Market) -> tuple[Warehouse, list]:
    first, last = m.order_span.first()
    w = Warehouse(m.spark, shared_folder(m.spark, "append"))
    _seed(m, w, first, last - dt.timedelta(days=APPENDED_DAYS))
    before = _frozen(w)
    pipeline.append_missing(
        w, last + dt.timedelta(days=1), m.settings, land_returns=_land_returns(m)
    )
    return w, before


def _frozen(w: Warehouse) -> list:
    """Row counts and checksums as they are now: one line per table."""
    return [tuple(r) for r in checksums(w.star()).collect()]


def _counts_between(before: list, now: dict[str, DataFrame]) -> DataFrame:
    """Rows then and now, whether the contents are the same, and their checksums now."""
    spark = next(iter(now.values())).sparkSession
    earlier = spark.createDataFrame(before, CHECKSUMS)
    after = checksums(now)
    rows = earlier.select("relation", F.col("rows").alias("rows_before"))
    return (
        after.withColumnRenamed("rows", "rows_after")
        .join(rows, "relation")
        .join(unchanged(earlier, after), "relation")
    )


# --- quality ----------------------------------------------------------------------------


@query
def dq_bad_facts(m: Market) -> DataFrame:
    return quality.bad_facts(m.orders, m.returns)


def _faulty(frame: DataFrame, key: str, faults: dict[str, tuple[int, object]]) -> DataFrame:
    """The rows, with a value put into each column wherever a number divides the key."""
    for column, (divisor, value) in faults.items():
        put = F.lit(value).cast(frame.schema[column].dataType)
        frame = frame.withColumn(column, F.when(F.col(key) % divisor == 0, put).otherwise(F.col(column)))
    return frame


def _faulty_facts(m: Market) -> dict[str, DataFrame]:
    return {
        "fact_orders": _faulty(
            m.orders,
            "order_line_id",
            {
                "quantity": (97, 0),
                "unit_price": (89, -1),
                "line_revenue": (83, -1),
                "customer_id": (79, None),
                "discount": (73, None),
            },
        ),
        "fact_returns": _faulty(
            m.returns, "return_id", {"refund_amount": (71, -1), "reason": (67, None), "date_id": (61, None)}
        ),
    }


@query
def dq_bad_facts_planted(m: Market) -> DataFrame:
    """The same check over facts with planted faults."""
    facts = _faulty_facts(m)
    return quality.bad_facts(facts["fact_orders"], facts["fact_returns"])


@query
def null_violations_planted(m: Market) -> DataFrame:
    return quality.null_violations(_faulty_facts(m))


@query
def dq_missing_calendar(m: Market) -> DataFrame:
    return quality.days_without_calendar(m.headers.select(F.col("order_day").alias("date")), m.dates)


@query
def pk_violations(m: Market) -> DataFrame:
    return quality.key_violations(m.star())


@query
def fk_violations(m: Market) -> DataFrame:
    """References of the cleaned facts. Returns of rejected lines show up as violations."""
    # Several references start from the same facts, so those are written once.
    w = Warehouse(m.spark, shared_folder(m.spark, "references"))
    return quality.reference_violations(
        {
            **m.star(),
            "fact_orders": w.stage("fact_orders", clean.sales_facts(_labelled_sales(m))),
            "fact_returns": w.stage("fact_returns", clean.returns_facts(_labelled_returns(m))),
        }
    )


@query
def null_violations(m: Market) -> DataFrame:
    return quality.null_violations(m.star())


@query
def check_net_revenue(m: Market) -> DataFrame:
    return quality.net_revenue_mismatches(views.daily_revenue(m.orders, m.dates, m.returns))


@query
def check_week_pct_sum(m: Market) -> DataFrame:
    return quality.week_share_mismatches(
        views.category_week_shares(m.orders, m.dates, m.products)
    )


@query
def check_return_rate_bounds(m: Market) -> DataFrame:
    return quality.rates_out_of_bounds(views.return_summary(m.orders, m.products, m.returns))


@query
def check_no_unknown_region(m: Market) -> DataFrame:
    return quality.unknown_regions(views.region_summary(m.orders, m.customers))


# --- findings ---------------------------------------------------------------------------


@query
def finding_category_decline(m: Market) -> DataFrame:
    return findings.category_decline(
        m.orders, m.dates, m.products, m.last_order_day(), m.settings.trend_window_days
    )


@query
def finding_cac_rise(m: Market) -> DataFrame:
    return findings.cost_rise(
        views.marketing_cost(m.spend, m.dates, m.customers),
        m.settings.cost_months,
        m.settings.min_cost_months,
    )


@query
def finding_return_peak(m: Market) -> DataFrame:
    return findings.return_peak(
        views.return_weekly(m.orders, m.dates, m.products, m.returns),
        m.settings.return_peak_pct,
    )


@query
def finding_return_window(m: Market) -> DataFrame:
    end = m.last_order_day()
    return findings.return_window(
        m.orders,
        m.products,
        m.returns,
        end - dt.timedelta(days=70),
        end - dt.timedelta(days=15),
    )


@query
def finding_calendar_effect(m: Market) -> DataFrame:
    first, last = m.order_span.first()
    return findings.calendar_effect(
        m.orders, m.dates, first, last, m.settings.holiday_from, m.settings.holiday_to
    )
