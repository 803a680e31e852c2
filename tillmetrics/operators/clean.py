"""The three cleaning jobs.

Each job is one pass: ``label_*`` removes copies and tags every surviving row
with the first rule it breaks (``reject_reason``, NULL for a good row). The fact
rows and the audit report are both derived from the labelled frame, so a job
that needs both stages that frame once.

``batch`` names columns that bound the deduplication, typically the landing day;
without it the whole input is one batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.functions.columns import (
    date_key,
    filled_reason,
    fixed_refund,
    line_revenue,
    not_positive,
    parse_date,
    vocabulary_code,
    vocabulary_label,
)
from tillmetrics.operators.dedupe import MARKETING_KEY, RETURNS_KEY, SALES_KEY, keep_first
from tillmetrics.operators.lookup import lookup_product, meet_customers
from tillmetrics.sources.schemas import UNREADABLE

BAD_DATE = "unparseable_date"
BAD_QUANTITY = "invalid_quantity"
BAD_PRICE = "invalid_price"
BAD_CATEGORY = "unmatched_category"
BAD_PRODUCT = "unmatched_product"
BAD_CHANNEL = "unmatched_channel"
NO_AMOUNT = "null_amount"
BAD_RECORD = "unreadable"


def _with_record(raw: DataFrame) -> DataFrame:
    """Rows that never were a file's record have nothing unreadable in it."""
    if UNREADABLE in raw.columns:
        return raw
    return raw.withColumn(UNREADABLE, F.lit(None).cast("string"))


def first_failure(*rules: tuple[str, Column]) -> Column:
    """Name of the first rule whose condition holds, NULL when none does."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in rules])


def dedupe_sales(raw: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    return keep_first(raw, [*batch, *SALES_KEY])


def dedupe_marketing(raw: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    return keep_first(raw, [*batch, *MARKETING_KEY])


def dedupe_returns(raw: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    return keep_first(raw, [*batch, *RETURNS_KEY])


def label_sales(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    categories: Sequence[str],
    guest_id: int,
    batch: Sequence[str] = (),
    few_products: bool = False,
) -> DataFrame:
    """``few_products``: see ``lookup_product``."""
    # The category decides nothing but its vocabulary position, which is a
    # number: carrying that instead of the text keeps the deduplication a hash
    # aggregation.
    # Records that can't be read are nobody's copy: their missing values are not the same ones.
    key = [*batch, *SALES_KEY, UNREADABLE]
    coded = _with_record(raw).select(
        "raw_id",
        *key,
        vocabulary_code(F.col("category"), categories).alias("category_code"),
    )
    # Copies have one email and one customer, so rows meet the customers first and their copies there.
    met = meet_customers(coded, customers, guest_id, key)
    kept = (
        keep_first(met, ["_key", *key, "customer_id"], ["category_code"])
        .drop("_key")
        .withColumn("order_day", parse_date(F.col("order_date")))
        .withColumn("category", vocabulary_label(F.col("category_code"), categories))
    )
    found = lookup_product(kept, products, few=few_products)
    reason = first_failure(
        (BAD_DATE, F.col("order_day").isNull()),
        (BAD_QUANTITY, not_positive(F.col("quantity"))),
        (BAD_PRICE, not_positive(F.col("unit_price"))),
        (BAD_CATEGORY, F.col("category_code").isNull()),  # a number: the text isn't carried on
        (BAD_PRODUCT, F.col("product_id").isNull()),
        (BAD_RECORD, F.col(UNREADABLE).isNotNull()),
    )
    return found.select(
        "raw_id",
        *batch,
        "order_id",
        "customer_id",
        "product_id",
        "order_day",
        "quantity",
        "unit_price",
        "discount",
        "copies",
        reason.alias("reject_reason"),
    )


def sales_columns() -> list[Column]:
    """The columns of an order line, from a labelled row. Its id is that of the first raw row."""
    return [
        F.col("raw_id").alias("order_line_id"),
        F.col("order_id"),
        F.col("customer_id"),
        F.col("product_id"),
        date_key(F.col("order_day")).alias("date_id"),
        F.col("quantity").cast("smallint").alias("quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        F.coalesce(F.col("discount"), F.lit(0)).cast("decimal(4,3)").alias("discount"),
        line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount")).alias(
            "line_revenue"
        ),
    ]


def sales_facts(labelled: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """Order lines ready for the star."""
    first, *rest = sales_columns()
    return labelled.filter(F.col("reject_reason").isNull()).select(first, *batch, *rest)


def label_marketing(
    raw: DataFrame, channels: Sequence[str], batch: Sequence[str] = ()
) -> DataFrame:
    key = [*batch, *MARKETING_KEY, UNREADABLE]
    kept = keep_first(_with_record(raw).select("raw_id", *key), key)
    day = parse_date(F.col("spend_date"))
    code = vocabulary_code(F.col("channel"), channels)
    reason = first_failure(
        (BAD_DATE, F.col("spend_day").isNull()),
        (BAD_CHANNEL, F.col("channel").isNull()),
        # An amount in a record that can't be read may be part of one.
        (NO_AMOUNT, F.col("spend").isNull() | F.col(UNREADABLE).isNotNull()),
    )
    labelled = kept.select(
        "raw_id",
        *batch,
        day.alias("spend_day"),
        vocabulary_label(code, channels).alias("channel"),
        "spend",
        "copies",
        UNREADABLE,
    )
    return labelled.withColumn("reject_reason", reason).drop(UNREADABLE)


def marketing_columns() -> list[Column]:
    """What a labelled row adds to the spend of its day and channel."""
    return [
        F.col("raw_id").alias("spend_id"),
        date_key(F.col("spend_day")).alias("date_id"),
        F.col("channel"),
        F.col("spend"),
    ]


def marketing_facts(labelled: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """One row per day and channel; several partial exports of a day add up."""
    good = labelled.filter(F.col("reject_reason").isNull())
    return (
        good.withColumn("date_id", date_key(F.col("spend_day")))
        .groupBy(*batch, "date_id", "channel")
        .agg(
            F.min("raw_id").alias("spend_id"),
            F.sum("spend").cast("decimal(20,2)").alias("spend"),
        )
        .select("spend_id", *batch, "date_id", "channel", "spend")
    )


def label_returns(raw: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    key = [*batch, *RETURNS_KEY, UNREADABLE]
    kept = keep_first(
        _with_record(raw).select("raw_id", *key, "refund_amount"), key, ["refund_amount"]
    )
    reason = first_failure(
        (BAD_DATE, F.col("return_day").isNull()),
        (NO_AMOUNT, F.col("refund_amount").isNull() | F.col(UNREADABLE).isNotNull()),
    )
    labelled = kept.select(
        "raw_id",
        *batch,
        "order_line_id",
        parse_date(F.col("return_date")).alias("return_day"),
        "reason",
        "refund_amount",
        "copies",
        UNREADABLE,
    )
    return labelled.withColumn("reject_reason", reason).drop(UNREADABLE)


def returns_columns() -> list[Column]:
    """The columns of a return, from a labelled row."""
    return [
        F.col("raw_id").alias("return_id"),
        F.col("order_line_id"),
        date_key(F.col("return_day")).alias("date_id"),
        filled_reason(F.col("reason")).alias("reason"),
        fixed_refund(F.col("refund_amount")).cast("decimal(10,2)").alias("refund_amount"),
    ]


def returns_facts(labelled: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    first, *rest = returns_columns()
    return labelled.filter(F.col("reject_reason").isNull()).select(first, *batch, *rest)


# --- whole-table rejects, one rule at a time -------------------------------------


def unparseable_dates(raw: DataFrame, column: str) -> DataFrame:
    return raw.filter(parse_date(F.col(column)).isNull())


def invalid_quantities(raw: DataFrame) -> DataFrame:
    return raw.filter(not_positive(F.col("quantity")))


def invalid_prices(raw: DataFrame) -> DataFrame:
    return raw.filter(not_positive(F.col("unit_price")))


def unmatched_vocabulary(raw: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    return raw.filter(vocabulary_code(F.col(column), vocabulary).isNull())


def unmatched_products(
    raw: DataFrame, products: DataFrame, categories: Sequence[str]
) -> DataFrame:
    """Rows in a known category whose product the dimension does not hold."""
    code = vocabulary_code(F.col("category"), categories)
    known = raw.withColumn("category", vocabulary_label(code, categories)).filter(
        F.col("category").isNotNull()
    )
    return lookup_product(known, products).filter(F.col("product_id").isNull()).drop("product_id")


# --- audit reports ----------------------------------------------------------------


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def _rejected(reason: str) -> Column:
    return F.count_if(F.col("reject_reason") == reason).alias(f"{reason}_dropped")


def _raw_rows() -> Column:
    return _total(F.col("copies")).alias("raw_rows")


def _duplicates() -> Column:
    return _total(F.col("copies") - 1).alias("duplicates_dropped")


def _clean_rows() -> Column:
    return F.count_if(F.col("reject_reason").isNull()).alias("clean_rows")


def sales_report(labelled: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """What happened to every raw row; one row, or one per batch."""
    return labelled.groupBy(*batch).agg(
        _raw_rows(),
        _duplicates(),
        _rejected(BAD_DATE),
        _rejected(BAD_QUANTITY),
        _rejected(BAD_PRICE),
        _rejected(BAD_CATEGORY),
        _rejected(BAD_PRODUCT),
        _rejected(BAD_RECORD),
        _clean_rows(),
    )


def marketing_report(labelled: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """Counts fold to one row per (outcome, day, channel) first: the good ones are the clean rows."""
    good = F.col("reject_reason").isNull()
    folded = labelled.groupBy(*batch, "reject_reason", "spend_day", "channel").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("kept")
    )

    def rejected(reason: str) -> Column:
        kept = F.when(F.col("reject_reason") == reason, F.col("kept"))
        return _total(kept).alias(f"{reason}_dropped")

    return folded.groupBy(*batch).agg(
        _raw_rows(),
        _total(F.col("copies") - F.col("kept")).alias("duplicates_dropped"),
        rejected(BAD_DATE),
        rejected(BAD_CHANNEL),
        rejected(NO_AMOUNT),
        _total(F.when(good, F.col("kept") - 1)).alias("rows_aggregated"),
        _clean_rows(),
    )


def returns_report(labelled: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    good = F.col("reject_reason").isNull()
    return labelled.groupBy(*batch).agg(
        _raw_rows(),
        _duplicates(),
        _rejected(BAD_DATE),
        _rejected(NO_AMOUNT),
        F.count_if(good & (F.col("refund_amount") < 0)).alias("negative_refund_fixed"),
        _clean_rows(),
    )
