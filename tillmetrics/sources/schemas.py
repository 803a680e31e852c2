"""Declared schemas of every stored table. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
LINE_MONEY = T.DecimalType(12, 2)
SPEND = T.DecimalType(20, 2)  # sums of a day and channel; they grow with the company
RATE = T.DecimalType(4, 3)
SCORE = T.DecimalType(6, 3)
# A record of a file that does not fit its columns, as it stands there; NULL for all others.
UNREADABLE = "unreadable"


def _struct(nullable: bool, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind in fields])


RAW_SALES = _struct(
    True,
    ("raw_id", T.LongType()),
    ("order_id", T.LongType()),
    ("order_date", T.StringType()),
    ("customer_email", T.StringType()),
    ("customer_name", T.StringType()),
    ("region", T.StringType()),
    ("acquisition_channel", T.StringType()),
    ("product_name", T.StringType()),
    ("category", T.StringType()),
    ("quantity", T.IntegerType()),
    ("unit_price", MONEY),
    ("discount", RATE),
    (UNREADABLE, T.StringType()),
    ("loaded_at", T.TimestampNTZType()),
)
RAW_MARKETING = _struct(
    True,
    ("raw_id", T.LongType()),
    ("spend_date", T.StringType()),
    ("channel", T.StringType()),
    ("spend", SPEND),
    (UNREADABLE, T.StringType()),
    ("loaded_at", T.TimestampNTZType()),
)
RAW_RETURNS = _struct(
    True,
    ("raw_id", T.LongType()),
    ("order_line_id", T.LongType()),
    ("category", T.StringType()),
    ("return_date", T.StringType()),
    ("reason", T.StringType()),
    ("refund_amount", MONEY),
    (UNREADABLE, T.StringType()),
    ("loaded_at", T.TimestampNTZType()),
)
DIM_CUSTOMERS = _struct(
    False,
    ("customer_id", T.LongType()),
    ("full_name", T.StringType()),
    ("email", T.StringType()),
    ("region", T.StringType()),
    ("acquisition_channel", T.StringType()),
    ("signup_date", T.DateType()),
    ("activity_score", SCORE),
)
DIM_PRODUCTS = _struct(
    False,
    ("product_id", T.LongType()),
    ("product_name", T.StringType()),
    ("category", T.StringType()),
    ("unit_cost", MONEY),
    ("list_price", MONEY),
)
DIM_DATE = _struct(
    False,
    ("date_id", T.IntegerType()),
    ("date", T.DateType()),
    ("year", T.IntegerType()),
    ("month", T.IntegerType()),
    ("day", T.IntegerType()),
    ("day_of_week", T.IntegerType()),
    ("day_name", T.StringType()),
    ("week_of_year", T.IntegerType()),
    ("is_weekend", T.BooleanType()),
)
FACT_ORDERS = _struct(
    False,
    ("order_line_id", T.LongType()),
    ("order_id", T.LongType()),
    ("customer_id", T.LongType()),
    ("product_id", T.LongType()),
    ("date_id", T.IntegerType()),
    ("quantity", T.ShortType()),
    ("unit_price", MONEY),
    ("discount", RATE),
    ("line_revenue", LINE_MONEY),
)
FACT_MARKETING_SPEND = _struct(
    False,
    ("spend_id", T.LongType()),
    ("date_id", T.IntegerType()),
    ("channel", T.StringType()),
    ("spend", SPEND),
)
FACT_RETURNS = _struct(
    False,
    ("return_id", T.LongType()),
    ("order_line_id", T.LongType()),
    ("date_id", T.IntegerType()),
    ("reason", T.StringType()),
    ("refund_amount", MONEY),
)
SALES_REPORT = _struct(
    False,
    ("raw_rows", T.LongType()),
    ("duplicates_dropped", T.LongType()),
    ("unparseable_date_dropped", T.LongType()),
    ("invalid_quantity_dropped", T.LongType()),
    ("invalid_price_dropped", T.LongType()),
    ("unmatched_category_dropped", T.LongType()),
    ("unmatched_product_dropped", T.LongType()),
    ("unreadable_dropped", T.LongType()),
    ("clean_rows", T.LongType()),
)
MARKETING_REPORT = _struct(
    False,
    ("raw_rows", T.LongType()),
    ("duplicates_dropped", T.LongType()),
    ("unparseable_date_dropped", T.LongType()),
    ("unmatched_channel_dropped", T.LongType()),
    ("null_amount_dropped", T.LongType()),
    ("rows_aggregated", T.LongType()),
    ("clean_rows", T.LongType()),
)
RETURNS_REPORT = _struct(
    False,
    ("raw_rows", T.LongType()),
    ("duplicates_dropped", T.LongType()),
    ("unparseable_date_dropped", T.LongType()),
    ("null_amount_dropped", T.LongType()),
    ("negative_refund_fixed", T.LongType()),
    ("clean_rows", T.LongType()),
)

DIMENSIONS = {
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "dim_date": DIM_DATE,
}
FACTS = {
    "fact_orders": FACT_ORDERS,
    "fact_marketing_spend": FACT_MARKETING_SPEND,
    "fact_returns": FACT_RETURNS,
}
RAW = {
    "raw_sales_export": RAW_SALES,
    "raw_marketing_spend": RAW_MARKETING,
    "raw_returns": RAW_RETURNS,
}
REPORTS = {
    "report_sales": SALES_REPORT,
    "report_marketing": MARKETING_REPORT,
    "report_returns": RETURNS_REPORT,
}
TABLES = {**DIMENSIONS, **FACTS, **RAW}

PRIMARY_KEYS = {
    "dim_customers": ("customer_id",),
    "dim_products": ("product_id",),
    "dim_date": ("date_id",),
    "fact_orders": ("order_line_id",),
    "fact_marketing_spend": ("spend_id",),
    "fact_returns": ("return_id",),
}
UNIQUE_KEYS = {"dim_date": ("date",)}
# child table, child column, parent table (joined on the same column name)
FOREIGN_KEYS = (
    ("fact_orders", "customer_id", "dim_customers"),
    ("fact_orders", "product_id", "dim_products"),
    ("fact_orders", "date_id", "dim_date"),
    ("fact_marketing_spend", "date_id", "dim_date"),
    ("fact_returns", "order_line_id", "fact_orders"),
    ("fact_returns", "date_id", "dim_date"),
)
