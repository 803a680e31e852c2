"""The engine's tables derived from the TPC-H-like tables in a folder of Parquet files.

Two shapes come out: a clean star, and the three messy exports a cleaning run
starts from. The mess is assigned by arithmetic on stable keys, so that every
run, and the SQL the results are checked with, sees the same rows. No row of the
given tables is left out.

Line identity: the source has no unique line key, and numbering the lines of an
order would pull each order into one task. A line is therefore identified by a
60-bit hash of its own columns, computed in place without a shuffle: two linear
forms modulo two primes. These hashes are for the derived tables only; landed
exports get exact ids (``sources.warehouse.stamp``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.functions.columns import date_key, line_revenue
from tillmetrics.operators.calendar import calendar, days_between
from tillmetrics.operators.dimensions import with_guest
from tillmetrics.settings import Settings

# The vocabularies of the given tables. Segments act as channels.
MARKET = Settings(
    categories=("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"),
    channels=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
)
# The columns the derivations read.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_returnflag string""",
}
UNPAID_CHANNEL = "PARTNER"  # of the suppliers, who sign up without any spend
GUEST_ID = -1
FIRST_SIGNUP = dt.date(1995, 1, 1)
RETURN_LAG_MIN = 5
# Order, line number, part, supplier, price and discount times these, modulo the
# prime. The products of 40-bit keys stay below 2^62.
LINE_HASH = (
    ((999983, 700001, 610639, 523777, 411001, 304729), 1073741789),
    ((882377, 762121, 655357, 444443, 333331, 222199), 1073741783),
)
REASONS = ("Defective", "Wrong item", "No longer needed", "Better price found", "Other")


def _text_date(day: str) -> str:
    # Text of a date is the same, and quicker, for years of four digits.
    iso = f"""if({day} between date'0001-01-01' and date'9999-12-31', cast({day} as string),
        date_format({day}, 'yyyy-MM-dd'))"""
    return f"if(order_id % 8 = 0, date_format({day}, 'dd/MM/yyyy'), {iso})"


def _line_hash() -> str:
    parts = (
        "l_orderkey",
        "cast(l_linenumber as bigint)",
        "l_partkey",
        "l_suppkey",
        _CENTS,
        "cast(round(l_discount * 1000) as bigint)",
    )
    high, low = (
        "(" + " + ".join(f"{f}L * {part}" for f, part in zip(factors, parts)) + f") % {modulus}L"
        for factors, modulus in LINE_HASH
    )
    return f"({high}) * {1 << 30}L + {low}"


def _copies(exported_twice: str) -> str:
    """0 for every row, and a second row with 1 where asked for."""
    return f"explode(if({exported_twice}, array(0, 1), array(0))) as copy"


_LINE_ID = "line_hash * 2"
_CENTS = "cast(floor(l_extendedprice * 100 / l_quantity) as bigint)"
_RETURN_DAY = f"date_add(order_day, cast({RETURN_LAG_MIN} + line_hash % 21 as int))"
_REASON = "element_at(array('" + "', '".join(REASONS) + "'), cast(line_hash % 5 + 1 as int))"


@dataclass(frozen=True)
class Market:
    spark: SparkSession
    folder: str
    settings: Settings = MARKET

    def table(self, name: str) -> DataFrame:
        # Declared, because looking a schema up costs a job per table.
        return self.spark.read.schema(GIVEN[name]).parquet(f"{self.folder}/{name}.parquet")

    # --- building blocks ----------------------------------------------------------

    @cached_property
    def headers(self) -> DataFrame:
        """One row per order: id, customer and day."""
        return self.table("orders").selectExpr(
            "o_orderkey as order_id", "o_custkey as account_id", "cast(o_orderdate as date) as order_day"
        )

    @cached_property
    def lines(self) -> DataFrame:
        """One row per order line with its id, price and discount."""
        return self._lines.withColumn("line_id", F.expr(_LINE_ID))

    @cached_property
    def _lines(self) -> DataFrame:
        """The same without the id: it is twice the hash, so a shuffle of lines needs only one of them."""
        return self.table("lineitem").selectExpr(
            "l_orderkey as order_id",
            "l_partkey as product_id",
            f"{_line_hash()} as line_hash",
            "cast(round(l_quantity) as int) as quantity",
            f"cast({_CENTS} * 0.01 as decimal(10,2)) as unit_price",
            "cast(l_discount as decimal(4,3)) as discount",
            "l_returnflag = 'R' as returned",
        )

    @cached_property
    def order_span(self) -> DataFrame:
        """First and last order day, one row."""
        return self.headers.agg(F.min("order_day").alias("first"), F.max("order_day").alias("last"))

    def last_order_day(self) -> dt.date:
        return self.order_span.first()["last"]

    # --- star ---------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        """Guest, customers and suppliers. Suppliers sign up but never order."""
        places = (
            self.table("nation")
            .join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr("n_nationkey as nation", "r_name as region")
        )
        shoppers = self.table("customer").selectExpr(
            "c_custkey as customer_id",
            "c_custkey as key",
            "c_name as full_name",
            "concat('customer.', c_custkey, '@example.com') as email",
            "c_nationkey as nation",
            "c_mktsegment as acquisition_channel",
        )
        suppliers = self.table("supplier").selectExpr(
            "-2 - s_suppkey as customer_id",
            "s_suppkey as key",
            "s_name as full_name",
            "concat('supplier.', s_suppkey, '@example.com') as email",
            "s_nationkey as nation",
            f"'{UNPAID_CHANNEL}' as acquisition_channel",
        )
        accounts = (
            shoppers.unionByName(suppliers)
            .join(places, "nation")
            .selectExpr(
                "customer_id",
                "full_name",
                "email",
                "region",
                "acquisition_channel",
                f"date_add(date'{FIRST_SIGNUP}', cast((key * 37) % 2400 as int)) as signup_date",
                "cast(1 as decimal(6,3)) as activity_score",
            )
        )
        return with_guest(accounts, GUEST_ID, self.settings.guest_email, FIRST_SIGNUP)

    @cached_property
    def products(self) -> DataFrame:
        price = "cast(p_retailprice as decimal(10,2))"
        return self.table("part").selectExpr(
            "p_partkey as product_id",
            "p_name as product_name",
            "p_type as category",
            f"cast(round({price} * 0.55, 2) as decimal(10,2)) as unit_cost",
            f"{price} as list_price",
        )

    @cached_property
    def dates(self) -> DataFrame:
        """Calendar from the first order to the last day an order can come back."""
        last = F.date_add("last", self.settings.return_lag_days)
        return calendar(days_between(self.order_span.withColumn("last", last)))

    @cached_property
    def orders(self) -> DataFrame:
        return self._lines.join(self.headers, "order_id").select(
            F.expr(_LINE_ID).alias("order_line_id"),
            "order_id",
            F.expr(f"if(order_id % 100 = 0, {GUEST_ID}L, account_id) as customer_id"),
            "product_id",
            date_key(F.col("order_day")).alias("date_id"),
            F.expr("cast(quantity as smallint) as quantity"),
            "unit_price",
            "discount",
            self._revenue().alias("line_revenue"),
        )

    @staticmethod
    def _revenue() -> Column:
        return line_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount"))

    @cached_property
    def returns(self) -> DataFrame:
        return self._returned(self.headers).select(
            F.expr(_LINE_ID).alias("return_id"),
            F.expr(_LINE_ID).alias("order_line_id"),
            date_key(F.expr(_RETURN_DAY)).alias("date_id"),
            F.expr(f"{_REASON} as reason"),
            self._revenue().cast("decimal(10,2)").alias("refund_amount"),
        )

    @cached_property
    def _orders_by_channel(self) -> DataFrame:
        channels = self.table("customer").selectExpr(
            "c_custkey as account_id", "c_mktsegment as channel"
        )
        return (
            self.table("orders")
            .selectExpr(
                "o_orderkey as order_id",
                "o_custkey as account_id",
                "cast(o_orderdate as date) as order_day",
                "cast(cast(floor(o_totalprice) as bigint) * 0.01 as decimal(10,2)) as spend",
            )
            .join(channels, "account_id")
        )

    @cached_property
    def spend(self) -> DataFrame:
        return (
            self._orders_by_channel.groupBy(date_key(F.col("order_day")).alias("date_id"), "channel")
            .agg(
                F.expr("min(order_id) as spend_id"),
                F.expr("cast(sum(spend) as decimal(20,2)) as spend"),
            )
            .select("spend_id", "date_id", "channel", "spend")
        )

    def star(self) -> dict[str, DataFrame]:
        return {
            "dim_customers": self.customers,
            "dim_products": self.products,
            "dim_date": self.dates,
            "fact_orders": self.orders,
            "fact_marketing_spend": self.spend,
            "fact_returns": self.returns,
        }

    # --- messy exports --------------------------------------------------------------

    @cached_property
    def raw_sales(self) -> DataFrame:
        """Sales export without the columns the cleaning never reads."""
        return self._sales(self.headers)

    def _sales(self, headers: DataFrame) -> DataFrame:
        parts = self.table("part").selectExpr("p_partkey as product_id", "p_name", "p_type")
        bought = self._lines.join(headers, "order_id").join(parts, "product_id")
        more = [c for c in headers.columns if c not in self.headers.columns]
        return bought.selectExpr("*", _copies("line_hash % 101 = 0")).selectExpr(
            f"{_LINE_ID} + copy as raw_id",
            "order_id",
            f"""case when order_id % 211 = 0 then 'not-a-date' when order_id % 223 = 0 then null
                else {_text_date("order_day")} end as order_date""",
            """case when order_id % 100 = 0 then null when order_id % 101 = 0 then ''
                when order_id % 103 = 0 then 'nobody@unknown.example'
                else concat('customer.', account_id, '@example.com') end as customer_email""",
            "if(line_hash % 157 = 0, 'no such product', p_name) as product_name",
            # A copy carries a bogus category: that column is outside the key and must not win.
            """case when copy = 1 or line_hash % 151 = 0 then 'Bogus'
                when line_hash % 163 = 0 then null
                when line_hash % 16 = 1 then lower(p_type)
                when line_hash % 16 = 2 then concat('  ', p_type, '  ')
                when line_hash % 16 = 3 then concat(char(9), p_type, char(9))
                else p_type end as category""",
            """case when line_hash % 67 = 0 then 0 when line_hash % 71 = 0 then -quantity
                when line_hash % 73 = 0 then null else quantity end as quantity""",
            """cast(case when line_hash % 113 = 0 then 0 when line_hash % 127 = 0 then null
                else unit_price end as decimal(10,2)) as unit_price""",
            "if(line_hash % 13 = 0, null, discount) as discount",
            "account_id",
            "order_day as exported_on",
            *more,
        )

    @cached_property
    def raw_sales_export(self) -> DataFrame:
        """The full sales export: who bought rides along, except on guest checkouts.

        People meet the orders, not their lines: that shuffles fewer and narrower rows.
        """
        people = self.customers.selectExpr(
            "customer_id as account_id", "full_name", "region", "acquisition_channel"
        )
        known = "if(customer_email is not null, full_name, null)"
        return (
            self._sales(self.headers.join(people, "account_id"))
            .withColumn("customer_name", F.expr(known))
            .drop("account_id", "full_name")
        )

    @cached_property
    def raw_marketing(self) -> DataFrame:
        return self._orders_by_channel.selectExpr("*", _copies("order_id % 50 = 0")).selectExpr(
            "order_id * 2 + copy as raw_id",
            f"if(order_id % 211 = 0, 'not-a-date', {_text_date('order_day')}) as spend_date",
            """case when order_id % 131 = 0 then 'Bogus Channel'
                when order_id % 12 = 1 then lower(channel)
                when order_id % 12 = 2 then concat('  ', channel, '  ')
                else channel end as channel""",
            "if(order_id % 137 = 0, null, spend) as spend",
            "order_day as exported_on",
        )

    @cached_property
    def raw_returns(self) -> DataFrame:
        """Returns export. It reaches us on the day the return of a line is decided."""
        return self._as_returns(self._returned(self.headers), "product_id")

    @cached_property
    def raw_returns_export(self) -> DataFrame:
        """The full returns export, with the category of the product in its place."""
        return self._with_kinds(self._returned(self.headers))

    def returns_due(self, headers: DataFrame, booked: DataFrame) -> DataFrame:
        """The full export of some orders' returns, those of booked lines (``order_line_id``).

        An inner join with the distinct ids: Spark would move a semi-join below the join with the
        orders, where all returned lines were shuffled for it, however few orders there are.
        """
        ids = booked.select("order_line_id").distinct()
        back = self._returned(headers).withColumn("order_line_id", F.expr(_LINE_ID)).drop("line_hash")
        kept = back.join(ids, "order_line_id").withColumn("line_hash", F.expr("order_line_id div 2"))
        return self._with_kinds(kept.drop("order_line_id"))

    def _returned(self, headers: DataFrame) -> DataFrame:
        return self._lines.filter("returned").drop("returned").join(headers, "order_id")

    def _with_kinds(self, back: DataFrame) -> DataFrame:
        # Before there are texts: lines are narrower then.
        kinds = self.table("part").selectExpr(
            "p_partkey as product_id", "lower(p_type) as category"
        )
        return self._as_returns(back.join(kinds, "product_id"), "category")

    def _as_returns(self, back: DataFrame, *more: str) -> DataFrame:
        return (
            back.selectExpr("*", _copies("line_hash % 101 = 0"))
            .withColumn("refund", self._revenue())
            .selectExpr(
                f"{_LINE_ID} + copy as raw_id",
                f"{_LINE_ID} as order_line_id",
                f"if(line_hash % 199 = 0, '31/02/2001', {_text_date(_RETURN_DAY)}) as return_date",
                f"""case when line_hash % 23 = 0 then null when line_hash % 19 = 0 then ''
                    else {_REASON} end as reason""",
                # A copy carries a token refund: outside the key, it must not win.
                """cast(case when copy = 1 then 0.01 when line_hash % 97 = 0 then -refund
                    else refund end as decimal(10,2)) as refund_amount""",
                f"date_add(order_day, {self.settings.return_lag_days}) as exported_on",
                *more,
            )
        )
