"""Building the customer dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.settings import UNKNOWN


def with_guest(
    customers: DataFrame, guest_id: int, guest_email: str, signup: dt.date
) -> DataFrame:
    """The customer dimension with the row that stands for guest checkouts."""
    guest = customers.sparkSession.range(1).select(
        F.lit(guest_id).cast("bigint").alias("customer_id"),
        F.lit("Guest account").alias("full_name"),
        F.lit(guest_email).alias("email"),
        F.lit(UNKNOWN).alias("region"),
        F.lit(UNKNOWN).alias("acquisition_channel"),
        F.lit(signup).alias("signup_date"),
        F.lit(0).cast("decimal(6,3)").alias("activity_score"),
    )
    return guest.unionByName(customers)
