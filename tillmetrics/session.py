"""Session settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins of facts with dimensions leave hot keys to adaptive execution, which
# splits them at run time. Forced, because Spark otherwise leaves a hot key in one
# task whenever splitting it costs the next aggregation a shuffle of its own.
SKEW = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Files of a shuffle go when its query ends. Otherwise they stay until the driver happens to collect
# garbage, and a job of many steps holds the shuffles of them all.
CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in (SKEW | CLEANUP).items():
        spark.conf.set(name, value)
    return spark
