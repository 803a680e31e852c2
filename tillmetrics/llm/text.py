"""Column expressions and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Everything up to DEL that is neither a digit nor a lower-case letter separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KELVIN = "K"  # the one other character whose lower case is an ASCII letter by itself


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The columns of a contract; whatever else a table carries stays out of the way."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def whole(text: Column | str) -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column | str) -> Column:
    """Words of digits, letters a-z in either case and whatever lies beyond ASCII."""
    lowered = F.lower(F.replace(whole(text), F.lit(KELVIN), F.lit("ĸ")))
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder; on a single machine without a setting, as in tests, one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local") or "cluster" in context.master:
                raise ValueError("spark.checkpoint.dir names no folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
