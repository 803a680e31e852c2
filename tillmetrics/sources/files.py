"""Reading department exports and dimension files with their declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillmetrics.sources.export import CSV
from tillmetrics.sources.schemas import TABLES, UNREADABLE

# Assigned when a row is landed, so no export carries them.
_STAMPED = ("raw_id", "loaded_at")


def read_file(spark: SparkSession, table: str, path: str, kind: str = "csv") -> DataFrame:
    """A CSV (with header) or Parquet file or folder holding rows of ``table``.

    A CSV value that does not fit its column becomes NULL. For the exports the record it
    stands in is kept beside it in ``unreadable``, and so are records with too many or too few
    values, as a line break inside quotes makes two of; the cleaning rejects and counts them.
    """
    schema = T.StructType(
        [T.StructField(f.name, f.dataType) for f in TABLES[table].fields if f.name not in _STAMPED]
    )
    reader = spark.read.schema(schema)
    if kind == "parquet":
        return reader.parquet(path)
    return reader.options(**CSV, columnNameOfCorruptRecord=UNREADABLE).csv(path)
