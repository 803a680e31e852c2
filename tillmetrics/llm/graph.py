"""Connected components of links between long ids, as Spark jobs.

Each round hangs the neighbours of every node on its smallest neighbour, first the larger ones,
then the smaller ones, until all links point at the smallest node of their component. The rounds
grow with the logarithm of the component size. Links are written to the shared checkpoint folder
after each round, so a lost executor costs a round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmetrics.llm.text import shared_folder


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    return (
        both.join(least, F.col("u") == F.col("n"))
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
    )


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
    hung = down.join(least, F.col("u") == F.col("n")).select(F.col("v").alias("a"), "m")
    return (
        hung.union(least.select("n", "m"))
        .select("a", F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    sums = [F.sum(F.xxhash64("a", "b", F.lit(i)).cast("decimal(38,0)")) for i in (1, 2)]
    return tuple(links.agg(F.count(F.lit(1)), *sums).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots; links: (a, b) of longs, any direction."""
    shared_folder(links.sparkSession)
    links = links.toDF("a", "b").filter("a <> b").distinct().checkpoint()
    before = _state(links)
    while before[0]:
        links = _small(_large(links)).checkpoint()
        after = _state(links)
        if after == before:
            break
        before = after
    return links.toDF("node", "root")
