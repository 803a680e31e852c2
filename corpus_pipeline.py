"""From documents to token ids: five stages, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir), docs being all that its predecessor kept, and returns the
columns of documents; the last one returns tokens. A stage that ran is on disk in the shared
checkpoint folder, so losing executors never costs more than the stage at work.

Every stage takes the columns of documents alone; others, whatever their names, are left behind. An
empty table passes through as an empty one. Null and empty texts have no language and go in the first
stage, with or without doc_id. Repeated rows are copies: one of them stays in the second stage, of
equal ids and texts as of different ones. Very long texts are worked on whole. A null lang is
filled in, a null source stays null, and so does a null n_chars unless the text is cut.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm import bpe_tree, decontaminate, language_id, simhash_dedup, suffix_dedup
from tillmetrics.llm.text import shared_folder, table

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language go; a missing label is filled in."""
    model = language_id.learn(docs.select("doc_id", "text", "lang"))
    known = language_id.predict(docs.select(*DOCUMENTS), model)
    known = known.filter(F.col("lang_pred") != language_id.UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*DOCUMENTS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash_dedup.keep_one(docs.select(*DOCUMENTS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur elsewhere, too, are cut out of the texts."""
    cut = suffix_dedup.remove_repeats(docs.select(*DOCUMENTS)).withColumnRenamed("kept_text", "text")
    size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", size.cast("long")).select(*DOCUMENTS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    benchmark = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.clean(docs.select(*DOCUMENTS), benchmark)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their number, and the digests of the ids and of the text they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    kept = tuple(c for c in DOCUMENTS if c != "text")
    return bpe_tree.encode(docs, path, keep=kept, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontaminate", drop_benchmark_leaks),
    ("bpe", tokenize),
]
# The first stage learns a classifier, the last one runs a tokenizer: no SQL for either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents", *DOCUMENTS)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
