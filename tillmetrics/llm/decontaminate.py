"""Benchmark decontamination by spaced seeds.

A mask looks at some words of a window and ignores the others: windows that differ only in ignored
words have equal hashes. The windows of all documents and of all benchmark items are hashed under
each mask and joined on the hash. A hit says on which diagonal (place in the document minus
place in the item) the two may run alike; there all words are compared, and the document holds
the item if some stretch of BLOCK words, or the whole of a shorter item, has no more than the
tolerated substitutions.

The masks are chosen so that no such stretch is missed: whichever 3 of 16 words are replaced, one
mask still finds a window without any (tolerance() works out the same for shorter items). Items
shorter than every mask are held word for word or not at all: each of their lengths that occurs in
the benchmark is a mask of its own in which every word counts. So the result is that of comparing
every stretch with every other one, whatever its length.

The benchmark's hashes are broadcast if they are counted to be at most BROADCAST rows, else both
sides are shuffled by hash and hot hashes left to adaptive execution. Hits are counted once for
each diagonal before the documents' words are read again for comparison.

Words are those of the license scan: digits, letters in lower case, and all beyond ASCII. Null and
empty texts hold nothing and items without words are held by nothing; an item of one word is held
by every document with that word; very long texts are read like others, hashes and hits of one
text in its own row; rows repeated on either side give one row; rows without an id are matched,
too; other columns are ignored; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import functools
import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.text import table, whole, words

# 1 is a word that counts. Found by search for the fewest masks of six words that
# leave no way to hide three substitutions in sixteen words.
MASKS = ("11101101", "110100000111")
BLOCK = 16  # words
BROADCAST = 1_000_000  # hashes of the benchmark that each executor may hold (16 bytes each)


@functools.cache
def tolerance(length: int, masks: tuple[str, ...] = MASKS) -> int:
    """Most substitutions in `length` words that leave a window of some mask untouched; -1: none."""
    windows = [
        {at + i for i, c in enumerate(mask) if c == "1"}
        for mask in masks
        for at in range(length - len(mask) + 1)
    ]
    replaced = -1
    while replaced < length and all(
        any(w.isdisjoint(hidden) for w in windows)
        for hidden in itertools.combinations(range(length), replaced + 1)
    ):
        replaced += 1
    return replaced


def _hashes(masks: tuple[str, ...]) -> Column:
    """Hashes of the windows of `word_hashes` under each mask, one mask after the other."""
    own = F.col("word_hashes")

    def under(mask: str) -> Column:
        places = [i for i, c in enumerate(mask) if c == "1"]
        last = F.size(own) - len(mask)
        return F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda at: F.xxhash64(F.lit(int(mask, 2)), *[F.get(own, at + i) for i in places]),
            ),
        ).otherwise(F.array().cast("array<bigint>"))

    return F.concat(*map(under, masks))


def _windows(rows: DataFrame, masks: tuple[str, ...], *keys: str) -> DataFrame:
    """keys, place and hash of every window; rows: keys and word_hashes."""
    size = F.size("word_hashes")
    exploded = rows.select(
        *keys, size.alias("size"), F.posexplode(_hashes(masks)).alias("place", "hash")
    )
    place, before = F.col("place"), F.lit(0)
    for mask in masks[:-1]:  # windows of the masks that come before
        before = before + F.greatest(F.col("size") - len(mask) + 1, F.lit(0))
        place = F.when(F.col("place") >= before, F.col("place") - before).otherwise(place)
    return exploded.select(*keys, place.alias("place"), "hash")


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def needed(length: int, masks: tuple[str, ...] = MASKS) -> int:
    """How many of `length` words must be equal; all of them below the shortest mask."""
    return length - max(tolerance(length, masks), 0)


def items_of(benchmark: DataFrame, masks: tuple[str, ...], block: int) -> DataFrame:
    """Distinct items with their words and the equal words that a stretch of them must have."""
    need = F.lit(None).cast("int")
    stretch = F.least(F.size("item_words"), F.lit(block))
    for n in range(1, block + 1):
        need = F.when(stretch == n, needed(n, masks)).otherwise(need)
    return (
        benchmark.select("item_id", whole("text").alias("text"))
        .distinct()
        .select(
            F.xxhash64("item_id", "text").alias("item_key"),
            "item_id",
            words("text").alias("item_words"),
        )
        .withColumns({"stretch": stretch, "need": need})
        .filter("need is not null")
    )


def _seeds(items: DataFrame, masks: tuple[str, ...]) -> tuple[DataFrame, tuple[str, ...]]:
    """item_key, n_words, item_place and hash of the items' windows, and the masks documents need."""
    hashed = items.select(
        "item_key",
        F.size("item_words").alias("n_words"),
        F.transform("item_words", lambda w: F.xxhash64(w)).alias("word_hashes"),
    )
    shortest = min(map(len, masks))
    below = hashed.filter(F.col("n_words") < shortest)
    # Fewer numbers than the shortest mask has places.
    lengths = sorted(r["n_words"] for r in below.select("n_words").distinct().collect())
    seeds = _windows(hashed.filter(F.col("n_words") >= shortest), masks, "item_key", "n_words")
    for n in lengths:
        own = below.filter(F.col("n_words") == n)
        seeds = seeds.unionByName(_windows(own, ("1" * n,), "item_key", "n_words"))
    return seeds.withColumnRenamed("place", "item_place"), (*masks, *["1" * n for n in lengths])


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    block: int = BLOCK,
    broadcast: int = BROADCAST,
) -> DataFrame:
    """A row for each document and item it holds: where the closest stretch begins, and how close.

    doc_id, text_key (hash of the text), item_id, n_words of the item, n_equal of them on the
    diagonal, first_word of the closest stretch in the document, share of its words that are equal.
    """
    items = items_of(benchmark, masks, block)
    texts = docs.select("doc_id", whole("text").alias("text"))
    texts = texts.withColumn("text_key", F.xxhash64("text"))
    seeds, used = _seeds(items, masks)
    if seeds.count() <= broadcast:
        seeds = F.broadcast(seeds)
    read = _windows(
        texts.select("doc_id", "text_key", _word_hashes(F.col("text")).alias("word_hashes")),
        used,
        "doc_id",
        "text_key",
    )
    hits = (
        read.join(seeds, "hash")
        .select(
            "doc_id",
            "text_key",
            F.struct("item_key", "n_words", (F.col("place") - F.col("item_place")).alias("diagonal"))
            .alias("hit"),
        )
        .distinct()
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list("hit").alias("hits"))
        .select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "hits")
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key"))
    beside = (
        texts.join(hits, same)
        .select("doc_id", "text_key", "hits", words("text").alias("words"))
        .select(
            "doc_id",
            "text_key",
            F.explode(
                F.transform(
                    "hits",
                    lambda h: F.struct(
                        h["item_key"].alias("item_key"),
                        h["diagonal"].alias("diagonal"),
                        F.transform(
                            F.sequence(F.lit(0), h["n_words"] - 1),
                            lambda k: F.get(F.col("words"), h["diagonal"] + k),
                        ).alias("beside"),
                    ),
                )
            ).alias("hit"),
        )
        .select("doc_id", "text_key", "hit.*")
        .join(items, "item_key")
    )
    equal = F.transform(
        "item_words", lambda w, k: F.coalesce(F.get(F.col("beside"), k) == w, F.lit(False))
    )
    sums = F.transform(
        F.sequence(F.lit(0), F.size("item_words") - F.col("stretch")),
        lambda at: F.size(F.filter(F.slice("equal", at + 1, F.col("stretch")), lambda e: e)),
    )
    judged = (
        beside.withColumn("equal", equal)
        .withColumn("sums", sums)
        .withColumn("most", F.array_max("sums"))
        .filter("most >= need")
        .withColumn("n_equal", F.size(F.filter("equal", lambda e: e)))
    )
    best = F.max(
        F.struct(
            "most",
            "n_equal",
            (-F.col("diagonal")).alias("back"),
            (F.col("diagonal") + F.array_position("sums", F.col("most")) - 1).alias("first_word"),
            (F.col("most") / F.col("stretch")).alias("share"),
            F.size("item_words").alias("n_words"),
        )
    ).alias("best")
    return (
        judged.groupBy("doc_id", "text_key", "item_key", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "text_key",
            "item_id",
            F.col("best.n_words").cast("long").alias("n_words"),
            F.col("best.n_equal").cast("long").alias("n_equal"),
            F.col("best.first_word").cast("long").alias("first_word"),
            F.col("best.share").alias("share"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, all columns kept."""
    found = overlaps(docs.select("doc_id", "text"), benchmark)
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (
        F.xxhash64(whole("text")) == F.col("__key")
    )
    return docs.join(found.distinct(), same, "left_anti")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return overlaps(docs, table(spark, folder, "benchmark", "item_id", "text")).drop("text_key")


def _sql_words(column: str) -> str:
    return f"""list_filter(string_split_regex(
      translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


_NEEDS = ", ".join(f"({n}, {needed(n)})" for n in range(1, BLOCK + 1))
# Every diagonal with enough equal words, every stretch on it; no hashes.
SQL = f"""
with need(stretch, need) as (values {_NEEDS}),
item as (
  select item_id, w, len(w) as n_words, stretch, need
  from (select distinct item_id, {_sql_words("text")} as w from benchmark)
  join need on stretch = least(len(w), {BLOCK})
),
doc as (select distinct doc_id, {_sql_words("text")} as w from documents),
at_item as (select item_id, n_words, stretch, need, j, w[j + 1] as word
  from (select *, unnest(range(n_words)) as j from item)),
at_doc as (select doc_id, i, w[i + 1] as word from (select *, unnest(range(len(w))) as i from doc)),
diagonal as (
  select doc_id, item_id, n_words, stretch, need, i - j as d, list(j) as js, count(*) as n_equal
  from at_doc join at_item using (word) group by all having count(*) >= need
),
stretches as (
  select *, len(list_filter(js, lambda j: j >= s and j < s + stretch)) as most
  from (select *, unnest(range(n_words - stretch + 1)) as s from diagonal)
)
select doc_id, item_id, n_words::bigint as n_words, n_equal::bigint as n_equal,
  (d + s)::bigint as first_word, most / stretch as share
from stretches where most >= need
qualify row_number() over (
  partition by doc_id, item_id order by most desc, n_equal desc, d, s) = 1
"""
