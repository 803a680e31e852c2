"""Document fingerprints of spot signatures: what content words follow the common ones.

Common words (articles, prepositions and the like of four languages) are anchors. A signature is
an anchor with the chain of the next CHAIN content words, common ones in between left out; the
beginning of a text counts as an anchor. The set of a text's signatures, each a 32-bit hash, is its
fingerprint: sorted, eight hexadecimal digits each.

Text of other languages, code and lists have few of these words or none. Where a text of BARE words
or more has no anchor but its beginning, or GAP content words follow each other without one, every
word there is an anchor, so that signatures cover the whole text. This depends on the text alone: a
fingerprint does not change with the other documents. Shorter texts without a common word are still
known by their first CHAIN words only.

near_duplicates() compares fingerprints by Jaccard. Equal sets form a class, and its smallest
fingerprint row stands for it. Sets are partitioned by length so that partners lie in the same
partition or the next one; there, sets that share a signature among their rarest ones become
candidates, and the pruned comparison drops those whose lengths, or place of the first shared
signature, leave too little.

The query needs each document's neighbour in the order of doc_id: rows are dealt into ranges of
ids, whose bounds (at most MOST_RANGES ids) the driver holds, and each range also gets the first row of
the next one. That is one shuffle of the texts, without a task that sees all.

Null texts are empty and have no signatures; a text with words but without a whole chain has one
signature, of all its words. Two empty sets are equal (1.0). Rows of one doc_id are ordered by
their text, rows without doc_id come first; other columns are ignored; an empty table gives an
empty result; a single document is its own neighbour.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmetrics.llm.text import table, whole, words

CHAIN = 2  # content words
BARE = 10  # words of a text without any anchor that are anchors themselves
GAP = 32  # content words in a row that are, in other texts
THRESHOLD = 0.8
RANGE_ROWS = 2048  # rows that a range of ids holds, about, while there are less than MOST_RANGES
MOST_RANGES = 65_536

# Common words, by language.
COMMON = {
    "de": "auf aus das dem den der des die ein eine einen im in ist mit nicht sich sie und von zu",
    "en": "a an and are as at be by for from he in is it of on or that the this to was with",
    "es": "con de del el en es la las lo los no para por que se su un una y",
    "fr": "au aux avec ce dans de des du en est et il la le les par pas pour que qui sur un une",
}
ANCHORS = sorted({w for words_ in COMMON.values() for w in words_.split()})
MARK = "\x01"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def signatures(text: Column | str, chain: int = CHAIN) -> Column:
    """Sorted distinct signatures, as 32-bit hashes."""

    def marked(w: Column) -> Column:
        return F.when(w.isin(ANCHORS), F.concat(F.lit(MARK), w)).otherwise(w)

    def of_words(found: Column) -> Column:
        line = F.array_join(F.concat(F.array(F.lit(f"{MARK}^")), F.transform(found, marked)), " ")
        return _bound(line, lambda x: _signatures_of_line(x, F.size(found) > 0, chain))

    return _bound(words(text), of_words)


def _signatures_of_line(line: Column, has_words: Column, chain: int) -> Column:
    skipped, content = rf"(?: {MARK}\S+)*+", rf" [^{MARK} ]\S*+"
    pattern = rf"{MARK}(?=(\S++{(skipped + content) * chain}))"
    found = F.regexp_extract_all(line, F.lit(pattern), F.lit(1))
    rows_of = lambda n: F.regexp_extract_all(line, F.lit(rf"(?:{content}){{{n},}}+"), F.lit(0))
    chains = F.lit(rf" (?=(\S++(?: \S++){{{chain}}}))")
    filled = F.flatten(
        F.transform(
            F.when(line.contains(f" {MARK}"), rows_of(GAP)).otherwise(rows_of(BARE)),
            lambda s: F.regexp_extract_all(s, chains, F.lit(1)),
        )
    )
    made = F.transform(
        F.concat(found, filled), lambda s: F.hash(F.regexp_replace(s, rf" {MARK}\S+", ""))
    )
    none = F.when(has_words, F.array(F.hash(line))).otherwise(F.array().cast("array<int>"))
    return _bound(
        made, lambda m: F.array_sort(F.when(F.size(m) > 0, F.array_distinct(m)).otherwise(none))
    )


def fingerprint(sigs: Column | str) -> Column:
    unsigned = lambda s: s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    return F.lower(
        F.array_join(F.transform(sigs, lambda s: F.lpad(F.hex(unsigned(s)), 8, "0")), "")
    )


def jaccard(a: str, b: str) -> Column:
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, 1.0).otherwise(shared / either)


def pruned_jaccard(a: str, b: str, threshold: float) -> Column:
    """Null below the threshold; sets whose lengths rule it out are not compared."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    value = F.when(low >= threshold * high, jaccard(a, b))
    return F.when(value >= threshold, value)


def _range_bounds(docs: DataFrame) -> list[int]:
    """Ids that begin a range, the smallest id not among them."""
    size, least = docs.agg(F.count("doc_id"), F.min("doc_id")).first()
    ranges = min(MOST_RANGES, math.ceil(size / RANGE_ROWS))
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0]
    return sorted({x for x in found if x > least})


def _range_of(doc_id: str, bounds: list[int]) -> Column:
    """How many bounds are not above the id, by binary search in a literal array; null: none."""
    if not bounds:
        return F.lit(0)
    held = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get(held, at + step - 1) <= F.col(doc_id)), at + step
        ).otherwise(at),
    )


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and sigs, with the text and sigs of the next row by doc_id (last: the first)."""
    bounds = _range_bounds(docs)
    rows = docs.select("doc_id", whole("text").alias("text")).select(
        _range_of("doc_id", bounds).alias("range"),
        F.col("doc_id").isNotNull().alias("has_id"),
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        "text",
        F.lit(False).alias("guest"),
    )
    order = ["has_id", "doc_id", "text_key", "text"]
    begins = F.col("doc_id").isin(bounds) if bounds else F.lit(False)
    least = docs.agg(F.min("doc_id")).first()[0]
    begins = begins | F.col("doc_id").isNull()
    begins = begins | (F.col("doc_id") == least) if least is not None else begins
    guests = rows.filter(begins).groupBy("range").agg(F.min(F.struct(*order)).alias("first"))
    guests = guests.select(
        F.when(F.col("range") == 0, len(bounds)).otherwise(F.col("range") - 1).alias("range"),
        "first.*",
        F.lit(True).alias("guest"),
    )
    both = rows.unionByName(guests).withColumn("sigs", signatures("text"))
    window = W.partitionBy("range").orderBy("guest", *order)
    return (
        both.select(
            "doc_id",
            "text",
            "sigs",
            "guest",
            F.lead("text").over(window).alias("next_text"),
            F.lead("sigs").over(window).alias("next_sigs"),
        )
        .filter("not guest")
        .drop("guest")
    )


def op6_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_next(table(spark, folder, "documents", "doc_id", "text"))
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), size - cut), F.substring("next_text", F.lit(1), cut)
    )
    return (
        rows.withColumn("edited", edited)
        .withColumn("edited_sigs", signatures("edited"))
        .select(
            "doc_id",
            size.cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint("sigs").alias("fingerprint"),
            fingerprint("edited_sigs").alias("edited_fingerprint"),
            jaccard("sigs", "edited_sigs").alias("near_edited"),
            jaccard("sigs", "next_sigs").alias("near_next"),
        )
    )


def classes(docs: DataFrame) -> DataFrame:
    """doc_id with the hash of its fingerprint, which names its class."""
    return docs.select("doc_id", F.xxhash64(signatures("text")).alias("class_id"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of classes (a < b) whose signature sets have a Jaccard of `threshold` or more."""
    sets = (
        docs.select(signatures("text").alias("sigs"))
        .select(F.xxhash64("sigs").alias("class_id"), "sigs")
        .filter("size(sigs) > 0")
        .dropDuplicates(["class_id"])
    )
    counts = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").count()
    ranked = (
        sets.select("class_id", F.explode("sigs").alias("sig"))
        .join(counts, "sig")
        .groupBy("class_id")
        .agg(F.array_sort(F.collect_list(F.struct("count", "sig"))).alias("by_rarity"))
        .select("class_id", F.col("by_rarity.sig").alias("sigs"))
    )
    size = F.size("sigs")
    # Partners' lengths differ by 1/threshold at most, so by one partition at most.
    part = F.floor(F.log(size.cast("double")) / F.lit(-math.log(threshold)) + 1e-9)
    prefix = (size - F.ceil(size * threshold - 1e-9) + 1).cast("int")
    keys = ranked.select(
        "class_id",
        part.alias("part"),
        size.alias("size"),
        F.posexplode(F.slice("sigs", F.lit(1), prefix)).alias("place", "sig"),
    )
    probe = keys.select(
        F.col("class_id").alias("x"),
        F.col("size").alias("x_size"),
        F.col("place").alias("x_place"),
        "sig",
        F.col("part").alias("x_part"),
        F.explode(F.array("part", F.col("part") + 1)).alias("part"),
    )
    index = keys.withColumnsRenamed({"class_id": "y", "size": "y_size", "place": "y_place"})
    either = F.col("x_size") + F.col("y_size")
    most = F.least(F.col("x_size") - F.col("x_place"), F.col("y_size") - F.col("y_place"))
    close = (
        F.least("x_size", "y_size") >= threshold * F.greatest("x_size", "y_size") - 1e-9
    )
    ordered = (F.col("part") > F.col("x_part")) | (F.col("x") < F.col("y"))
    # The first shared signature bounds what can still be shared; later ones of the same pair would
    # bound it too low, so only the highest bound of a pair counts.
    candidates = (
        probe.join(index, ["sig", "part"])
        .filter(close & ordered & (F.col("x") != F.col("y")))
        .groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), either.alias("both"))
        .agg(F.max(most).alias("most"))
        .filter(F.col("most") >= F.col("both") * threshold / (1 + threshold) - 1e-9)
        .select("a", "b")
    )
    left = sets.select(F.col("class_id").alias("a"), F.col("sigs").alias("a_sigs"))
    right = sets.select(F.col("class_id").alias("b"), F.col("sigs").alias("b_sigs"))
    return (
        candidates.join(left, "a")
        .join(right, "b")
        .select("a", "b", pruned_jaccard("a_sigs", "b_sigs", threshold).alias("jaccard"))
        .filter("jaccard is not null")
    )
