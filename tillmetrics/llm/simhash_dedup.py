"""SimHash near-duplicates: fingerprints within a Hamming radius, found with BK-trees.

A fingerprint's bit is set where over half of the document's shingle hashes have it set. Two
fingerprints that differ in at most `radius` of 64 bits, cut into radius + k blocks, agree in at
least k whole blocks; so every choice of k blocks makes shards, and each close pair meets in one
of them. In a shard a BK-tree is built, children keyed by their Hamming distance to the parent,
and a search follows only the edges within the radius of the distance.

Trees of all shards would grow with the corpus, so they aren't broadcast: Spark shuffles each
shard to a task, which builds its tree and searches it. Equal fingerprints are one node from the
start. A shard of more than CHUNK fingerprints is dealt out as pairs of chunks, each pair a task's
group of its own: one chunk is the tree, the other one searches it. A shard of n fingerprints so
becomes n * ceil(n / CHUNK) rows: three for each of 200,000, thirteen for each of a million. What a
search finds is joined up as it goes, so a group holds a root for each fingerprint and a bounded
number of links, however many pairs lie within the radius. It yields a star per connected set.
Components are joined up by Spark (graph.py).

k grows with the number of fingerprints so that unrelated ones seldom share a shard; any k finds
all pairs.

Null and empty texts have the fingerprint 0 and link like any other; repeated rows give repeated
results; a row without doc_id takes part, but names no component unless all of it lacks ids
(component_id is null then); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.graph import components
from tillmetrics.llm.text import shared_folder, table

SHINGLE = 4  # words
RADIUS = 4  # bits
CHUNK = 81_920  # fingerprints of a shard that one tree holds, or that search it
SLICE = 8192  # fingerprints that walk down a tree together
PENDING = 1 << 20  # links that are held before they are joined up
LEAF = 32  # fingerprints a node of a tree may hold unsplit
CROWD = 64  # unrelated fingerprints expected in a shard at most
SEED = 42


def simhash(text: bytes, size: int = SHINGLE) -> int:
    """Words between ASCII white space, A-Z lowered; a shorter text is a single shingle."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[: max(1, len(words) - size + 1)].tolist(), ends[size - 1 :].tolist() or [len(line)])
    counts, total, digest = np.zeros(64, np.int64), 0, xxhash.xxh64_intdigest
    while block := [digest(line[s:e], SEED) for s, e in itertools.islice(spans, 65536)]:
        bits = np.unpackbits(
            np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        )
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (a hash of the text) and fp, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t or b"", size) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(np.array(found, np.uint64).view(np.int64)),
                ],
                ["doc_id", "text_key", "fp"],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
        run, "doc_id long, text_key long, fp long"
    )


def _blocks(radius: int, same: int) -> list[tuple[int, int]]:
    """Lowest bit and width of radius + same blocks of 64 bits."""
    n = radius + same
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in itertools.pairwise(edges)]


def shard_keys(fp: Column, radius: int, same: int) -> Column:
    """A key for every choice of `same` blocks: the choice's number and the blocks' bits."""
    keys = []
    for number, chosen in enumerate(itertools.combinations(_blocks(radius, same), same)):
        key = F.lit(number).cast("long")
        for low, width in chosen:
            key = F.shiftleft(key, width).bitwiseOR(
                F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            )
        keys.append(key)
    return F.array(*keys)


def _same_blocks(fingerprints: int, radius: int) -> int:
    same = 1
    while (
        same < 5
        and fingerprints / 2 ** sum(sorted(w for _, w in _blocks(radius, same))[:same]) > CROWD
    ):
        same += 1
    return max(2, same) if radius < 32 else 1


class Tree:
    """BK-tree over distinct 64-bit fingerprints; small nodes keep theirs as a list."""

    def __init__(self, values: np.ndarray, ids: np.ndarray):
        self.values, self.ids, self.children = values, ids, {}
        if len(values) > LEAF:
            distance = np.bitwise_count(values[1:] ^ values[0])
            self.values, self.ids = values[:1], ids[:1]
            for d in np.unique(distance):
                at = distance == d
                self.children[int(d)] = Tree(values[1:][at], ids[1:][at])

    def walk(self, wanted: np.ndarray, ids: np.ndarray, radius: int) -> Iterator[np.ndarray]:
        """Arrays of (id wanted, id found) within the radius, a node at a time."""
        distance = np.bitwise_count(wanted[:, None] ^ self.values[None, :])
        rows, columns = np.nonzero(distance <= radius)
        if len(rows):
            yield np.stack([ids[rows], self.ids[columns]])
        if self.children:
            to_root = distance[:, 0].astype(np.int64)
            for edge, child in self.children.items():
                near = np.abs(to_root - edge) <= radius
                if near.any():
                    yield from child.walk(wanted[near], ids[near], radius)

    def search(self, wanted: np.ndarray, ids: np.ndarray, radius: int) -> list[np.ndarray]:
        return list(self.walk(wanted, ids, radius))


def _stars(root: np.ndarray, links: np.ndarray) -> np.ndarray:
    """The smallest member of each id's connected set, from that of sets known and links more."""
    while True:
        ends = root[links]
        links = ends[:, ends[0] != ends[1]]
        if not links.shape[1]:
            return root
        new = root.copy()
        np.minimum.at(new, links.max(axis=0), links.min(axis=0))
        while (new != new[new]).any():
            new = new[new]
        root = new


def links_of_shard(fps: np.ndarray, parts: np.ndarray, pair: tuple[int, int], radius: int):
    """Links that connect what lies within the radius in a shard, or between two of its chunks."""
    values, ids = fps.view(np.uint64), np.arange(len(fps))
    tree_side = parts == pair[0]
    search_side = parts == pair[1]
    tree = Tree(values[tree_side], ids[tree_side])
    wanted, known = values[search_side], ids[search_side]
    root, pending, held = ids, [], 0
    for at in range(0, len(wanted), SLICE):
        for found in tree.walk(wanted[at : at + SLICE], known[at : at + SLICE], radius):
            found = found[:, root[found[0]] != root[found[1]]]
            if found.shape[1]:
                pending.append(found)
                held += found.shape[1]
            if held > PENDING:
                root, pending, held = _stars(root, np.concatenate(pending, axis=1)), [], 0
    if held:
        root = _stars(root, np.concatenate(pending, axis=1))
    linked = root != ids
    return fps[linked], fps[root[linked]]


def _link_shards(radius: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in itertools.chain(frames, [None]):
            data = rest if frame is None else frame[["key", "low", "high", "part", "fp"]].to_numpy(np.int64)
            if data is None:
                return
            if frame is not None and rest is not None:
                data = np.concatenate([rest, data])
            cuts = np.flatnonzero((data[1:, :3] != data[:-1, :3]).any(axis=1)) + 1
            groups = np.split(data, cuts) if len(data) else []
            rest = groups.pop() if frame is not None and groups else None
            a, b = [], []
            for group in groups:
                if len(group) > 1:
                    x, y = links_of_shard(
                        np.ascontiguousarray(group[:, 4]), group[:, 3], tuple(group[0, 1:3]), radius
                    )
                    a.append(x), b.append(y)
            if a:
                yield pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def links(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links between distinct fingerprints `fp` that connect all pairs within the radius."""
    same = _same_blocks(fps.count(), radius)
    keys = fps.select("fp", F.explode(shard_keys(F.col("fp"), radius, same)).alias("key"))
    crowded = keys.groupBy("key").count().filter("count > 1")
    chunks = F.ceil(F.col("count") / chunk)
    dealt = (
        keys.join(crowded, "key")
        .withColumn("part", F.pmod(F.xxhash64("fp"), chunks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        .select(
            "key",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "part",
            "fp",
        )
    )
    return (
        dealt.repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
        .mapInPandas(_link_shards(radius), "a long, b long")
    )


def groups(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row: doc_id, text_key, fp, the group's root fingerprint and its smallest doc_id."""
    shared_folder(docs.sparkSession)
    rows = fingerprints(docs, size).checkpoint()
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    joined = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(joined, nodes["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select(F.col("fp").alias("node"), "root", "component_id")
    return rows.join(named, rows["fp"] == named["node"]).drop("node")


def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = groups(table(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of one document of each group: that with the smallest doc_id, all columns kept."""
    found = groups(docs.select("doc_id", "text"), size, radius)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")
    kept = found.groupBy("root").agg(F.min(order).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("__id"), F.col("k.text_key").alias("__key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key"))
    once = docs.join(kept, same, "left_semi")
    repeated = found.groupBy("doc_id", "text_key").count().filter("count > 1")
    return once if repeated.isEmpty() else once.dropDuplicates(["doc_id", "text"])
