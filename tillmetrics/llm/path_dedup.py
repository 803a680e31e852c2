"""Removes every word covered by WINDOW words that also start in a document with a smaller id.

The words of the corpus make a De Bruijn graph: a window of WINDOW words is an edge from its first
to its last WINDOW - 1 words. Documents are walks, and passages that documents share are paths.

1. Edges: each task names its texts' windows and cuts the walks where the anchor changes, the
   smallest name of ANCHOR words in a window. The anchor depends on the window's words alone, so a
   shared passage is cut alike in all its documents. A piece is one row: the anchor, a name of
   BYTES bytes for each of its windows, document and place. Of equal pieces in a batch, all but those of
   the smallest document are settled at once.
2. Spark brings the pieces of an anchor together. Of equal ones, the smallest document's is the
   source; the others are claims on it. Where an anchor has several different pieces, single
   windows may still be equal: those of the sources left over are dealt by name, and the smallest
   document of each window is found by an aggregation and a join, which Spark can split.
   An anchor with more than CROWD different pieces in one batch sends its windows straight there.
3. Compaction: claims of a document that follow each other in it and in their source become one
   span. Spans that follow each other without a branch (each is the only one after, or before, the
   other wherever they occur) have the same `path`: links between them are joined by Spark
   until each knows the least span of its path.
4. Verification: the texts meet their spans and the places where they are the source of others,
   and both sides give a digest of the words at these coordinates. A span whose digest is not its
   source's (names collided, or rows share an id and differ in text) is not removed: such texts are
   cut again without it.

Null texts have no words. Rows without doc_id lose nothing and are nobody's source. Rows with the same
doc_id are neither's source; each loses what its own text shares with smaller ids. Repeats within a document
stay. Texts of fewer than WINDOW words, and empty ones, are returned as they are. Long texts are
named in slices; a text is cut, and hashed, in one piece. Columns other than doc_id and text are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmetrics.llm.graph import components
from tillmetrics.llm.names import of_length, pair, sliding_min
from tillmetrics.llm.text import shared_folder, table, whole

WINDOW = 13  # words
ANCHOR = 5
BYTES = 5  # of a window's name, beside the anchor's eight
SLICE = 1 << 19  # bytes named at a time
PLACE = 20  # bits for a word's place in a slice
CROWD = 16  # different pieces of one anchor in a batch
PIECES = 1 << 20  # sorted at once in a task
SETTLED, OPEN, APART = 0, 1, 2  # claims; pieces to be compared; pieces of crowded anchors

U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
ROW = "kind int, part long, anchor long, names binary, doc long, at long, source long, source_at long"
FIELDS = [x.split()[0] for x in ROW.split(", ")]


def bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    edge = np.diff(np.r_[True, WHITE[data], True].astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    byte = data[np.repeat(starts, sizes) + place]
    return pair(np.add.reduceat(pair(place.astype(U), byte.astype(U)), first), sizes.astype(U))


def slices(texts: list[bytes]) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Bytes to be named together, and (text, word number of the first word, first byte) of its parts.

    Short texts go together. Long ones are cut between words; the next slice begins with the words
    whose windows the last one could not finish.
    """
    parts, held, total = [], [], 0
    for i, text in enumerate(texts):
        if len(text) > SLICE:
            yield from _long(i, np.frombuffer(text, np.uint8))
            continue
        if held and total + len(text) > SLICE:
            yield np.frombuffer(b"".join(held), np.uint8), parts
            parts, held, total = [], [], 0
        parts.append((i, 0, total))
        held += [text, b" "]
        total += len(text) + 1
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), parts


def _long(i: int, data: np.ndarray) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    first, number, size = 0, 0, SLICE
    while True:
        part = data[first : first + size]
        if first + size >= len(data):
            yield part, [(i, number, 0)]
            return
        starts, ends = bounds(part)
        done = len(starts) - (len(ends) > 0 and ends[-1] == len(part))  # the last may go on
        if done < 2 * WINDOW:
            size *= 2  # words as long as slices
            continue
        yield part[: ends[done - 1]], [(i, number, 0)]
        first += int(starts[done - WINDOW + 1])
        number += int(done) - WINDOW + 1
        size = SLICE


def pieces(texts: list[bytes]) -> Iterator[tuple]:
    """For each slice: anchor, content, text, first window and number of windows, and their names."""
    for data, parts in slices(texts):
        starts, ends = bounds(data)
        if len(starts) < WINDOW:
            continue
        text, number, begin = (np.array(x, np.int64) for x in zip(*parts))
        own = np.searchsorted(begin, starts, side="right") - 1
        number = number[own] + np.arange(len(own)) - np.searchsorted(own, own)
        names = {1: word_names(data, starts, ends)}
        for k in (1, 2, 4):
            names[2 * k] = pair(names[k][:-k], names[k][k:])
        short, full = of_length(names, ANCHOR), of_length(names, WINDOW)
        key = short >> U(PLACE) << U(PLACE) | np.arange(len(short), dtype=U)
        least = sliding_min(key, WINDOW - ANCHOR + 1) & U((1 << PLACE) - 1)
        window = np.flatnonzero(own[: len(full)] == own[WINDOW - 1 :])
        if not len(window):
            continue
        anchor = least[window].astype(np.int64)
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)) + 1
        low, high = window[np.r_[0, new]], window[np.r_[new - 1, len(window) - 1]]
        count = high - low + 1
        # No piece is longer than its two ends together, so they stand for all of it.
        content = pair(pair(full[low], full[high]), count.astype(U))
        shown = full[window].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :BYTES]
        yield short[anchor[np.r_[0, new]]], content, text[own[low]], number[low], count, shown


def _pack(first, count):
    return first << 8 | count


def _binary(names: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of names, `ends` of them in each value."""
    offsets = np.r_[0, ends * BYTES].astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(names.tobytes())]
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends), buffers)


def _settle(anchor, content, doc, at, names) -> Iterator[pa.RecordBatch]:
    """Claims on smaller documents of the same batch, and the pieces left over."""
    count = at & 255
    begin = np.cumsum(count) - count
    order = np.lexsort((at, doc, content, anchor))
    a, c, d = anchor[order], content[order], doc[order]
    other = np.r_[True, a[1:] != a[:-1]]
    new = other | np.r_[True, c[1:] != c[:-1]]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]  # the source, for each piece
    claim = d > d[first]
    # Contents of each anchor, numbered: all but two of a crowded one go apart.
    rank = np.cumsum(new) - 1
    rank -= rank[np.flatnonzero(other)[np.cumsum(other) - 1]]
    last = np.r_[np.flatnonzero(other)[1:] - 1, len(a) - 1]
    crowded = rank[last[np.cumsum(other) - 1]] >= CROWD
    apart = ~claim & crowded & (rank > 1)

    def nulls(n, kind=pa.int64()):
        return pa.nulls(n, kind)

    rows, sources = order[claim], order[first[claim]]
    n = len(rows)
    spread = pair(doc[rows].view(U), at[rows].view(U)).view(np.int64)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, SETTLED, np.int32)), pa.array(spread), nulls(n), nulls(n, pa.binary()),
            pa.array(doc[rows]), pa.array(at[rows]), pa.array(doc[sources]), pa.array(at[sources] >> 8),
        ],
        FIELDS,
    )
    for kind, chosen in ((OPEN, ~claim & ~apart), (APART, apart)):
        rows = order[chosen]
        n, size = len(rows), count[rows]
        ends = np.cumsum(size)
        step = np.arange(int(size.sum())) - np.repeat(ends - size, size)
        part = anchor[rows] if kind == OPEN else pair(doc[rows].view(U), at[rows].view(U))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, kind, np.int32)), pa.array(part.view(np.int64)),
                pa.array(anchor[rows].view(np.int64)), _binary(names[np.repeat(begin[rows], size) + step], ends),
                pa.array(doc[rows]), pa.array(at[rows]), nulls(n), nulls(n),
            ],
            FIELDS,
        )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ROW for the pieces of a task's texts."""
    found, waiting = [], 0

    def settled() -> Iterator[pa.RecordBatch]:
        yield from _settle(*[np.concatenate(x) for x in zip(*found)])

    for batch in batches:
        docs = batch.column("doc_id").to_numpy()
        texts = [t.encode("utf-8") for t in batch.column("text").to_pylist()]
        for anchor, content, text, first, count, names in pieces(texts):
            found.append((anchor, content, docs[text], _pack(first, count), names))
            waiting += len(anchor)
            if waiting > PIECES:
                yield from settled()
                found, waiting = [], 0
        if found:
            yield from settled()
            found, waiting = [], 0


def _stage(rows: DataFrame, name: str) -> DataFrame:
    folder = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def claims(texts: DataFrame) -> DataFrame:
    """doc, first, n, source, source_first: windows, and where a smaller document has them."""
    rows = texts.select("doc_id", "text").mapInArrow(_edges, ROW).repartition("part")
    of_anchor = W.partitionBy("part")
    equal = W.partitionBy("part", "names").orderBy("doc", "at")
    first = F.first(F.struct("doc", "at")).over(equal)
    judged = rows.withColumn("s", first).withColumn(
        "several", F.min("names").over(of_anchor) != F.max("names").over(of_anchor)
    )
    smaller = (F.col("kind") == OPEN) & (F.col("doc") > F.col("s.doc"))
    claimed = (F.col("kind") == SETTLED) | smaller
    left = (F.col("kind") == APART) | ((F.col("kind") == OPEN) & F.col("several"))
    judged = _stage(
        judged.filter(claimed | left).select(
            "anchor",
            F.when(~claimed, F.col("names")).alias("names"),
            "doc",
            "at",
            F.when(smaller, F.col("s.doc")).otherwise(F.col("source")).alias("source"),
            F.when(smaller, F.shiftright("s.at", 8)).otherwise(F.col("source_at")).alias("source_first"),
        ),
        "pieces",
    )
    first, count = F.shiftright("at", 8), F.col("at").bitwiseAND(F.lit(255).cast("long"))
    whole_pieces = judged.filter(F.col("names").isNull()).select(
        "doc", first.alias("first"), count.alias("n"), "source", "source_first"
    )
    place = F.explode(F.sequence(F.lit(0).cast("long"), count - 1))
    windows = (
        judged.filter(F.col("names").isNotNull())
        .select("anchor", "names", "doc", first.alias("first"), place.alias("k"))
        .select(
            F.xxhash64(
                "anchor", F.substring("names", (F.col("k") * BYTES + 1).cast("int"), F.lit(BYTES))
            ).alias("name"),
            "doc",
            (F.col("first") + F.col("k")).alias("first"),
        )
    )
    least = (
        windows.groupBy("name")
        .agg(F.min(F.struct("doc", "first")).alias("s"), F.max("doc").alias("most"))
        .filter(F.col("most") > F.col("s.doc"))
        .select(F.col("name").alias("name_"), "s")
    )
    single = (
        windows.join(least, F.col("name") == F.col("name_"))
        .filter(F.col("doc") > F.col("s.doc"))
        .select("doc", "first", F.lit(1).cast("long"), F.col("s.doc"), F.col("s.first"))
    )
    return whole_pieces.union(single)


def spans(texts: DataFrame) -> DataFrame:
    """doc, first, n, source, source_first, span, path: claims that go on, and what they are part of.

    `first` and `source_first` are word numbers, n is the number of windows; `span` is an id of
    source, source_first and n, and `path` that of the least span of a path without branches.
    """
    follow = W.partitionBy("doc", "source", "shift").orderBy("first")
    before = F.max(F.col("first") + F.col("n")).over(follow.rowsBetween(W.unboundedPreceding, -1))
    found = (
        claims(texts)
        .withColumn("shift", F.col("first") - F.col("source_first"))
        .repartition("doc")
        .withColumn("new", F.when(F.col("first") <= before, 0).otherwise(1))
        .withColumn("island", F.sum("new").over(follow.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("doc", "source", "shift", "island")
        .agg(F.min("first").alias("first"), F.max(F.col("first") + F.col("n")).alias("end"))
        .select(
            "doc",
            "first",
            (F.col("end") - F.col("first")).alias("n"),
            "source",
            (F.col("first") - F.col("shift")).alias("source_first"),
        )
        .withColumn("span", F.xxhash64("source", "source_first", "n"))
    )
    found = _stage(found, "spans")
    return found.join(
        _paths(found).withColumnRenamed("span", "span_"), F.col("span") == F.col("span_"), "left"
    ).select(*found.columns, F.coalesce("path", "span").alias("path"))


def _paths(found: DataFrame) -> DataFrame:
    """span, path for the spans on paths of more than one."""
    along = W.partitionBy("doc").orderBy("first", "n", "span")
    links = (
        found.withColumn("next", F.lead("span").over(along))
        .withColumn("met", F.lead("first").over(along) == F.col("first") + F.col("n"))
        .filter("met")
        .groupBy(F.col("span").alias("a"), F.col("next").alias("b"))
        .agg(F.count(F.lit(1)).alias("walks"))
    )
    times = found.groupBy("span").agg(F.count(F.lit(1)).alias("times"))
    # Without a branch: both occur as often as the link between them.
    for end in ("a", "b"):
        links = links.join(times, F.col(end) == F.col("span")).filter("walks = times")
        links = links.select("a", "b", "walks")
    rooted = components(links.select("a", "b"))
    return rooted.toDF("span", "path")


# --- the texts, cut -----------------------------------------------------------------------------


def covered(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of words, as (first, end), under windows given as (first, number)."""
    made: list[list[int]] = []
    for first, n in sorted(found):
        end = first + n + WINDOW - 1
        if made and first <= made[-1][1]:
            made[-1][1] = max(made[-1][1], end)
        else:
            made.append([first, end])
    return [(a, b) for a, b in made]


def _digest(words: list[bytes], first: int, n: int) -> int | None:
    end = first + n + WINDOW - 1
    if end > len(words):
        return None  # of another text with this id
    said = hashlib.blake2b(b" ".join(words[first:end]), digest_size=8).digest()
    return int.from_bytes(said, "little", signed=True)


MADE = (
    "n_words long, n_removed long, n_runs long, n_paths long, kept_sha256 string, kept_text string, "
    "own array<struct<span: long, digest: long>>, asked array<struct<span: long, digest: long>>"
)
PAIRS = pa.list_(pa.struct([("span", pa.int64()), ("digest", pa.int64())]))
KINDS = [pa.int64()] * 4 + [pa.string()] * 2 + [PAIRS] * 2
MADE_FIELDS = "n_words n_removed n_runs n_paths kept_sha256 kept_text own asked".split()


def _cut(as_text: bool) -> Callable:
    def one(text: str | None, own: list[dict], asked: list[dict]) -> tuple:
        words = (text or "").encode("utf-8").split()
        digests = [
            [{"span": s["span"], "digest": _digest(words, s["first"], s["n"])} for s in side]
            for side in (own, asked)
        ]
        gone = covered([(s["first"], s["n"]) for s in own])
        gone = [(a, min(b, len(words))) for a, b in gone if a < len(words)]
        edges = [0, *[x for span in gone for x in span], len(words)]
        kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
        said = b" ".join(kept)
        paths = len({s["path"] for s in own})
        return (
            len(words), len(words) - len(kept), len(gone), paths, hashlib.sha256(said).hexdigest(),
            said.decode("utf-8") if as_text else None, *digests,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, own, asked = (batch.column(c).to_pylist() for c in ("text", "own", "asked"))
            made = [one(t, o or [], a or []) for t, o, a in zip(texts, own, asked)]
            columns = list(zip(*made)) or [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    *[pa.array(c, k) for c, k in zip(columns, KINDS)],
                ],
                ["doc_id", "text_key", *MADE_FIELDS],
            )

    return run


OUT = f"doc_id long, text_key long, {MADE}"


def remove_repeats(docs: DataFrame, as_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, n_runs and n_paths removed, kept_sha256, and kept_text if asked for.

    n_runs counts the maximal removed runs of words, n_paths the paths that they are part of.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole("text").alias("text"))
    named = texts.filter(F.col("doc_id").isNotNull() & (F.length("text") >= 2 * WINDOW - 1))
    found = _stage(spans(named), "paths")
    own = found.select(
        "doc",
        F.struct("first", "n", "span", "path").alias("own"),
        F.lit(None).cast("struct<first: long, n: long, span: long>").alias("asked"),
    )
    asked = found.select("source", "source_first", "n", "span").distinct().select(
        F.col("source").alias("doc"),
        F.lit(None).cast("struct<first: long, n: long, span: long, path: long>").alias("own"),
        F.struct(F.col("source_first").alias("first"), "n", "span").alias("asked"),
    )
    by_doc = own.union(asked).groupBy("doc").agg(
        F.collect_list("own").alias("own"), F.collect_list("asked").alias("asked")
    )
    keyed = texts.withColumn("text_key", F.xxhash64("text"))
    cut = _stage(
        keyed.join(by_doc, F.col("doc_id") == F.col("doc"), "left")
        .select("doc_id", "text_key", "text", "own", "asked")
        .mapInArrow(_cut(as_text), OUT),
        "cut",
    )
    sides = [
        cut.select("doc_id", "text_key", F.explode(c).alias("x")).select(
            "doc_id", "text_key", "x.span", "x.digest"
        )
        for c in ("own", "asked")
    ]
    true = sides[1].select(F.col("span").alias("s"), F.col("digest").alias("d")).distinct()
    same = (F.col("span") == F.col("s")) & (F.col("digest") == F.col("d"))
    # Spans that many documents have are one row each here.
    said = sides[0].select("span", F.coalesce("digest", F.lit(0)).alias("digest")).distinct()
    refuted = _stage(said.join(true, same, "left_anti"), "refuted")
    result = cut.drop("own", "asked")
    if not refuted.isEmpty():
        refuted = refuted.select(F.col("span").alias("s"), F.col("digest").alias("d"))
        told = (F.col("span") == F.col("s")) & (F.coalesce("digest", F.lit(0)) == F.col("d"))
        wrong = sides[0].join(refuted, told, "left_semi").select("doc_id", "text_key").distinct()
        again = wrong.select(F.col("doc_id").alias("i"), F.col("text_key").alias("k"))
        these = (F.col("doc_id") == F.col("i")) & (F.col("text_key") == F.col("k"))
        right = sides[0].join(true, same, "left_semi").join(again, these, "left_semi").distinct()
        right = right.select("doc_id", "text_key", F.col("span").alias("s"))
        here = found.join(right, (F.col("doc") == F.col("doc_id")) & (F.col("span") == F.col("s")))
        here = here.groupBy(F.col("doc_id").alias("i"), F.col("text_key").alias("k")).agg(
            F.collect_list(F.struct("first", "n", "span", "path")).alias("own")
        )
        empty = F.lit(None).cast("array<struct<first: long, n: long, span: long>>")
        redone = (
            keyed.join(again, these, "left_semi")
            .join(here, these, "left")
            .select("doc_id", "text_key", "text", "own", empty.alias("asked"))
            .mapInArrow(_cut(as_text), OUT)
            .drop("own", "asked")
        )
        result = result.join(again, these, "left_anti").union(redone)
    return result.drop("text_key", *(() if as_text else ("kept_text",)))


def op13_path_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents", "doc_id", "text"), as_text=False)
