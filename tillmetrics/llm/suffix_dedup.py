"""Removes every byte covered by a string of LENGTH bytes that also starts elsewhere in the corpus.

Prefix doubling with names for ranks (names.py): the name of a position's first 2k bytes is that
of the pair of names at the position and k further on. Positions that share a name of one length
go on to the next, others are unique and drop out, until the length asked for.

Ranking all positions at all lengths would shuffle many times the corpus, so the positions travel
in runs. The anchor of a window of LENGTH bytes is the smallest of the names of GRAM bytes in it
(the first one among equals); it depends on the window's bytes alone, so equal windows have
equal anchors at equal offsets. Neighbouring windows with the same anchor make a run.

1. Each task names its texts, finds the runs and gives one row for each distinct run in it: the
   anchor's name g, and c, the name of all bytes the run's windows cover.
2. Spark sorts the rows by (g, c). A run alone in its g is unique. Runs that share g and c repeat
   with all their windows. Where one g has several c, some windows may be equal: one run of
   each c goes on with its bytes.
3. Spark sorts those by g, and tasks name their single windows, at LENGTH bytes. Windows of a g with
   more than CROWD runs are named where their text is read, and dealt by name and offset without
   their bytes: neighbours of one name are repeats, so no group is held as a whole.
4. The starts of repeated windows meet their texts again, and the covered bytes go.

Copies within a task are merged before the shuffle, so a text or passage with a third of all rows
is a row for each task in step 2. Names are 64-bit hashes (the first 8 bytes are exact); rows are
only equal if the two names g and c, made at different lengths, both are. Step 2 is written to the
shared checkpoint folder and read from there.

Null texts are empty; texts shorter than LENGTH lose nothing; rows repeated in the table are
copies of each other and lose all they have if they are long enough, with or without doc_id;
extra columns are kept by `remove_repeats` and ignored by the query; an empty table gives an empty
result. Overlapping repeats, also with themselves, count.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.names import doubled, of_length, pair, sliding_min
from tillmetrics.llm.text import shared_folder, table, whole

LENGTH = 200  # bytes
GRAM = 40  # bytes of an anchor
PIECE = 1 << 18  # bytes named at a time
PLACE = 20  # bits for a place in a piece
CROWD = 4096  # runs of one anchor that a task compares at once
REPEATED, OPEN = 0, 1  # kinds of rows: windows known to repeat; runs to be compared by window

U = np.uint64
ROW = "kind long, g long, c long, n long, doc_key long, text_key long, at long"
NAMES = [x.split()[0] for x in ROW.split(", ")]


def _pack(first, windows, offset):
    """A run's first window, its number of windows and the anchor's place behind the first."""
    return first << 16 | (windows - 1) << 8 | offset


def _unpack(at):
    return at >> 16, (at >> 8 & 255) + 1, at & 255


def _pieces(sizes: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """(text, first byte, end) whose bytes are named together; long texts are cut, with overlap."""
    made, total = [], 0
    for text in np.flatnonzero(sizes >= length):
        size = int(sizes[text])
        for first in range(0, size - length + 1, PIECE):
            part = (int(text), first, min(size, first + PIECE + length - 1))
            if total and total + part[2] - part[1] > PIECE:
                yield made
                made, total = [], 0
            made.append(part)
            total += part[2] - part[1]
    if made:
        yield made


def runs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int):
    """Arrays g, c, text, and packed place of the runs of windows in texts that lie in `data`."""
    found = []
    for parts in _pieces(sizes, length):
        text, first, end = (np.array(x, np.int64) for x in zip(*parts))
        begin = starts[text] + first
        buffer = np.concatenate(
            [*[data[b : b + n] for b, n in zip(begin, end - first)], np.zeros(8, np.uint8)]
        )
        names = doubled(buffer, length)
        short, full = of_length(names, gram), of_length(names, length)
        place = np.arange(len(short), dtype=U)
        key = short >> U(PLACE) << U(PLACE) | place
        least = sliding_min(key, length - gram + 1) & U((1 << PLACE) - 1)
        ends = np.cumsum(end - first)
        part = np.repeat(np.arange(len(parts)), end - first)
        window = np.flatnonzero(np.arange(len(part)) + length <= ends[part])
        anchor = least[window].astype(np.int64)
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)) + 1
        low, high = window[np.r_[0, new]], window[np.r_[new - 1, len(window) - 1]]
        at = anchor[np.r_[0, new]]
        own = part[low]
        packed = _pack(low - (ends - (end - first))[own] + first[own], high - low + 1, at - low)
        shape = ((at - low) << 8 | (high - low)).astype(U)
        found.append(
            (short[at], pair(pair(full[high], full[low]), shape), text[own], packed)
        )
    if not found:
        return [np.empty(0, t) for t in (U, U, np.int64, np.int64)]
    return [np.concatenate(x) for x in zip(*found)]


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buffer that holds a column's texts, and each text's start and size."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return held, offsets[:-1], np.diff(offsets)


def _batch(columns: list, names: list[str] = NAMES) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names
    )


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows with about PIECE bytes of the column, or one row."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    first = 0
    while first < len(size):
        before = size[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(size, before + PIECE, side="right")))
        yield batch.slice(first, end - first)
        first = end


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _find_runs(length: int, gram: int) -> Callable:
    """Distinct runs of the task; all but the first of equal ones are known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, c, text, at = runs(*_bytes_of(batch.column("text")), length, gram)
            if not len(g):
                continue
            keys = [batch.column(x).to_numpy()[text] for x in ("doc_key", "text_key")]
            order = np.lexsort((c, g))
            same = (g[order][1:] == g[order][:-1]) & (c[order][1:] == c[order][:-1])
            begin = np.flatnonzero(np.r_[True, ~same])
            n = np.diff(np.r_[begin, len(order)])
            one = order[begin]
            rest = order[1:][same]
            for kind, rows, count in ((OPEN, one, n), (REPEATED, rest, np.ones(len(rest)))):
                yield _batch(
                    [
                        np.full(len(rows), kind, np.int64),
                        _signed(g[rows]) if kind == OPEN else np.ascontiguousarray(at[rows]),
                        _signed(c[rows]),
                        count.astype(np.int64),
                        *[k[rows] for k in keys],
                        at[rows],
                    ]
                )

    return run


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by kind, g and c: what repeats as a whole, and a run of each c where c differ."""
    rest, before = None, None  # rows of the last, maybe unfinished c; the g before it

    def judge(rows: np.ndarray, following: int | None) -> Iterator[pa.RecordBatch]:
        nonlocal before
        known = rows[0] == REPEATED
        if known.any():
            yield _batch(list(rows[:, known]))
        rows = rows[:, ~known]
        if not rows.shape[1]:
            return
        begin = np.flatnonzero(np.r_[True, (rows[1:3, 1:] != rows[1:3, :-1]).any(axis=0)])
        g, total = rows[1, begin], np.add.reduceat(rows[3], begin)
        size = np.diff(np.r_[begin, rows.shape[1]])
        shared = np.r_[g[0] == before if before is not None else False, g[1:] == g[:-1]]
        shared[:-1] |= g[:-1] == g[1:]
        shared[-1] |= following is not None and following == g[-1]
        before = g[-1]
        repeated = rows[:, np.repeat(total > 1, size)].copy()
        repeated[0] = REPEATED
        yield _batch(list(repeated))
        several = rows[:, begin[shared]].copy()
        several[3] = total[shared]
        yield _batch(list(several))

    for batch in batches:
        rows = np.stack([batch.column(x).to_numpy() for x in NAMES])
        rows = rows if rest is None else np.concatenate([rest, rows], axis=1)
        if not rows.shape[1]:
            continue
        last = np.flatnonzero((rows[:3] != rows[:3, -1:]).any(axis=0))
        cut = last[-1] + 1 if len(last) else 0
        rest = rows[:, cut:]
        if cut:
            yield from judge(rows[:, :cut], int(rest[1, 0]) if rest[0, 0] == OPEN else None)
    if rest is not None:
        yield from judge(rest, None)


WINDOWS = "g long, part long, name long, n long, doc_key long, text_key long, at long, bytes binary"
FIELDS = [x.split()[0] for x in WINDOWS.split(", ")]


def _named(crowded: list[tuple], length: int) -> pa.RecordBatch:
    """A row without bytes for each window of the runs of crowded anchors."""
    g, n, doc_key, text_key, first, windows, offset, held = zip(*crowded)
    sizes = np.array([len(b) for b in held])
    full = of_length(doubled(np.frombuffer(b"".join(held) + bytes(8), np.uint8), length), length)
    windows = np.array(windows)
    row = np.repeat(np.arange(len(g)), windows)
    step = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    g, n, doc_key, text_key, first, offset = (
        np.array(x, np.int64)[row] for x in (g, n, doc_key, text_key, first, offset)
    )
    name = full[(np.cumsum(sizes) - sizes)[row] + step]
    at = _pack(first + step, np.ones_like(step), np.zeros_like(step))
    columns = [g, offset - step, _signed(name), n, doc_key, text_key, at]
    return _batch([*columns, pa.nulls(len(row), pa.binary())], FIELDS)


def _fetch_bytes(length: int) -> Callable:
    """The bytes of the open runs of each text; of a crowded anchor, the names of all windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crowded, waiting = [], 0
        for part in (p for batch in batches for p in _slices(batch, "text")):
            made = []
            for row in part.to_pylist():
                text = row["text"].encode("utf-8")
                for x in row["runs"]:
                    first, windows, offset = _unpack(x["at"])
                    held = text[first : first + windows + length - 1]
                    keys = (x["n"], row["doc_key"], row["text_key"])
                    if not x["crowded"]:
                        made.append((x["g"], -1, 0, *keys, x["at"], held))
                        continue
                    crowded.append((x["g"], *keys, first, windows, offset, held))
                    waiting += len(held)
                    if waiting > PIECE:
                        yield _named(crowded, length)
                        crowded, waiting = [], 0
            if made:
                columns = list(zip(*made))
                yield _batch(
                    [pa.array(c, pa.int64()) for c in columns[:-1]]
                    + [pa.array(columns[-1], pa.binary())],
                    FIELDS,
                )
        if crowded:
            yield _named(crowded, length)

    return run


def _compare_windows(length: int) -> Callable:
    """Rows sorted by g, part and name: runs of windows equal to one of another row of the group."""

    def named(rows: np.ndarray, shared: np.ndarray) -> pa.RecordBatch:
        """Windows that share their name with a neighbour and are not known to repeat."""
        _, _, _, _, doc_key, text_key, at = rows[:, shared & (rows[3] == 1)]
        zero = np.zeros(len(at), np.int64)
        return _batch([zero, zero, zero, zero + 2, doc_key, text_key, at])

    def judge(rows: pa.Table) -> pa.RecordBatch | None:
        g, _, _, n, doc_key, text_key, at = (
            rows.column(i).combine_chunks().to_numpy() for i in range(7)
        )
        held = rows.column(7).combine_chunks()
        data, starts, sizes = _bytes_of(held.chunk(0) if isinstance(held, pa.ChunkedArray) else held)
        first, windows, offset = _unpack(at)
        buffer = np.concatenate(
            [data[starts[0] : starts[0] + int(sizes.sum())], np.zeros(8, np.uint8)]
        )
        full = of_length(doubled(buffer, length), length)
        begin = starts - starts[0]
        row = np.repeat(np.arange(len(g)), windows)
        step = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        name = full[begin[row] + step]
        place = (offset[row] - step).astype(U)
        key = pair(pair(name, place), g[row].view(U))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        repeated = np.zeros(len(row), bool)
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        hit = np.flatnonzero(repeated & (n[row] == 1))
        if not len(hit):
            return None
        new = np.flatnonzero((row[hit][1:] != row[hit][:-1]) | (hit[1:] != hit[:-1] + 1)) + 1
        low, high = hit[np.r_[0, new]], hit[np.r_[new - 1, len(hit) - 1]]
        own = row[low]
        zero = np.zeros(len(own), np.int64)
        return _batch(
            [zero, zero, zero, zero + 2, doc_key[own], text_key[own]]
            + [_pack(first[own] + step[low], high - low + 1, zero)]
        )

    def judged(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole groups, about PIECE bytes of them at a time."""
        g = rows.column(0).to_numpy()
        ends = np.r_[np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)]
        size = np.cumsum(pc.binary_length(rows.column(7)).to_numpy())[ends - 1]
        first = done = 0
        while first < len(g):
            k = max(done, int(np.searchsorted(size, (size[done - 1] if done else 0) + PIECE, "right")) - 1)
            made = judge(rows.slice(first, int(ends[k]) - first))
            if made is not None:
                yield made
            first, done = int(ends[k]), k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        last, shared = np.empty((7, 0), np.int64), False  # the last window with a name; if it repeats
        for batch in batches:
            of_run = pc.less(batch.column(1), 0)
            names = batch.filter(pc.invert(of_run))
            if names.num_rows:
                own = np.stack([names.column(i).to_numpy() for i in range(7)])
                own = np.concatenate([last, own], axis=1)
                same = (own[:3, 1:] == own[:3, :-1]).all(axis=0)
                repeated = np.r_[shared, same]
                repeated[:-1] |= same
                yield named(own[:, :-1], repeated[:-1])
                last, shared = own[:, -1:].copy(), bool(repeated[-1])
            rows = pa.Table.from_batches([batch.filter(of_run)])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            g = rows.column(0).to_numpy()
            ends = np.flatnonzero(g != g[-1]) if len(g) else []
            cut = int(ends[-1]) + 1 if len(ends) else 0
            rest = rows.slice(cut)
            if cut:
                yield from judged(rows.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from judged(rest)
        yield named(last, np.full(last.shape[1], shared))

    return run


def keys() -> tuple[Column, Column]:
    """What a text is known by: rows equal in both share their text, and so all that is found."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.xxhash64(whole("text"))


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD):
    """doc_key, text_key, starts: runs of windows, as (first, last), that also start elsewhere."""
    spark = docs.sparkSession
    doc_key, text_key = keys()
    texts = docs.select(
        doc_key.alias("doc_key"), text_key.alias("text_key"), whole("text").alias("text")
    )
    rows = texts.mapInArrow(_find_runs(length, gram), ROW)
    folder = f"{shared_folder(spark)}/repeats-{uuid.uuid4().hex}"
    (
        rows.repartition("g")
        .sortWithinPartitions("kind", "g", "c")
        .mapInArrow(_compare_runs, ROW)
        .write.parquet(folder)
    )
    judged = spark.read.schema(ROW).parquet(folder)
    open_runs = judged.filter(F.col("kind") == OPEN)
    crowded = (
        open_runs.groupBy("g").count().filter(F.col("count") > crowd).select(F.col("g").alias("g_"))
    )
    marked = open_runs.join(crowded, F.col("g") == F.col("g_"), "left").select(
        "doc_key",
        "text_key",
        F.struct("g", F.least("n", F.lit(2)).alias("n"), "at", F.col("g_").isNotNull().alias("crowded"))
        .alias("run"),
    )
    by_text = marked.groupBy("doc_key", "text_key").agg(F.collect_set("run").alias("runs"))
    held = (
        texts.join(by_text, ["doc_key", "text_key"])
        .select("doc_key", "text_key", "text", "runs")
        .mapInArrow(_fetch_bytes(length), WINDOWS)
    )
    windows = (
        held.repartition("g", "part", "name")
        .sortWithinPartitions("g", "part", "name")
        .mapInArrow(_compare_windows(length), ROW)
    )
    hits = judged.filter(F.col("kind") == REPEATED).unionByName(windows)
    first = F.shiftright("at", 16)
    last = first + F.shiftright("at", 8).bitwiseAND(F.lit(255).cast("long"))
    return hits.groupBy("doc_key", "text_key").agg(
        F.collect_list(F.struct(first.alias("first"), last.alias("last"))).alias("starts")
    )


def covered(starts: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes, as (first, end), that the windows with these starts cover."""
    made: list[list[int]] = []
    for first, last in sorted(starts):
        if made and first <= made[-1][1]:
            made[-1][1] = max(made[-1][1], last + length)
        else:
            made.append([first, last + length])
    return [(a, b) for a, b in made]


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *[x for span in spans for x in span], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _remove(length: int, as_text: bool) -> Callable:
    last = "kept_text" if as_text else "kept_sha256"

    def one(text: str | None, starts: list[dict] | None) -> tuple[int, int, int, str | None]:
        data = (text or "").encode("utf-8")
        spans = covered([(s["first"], s["last"]) for s in starts or ()], length)
        rest = _kept(data, spans)
        if not as_text:
            said = hashlib.sha256(rest).hexdigest()
        else:  # a cut may split a character; what is left of it goes, too
            said = rest.decode("utf-8", "ignore") if spans else text
        return len(data), len(data) - len(rest), len(spans), said

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for batch in batches for p in _slices(batch, "text")):
            columns = (batch.column(c).to_pylist() for c in ("text", "starts"))
            made = list(zip(*[one(*row) for row in zip(*columns)])) or [()] * 4
            kinds = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), *[pa.array(x, t) for x, t in zip(made, kinds)]],
                ["own", "n_bytes", "n_removed", "n_spans", last],
            )

    return run


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD, as_text: bool = True
) -> DataFrame:
    """Every column of docs but text, with n_bytes, n_removed, n_spans and the text that stays.

    Columns of docs that have the name of one of these are replaced.
    """
    last = "kept_text" if as_text else "kept_sha256"
    made = ("n_bytes", "n_removed", "n_spans", last)
    starts = repeated_starts(docs.select("doc_id", "text"), length, gram, crowd).select(
        F.col("doc_key").alias("__doc"), F.col("text_key").alias("__text"), "starts"
    )
    doc_key, text_key = keys()
    kept = [f for f in docs.schema if f.name not in ("text", *made)]
    rows = docs.select(
        F.struct(*[f"`{f.name}`" for f in kept]).alias("own"),
        "text",
        doc_key.alias("doc_key"),
        text_key.alias("text_key"),
    )
    same = (F.col("doc_key") == F.col("__doc")) & (F.col("text_key") == F.col("__text"))
    cut = rows.join(starts, same, "left").select("own", "text", "starts")
    own = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in kept)
    out = f"own struct<{own}>, n_bytes long, n_removed long, n_spans long, {last} string"
    return cut.mapInArrow(_remove(length, as_text), out).select("own.*", *made)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents", "doc_id", "text"), as_text=False)
