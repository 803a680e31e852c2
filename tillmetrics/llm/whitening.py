"""Whitening of embeddings: projection on the leading components, each scaled to variance one.

1. Spark sums the whole numbers x = floor(1024 c) + 100000 of every entry c: n and, for each
   dimension, S. Both are exact.
2. Tasks centre their rows, as (x - S // n) - (S mod n) / n, which loses nothing to the common
   offset, and multiply the centred rows: one upper triangle a task, summed by Spark.
3. The covariance is as wide as the vectors, whatever their number; its leading eigenpairs are
   worked out in the driver: Householder reflections to a tridiagonal matrix, bisection on Sturm
   counts for the largest eigenvalues, inverse iteration for their vectors, each orthogonalised
   against the ones before it in its cluster, and the reflections again to go back.
4. The components, one row of the vectors' width for each, are broadcast and every row is projected.
   A pass over the projections gives their covariance, whose distance from the identity is reported.

Nothing is kept between the passes; each reads the table, so a lost executor costs its tasks.

Rows go if their vector is null, or holds a null, an infinity or no number. Covariance needs one
width: vectors of another width than most (of equally frequent ones, the widest) go, too. Entries
beyond 2**51 count as that. Components whose eigenvalue is below 1e-12 of the largest one are noise
and left out: equal vectors, a single vector or empty ones give no rows. A deviation too large for a
long is null. Repeated rows and rows without vec_id count and come back one by one; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.text import table

SCALE, OFFSET = 1024, 100_000
LARGEST = float(1 << 61)  # of a scaled entry
COMPONENTS = 8
NOISE = 1e-12  # eigenvalues below this share of the largest one
CLUSTER = 1e-3  # eigenvalues closer than this share of the matrix's norm
PIECE = 1 << 20  # entries worked on at a time
HALF = 32  # bits of the lower part of a sum


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # one row for each component
    values: tuple[float, ...]
    trace: float

    @property
    def width(self) -> int:
        return len(self.sums)


# --- eigenpairs of a symmetric matrix --------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, the one beside it, and the unit vectors of the reflections, in order."""
    a, mirrors = matrix.copy(), []
    size = len(a)
    for k in range(size - 2):
        v = a[k + 1 :, k].copy()
        length = math.sqrt(v @ v)
        side = -math.copysign(length, v[0])
        v[0] -= side
        norm = math.sqrt(v @ v)
        if norm == 0:
            mirrors.append(v)
            continue
        v /= norm
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = side
        mirrors.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), mirrors


def below(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each of `at`."""
    squares = np.r_[0.0, beside**2]
    least = np.finfo(float).tiny * max(1.0, squares.max())
    count, q = np.zeros(len(at), int), np.ones(len(at))
    for d, e in zip(diagonal, squares):
        q = d - at - e / q
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def largest(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    size = len(diagonal)
    reach = np.abs(np.r_[beside, 0.0]) + np.abs(np.r_[0.0, beside])
    low = np.full(wanted, (diagonal - reach).min())
    high = np.full(wanted, (diagonal + reach).max())
    room = np.spacing(np.abs(np.r_[low, high]).max()) * size
    low, high = low - room, high + room
    rank = size - 1 - np.arange(wanted)  # this many lie below the one sought
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        over = below(diagonal, beside, middle) > rank
        high = np.where(open_ & over, middle, high)
        low = np.where(open_ & ~over, middle, low)


def solve(diagonal: np.ndarray, beside: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) y = right by elimination with row exchanges; a pivot of zero becomes tiny."""
    size = len(diagonal)
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(np.r_[beside, 0.0]).max())
    tiny = tiny or np.finfo(float).tiny
    main, up = (diagonal - shift).tolist(), [*beside.tolist(), 0.0]
    second, y = [0.0] * size, right.tolist()
    for i in range(size - 1):
        lead = beside[i]  # below main[i]
        if abs(main[i]) >= abs(lead):
            main[i] = main[i] or tiny
            f = lead / main[i]
            main[i + 1] -= f * up[i]
            y[i + 1] -= f * y[i]
        else:
            f = main[i] / lead
            main[i], main[i + 1], up[i] = lead, up[i] - f * main[i + 1], main[i + 1]
            second[i], up[i + 1] = up[i + 1], -f * up[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    for i in range(size - 1, -1, -1):
        pivot = main[i] if abs(main[i]) > tiny else math.copysign(tiny, main[i])
        rest = y[i] - (up[i] * y[i + 1] if i + 1 < size else 0.0)
        y[i] = (rest - (second[i] * y[i + 2] if i + 2 < size else 0.0)) / pivot
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors, one row for each of the falling eigenvalues."""
    norm = np.abs(diagonal).max() + 2 * np.abs(np.r_[beside, 0.0]).max()
    dice, found, begin = np.random.default_rng(7), [], 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            begin = i
        # Equal eigenvalues would give the same vector again.
        shift = value - (i - begin) * 4 * np.finfo(float).eps * norm
        y = dice.uniform(-1, 1, len(diagonal))
        for _ in range(5):
            y = solve(diagonal, beside, shift, y / np.abs(y).max())
            y /= np.abs(y).max()
            for _ in range(2):
                for other in found[begin:]:
                    y = y - (other @ y) * other
            y /= math.sqrt(y @ y)
        found.append(y)
    return np.array(found)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their vectors as rows.

    The largest entry of each vector is positive.
    """
    scale = np.abs(matrix).max() or 1.0
    diagonal, beside, mirrors = tridiagonal(matrix / scale)
    values = largest(diagonal, beside, min(wanted, len(matrix)))
    vectors = inverse_iteration(diagonal, beside, values)
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        part = vectors[:, k + 1 :]
        part -= 2 * np.outer(part @ v, v)
    top = np.abs(vectors).argmax(axis=1)
    vectors *= np.sign(vectors[np.arange(len(vectors)), top])[:, None]
    return values * scale, vectors


# --- passes over the rows -----------------------------------------------------------------


def _pieces(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, whole numbers) of slices of a batch."""
    entries = column.flatten().to_numpy(zero_copy_only=False)
    entries = entries.reshape(-1, width)
    step = max(1, PIECE // max(1, width))
    for first in range(0, len(entries), step):
        scaled = np.floor(entries[first : first + step] * SCALE)
        yield first, np.clip(scaled, -LARGEST, LARGEST).astype(np.int64) + OFFSET


def _centre(sums: tuple[int, ...], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole parts of the means and what is left, in n-ths."""
    return (np.array([f(s, n) for s in sums], np.int64) for f in (int.__floordiv__, int.__mod__))


def _sum_entries(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            for _, x in _pieces(batch.column(0), width):
                n += len(x)
                total += (x >> HALF).sum(axis=0).astype(object) << HALF
                total += (x & ((1 << HALF) - 1)).sum(axis=0)
        if n:
            high = [t >> HALF for t in total]
            low = [t & ((1 << HALF) - 1) for t in total]
            columns = [range(width), high, low, [n] * width]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["dimension", "high", "low", "n"]
            )

    return run


def _products(width: int, centred: Callable[[np.ndarray], np.ndarray]) -> Callable:
    """Sums of products of a task's centred rows, by pairs of columns; row -1: sums of the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            for _, x in _pieces(batch.column(0), width):
                z = centred(x)
                more = np.vstack([z.sum(axis=0), z.T @ z])
                made = more if made is None else made + more
        if made is not None:
            i, j = np.triu_indices(made.shape[1])
            i, j = np.r_[np.full(made.shape[1], -1), i], np.r_[np.arange(made.shape[1]), j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i), pa.array(j), pa.array(made[i + 1, j])], ["i", "j", "value"]
            )

    return run


def _covariance(valid: DataFrame, width: int, n: int, size: int, centred: Callable) -> np.ndarray:
    """Of the centred columns, whose sums are close to zero and taken off nonetheless."""
    parts = valid.select("entries").mapInArrow(
        _products(width, centred), "i long, j long, value double"
    )
    # One row for each pair of dimensions: as wide as the vectors, whatever their number.
    summed = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    means, products = np.zeros(size), np.zeros((size, size))
    for i, j, value in summed:
        if i < 0:
            means[j] = value / n
        else:
            products[i, j] = products[j, i] = value / n
    return products - np.outer(means, means)


def usable(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows with a vector of finite numbers and of the most frequent width; that width."""
    entries = F.col("embedding").cast("array<double>")
    found = rows.select("vec_id", entries.alias("entries")).filter(
        F.col("entries").isNotNull()
        & F.forall("entries", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
    )
    widths = found.groupBy(F.size("entries").alias("width")).count()
    most = widths.orderBy(F.desc("count"), F.desc("width")).first()
    width = 0 if most is None else most["width"]
    return found.filter(F.size("entries") == width), width


def fit(valid: DataFrame, width: int, wanted: int = COMPONENTS) -> Whitening | None:
    """The leading components of all rows; None if the rows don't vary."""
    if not width:
        return None
    parts = valid.select("entries").mapInArrow(
        _sum_entries(width), "dimension long, high long, low long, n long"
    )
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]
    summed = parts.groupBy("dimension").agg(*whole).orderBy("dimension").collect()  # by dimension
    n = int(summed[0]["n"])
    sums = tuple((int(r["high"]) << HALF) + int(r["low"]) for r in summed)
    means, rest = _centre(sums, n)
    matrix = _covariance(valid, width, n, width, lambda x: (x - means) - rest / n)
    values, vectors = leading(matrix, wanted)
    kept = values > max(NOISE * values[0], 0.0)
    if not kept.any():
        return None
    trace = math.fsum(np.diagonal(matrix))
    return Whitening(n, sums, vectors[kept], tuple(values[kept].tolist()), trace)


def _whiten(model: Whitening) -> Callable[[np.ndarray], np.ndarray]:
    means, rest = _centre(model.sums, model.n)
    axes, n = (model.vectors / np.sqrt(model.values)[:, None]).T, model.n
    return lambda x: ((x - means) - rest / n) @ axes


def deviations(x: np.ndarray, sums: tuple[int, ...], n: int) -> list[int | None]:
    """Exact sums over the dimensions of (n x - S)**2."""
    means, rest = _centre(sums, n)
    away = x - means
    reach = n * (int(np.abs(away).max(initial=0)) + 1)
    if reach * reach * x.shape[1] >= 1 << 63:
        away, rest = away.astype(object), rest.astype(object)
    made = ((away * n - rest) ** 2).sum(axis=1).tolist()
    return [v if v < 1 << 63 else None for v in made]


def _project(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        whiten = _whiten(model)
        for batch in batches:
            for first, x in _pieces(batch.column("entries"), model.width):
                out = whiten(x)
                offsets = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").slice(first, len(x)),
                        pa.array(deviations(x, model.sums, model.n), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel())),
                    ],
                    ["vec_id", "deviation", "whitened"],
                )

    return run


def project(valid: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation, and the whitened coordinates of each row."""
    shared = valid.sparkSession.sparkContext.broadcast(model)  # a few rows of the vectors' width
    return valid.select(F.col("vec_id").cast("long").alias("vec_id"), "entries").mapInArrow(
        _project(shared), "vec_id long, deviation long, whitened array<double>"
    )


def identity_error(valid: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    size = len(model.values)
    found = _covariance(valid, model.width, model.n, size, _whiten(model))
    return float(np.abs(found - np.eye(size)).max())


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    valid, width = usable(table(spark, folder, "embeddings", "vec_id", "embedding"))
    model = fit(valid, width)
    if model is None:
        return spark.createDataFrame([], RESULT)
    shares = F.array(*[F.lit(v / model.trace) for v in model.values])
    return project(valid, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(identity_error(valid, model)).alias("identity_error"),
    )
