"""Language identification in two steps: the language family, then the language within it.

Texts become hashed counts of byte pairs and triples of the lower-cased text, square roots taken
and scaled to length one. One linear support vector machine per family (against all others) picks
the family; within it one machine for each pair of languages votes (ties go to the larger sum of
margins, then to the first in the alphabet). Languages outside FAMILIES are families of their own.

The machines are trained on at most SAMPLE rows of each language and SAMPLE_ALL rows in all,
those with the smallest hash of doc_id, so the sample doesn't depend on how the table is dealt
out. Their feature vectors (DIMS floats each) go to one task, which trains the machines; the
driver only gets the weights. Prediction reads the whole text of every row and nothing but the
text.

A text that is null or has no letter is `und` with score 0, and so is every text if no labelled
row has letters. Rows without doc_id are never learned from and not held out; repeated rows give
repeated results; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.text import table

DIMS = 2048
SAMPLE = 1000  # labelled rows of each language
SAMPLE_ALL = 20_000  # labelled rows in all
UNKNOWN = "und"
PIECE = 1 << 20  # characters turned into features at a time

# Languages by family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}


def family_of(language: str) -> str:
    return next((f for f, known in FAMILIES.items() if language in known), f"only {language}")


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def features(text: str, dims: int = DIMS) -> np.ndarray:
    """Pieces overlap by two bytes, so that every pair and triple of the text is counted once."""
    counts = np.zeros(dims)
    last = b""
    for at in range(0, len(text), PIECE):
        data = last + text[at : at + PIECE].lower().encode("utf-8", "replace")
        b = np.frombuffer(data, np.uint8).astype(np.uint32)
        first = max(0, len(last) - 1)  # pairs before it were counted with the last piece
        pairs = (b[first:-1] << 8 | b[first + 1 :]) * np.uint32(2654435761)
        triples = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2246822519)
        for grams in (pairs, triples):
            counts += np.bincount(grams % np.uint32(65521) % dims, minlength=dims)
        last = data[-2:]
    root = np.sqrt(counts)
    return (root / max(np.sqrt(counts.sum()), 1e-9)).astype(np.float32)


def machine(x: np.ndarray, y: np.ndarray, cost: float = 4.0, rounds: int = 12) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge loss, dual coordinate descent)."""
    w, offset, alpha = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(len(x))
    diagonal = np.einsum("ij,ij->i", x, x) + 1 + 0.5 / cost
    shuffled = np.random.default_rng(0)
    for _ in range(rounds):
        for i in shuffled.permutation(len(x)):
            margin = y[i] * (float(x[i] @ w) + offset)
            new = max(alpha[i] - (margin - 1 + alpha[i] * 0.5 / cost) / diagonal[i], 0.0)
            change = (new - alpha[i]) * y[i]
            if change:
                w += np.float32(change) * x[i]
                offset += change
            alpha[i] = new
    return np.append(w, np.float32(offset))


@dataclass
class Model:
    families: list[str]
    languages: dict[str, list[str]]
    family_weights: np.ndarray  # a row for each family, the last column is the offset
    pair_weights: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> list[tuple[str, float]]:
        x = np.hstack([x, np.ones((len(x), 1), np.float32)])
        by_family = x @ self.family_weights.T
        best = by_family.argmax(axis=1)
        margins = {pair: x @ w for pair, w in self.pair_weights.items()}
        return [self._of(i, self.families[best[i]], by_family[i], margins) for i in range(len(x))]

    def _of(self, i: int, family: str, by_family: np.ndarray, margins: dict) -> tuple[str, float]:
        score = float(1 / (1 + np.exp(-2 * by_family.max()))) if len(by_family) > 1 else 1.0
        own = self.languages[family]
        votes = {k: [0, 0.0] for k in own}
        for a, b in itertools.combinations(own, 2):
            m = float(margins[a, b][i])
            votes[a if m > 0 else b][0] += 1
            votes[a][1] += m
            votes[b][1] -= m
        language = min(own, key=lambda k: (-votes[k][0], -votes[k][1], k))
        beaten = [abs(float(m[i])) for pair, m in margins.items() if language in pair]
        return language, score * float(1 / (1 + np.exp(-2 * min(beaten)))) if beaten else score


def train(x: np.ndarray, languages: list[str]) -> Model:
    known = np.array(languages)
    family = np.array([family_of(k) for k in languages])
    families = sorted(set(family))
    inside = {f: sorted(set(known[family == f])) for f in families}
    if len(families) > 1:
        weights = np.stack([machine(x, np.where(family == f, 1.0, -1.0)) for f in families])
    else:
        weights = np.zeros((1, x.shape[1] + 1), np.float32)
    model = Model(families, inside, weights)
    for own in inside.values():
        for a, b in itertools.combinations(own, 2):
            at = (known == a) | (known == b)
            model.pair_weights[a, b] = machine(x[at], np.where(known[at] == a, 1.0, -1.0))
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, sample: int = SAMPLE, sample_all: int = SAMPLE_ALL) -> Model | None:
    """Trained on the labelled rows that aren't held out; docs: doc_id, text, lang."""
    usable = docs.filter(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    usable = usable.filter("lang is not null")
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return None
    each = max(1, min(sample, sample_all // len(counts)))
    # Positions of hashes are even, so that a share a little larger than asked for is enough.
    draw = F.xxhash64(F.col("doc_id"), F.lit(8))
    share = F.coalesce(
        F.element_at(
            F.create_map(
                *[
                    F.lit(v)
                    for k, n in sorted(counts.items())
                    for v in (k, min(1.0, (each + 6 * each**0.5 + 20) / n))
                ]
            ),
            F.col("lang"),
        ),
        F.lit(0.0),
    )
    drawn = usable.filter(draw / F.lit(2.0**64) + 0.5 <= share).select(
        draw.alias("draw"), "lang", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (d, k, features(t).tobytes())
                for d, k, t in zip(*(batch.column(c).to_pylist() for c in ("draw", "lang", "text")))
                if t and has_letter(t)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.binary()),
                ],
                ["draw", "lang", "x"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("lang", "draw", "x")))]
        chosen = []
        for _, rows in itertools.groupby(sorted(held), key=lambda r: r[0]):
            chosen += list(rows)[:each]
        if chosen:
            x = np.frombuffer(b"".join(r[2] for r in chosen), np.float32).reshape(len(chosen), -1)
            made = train(x, [r[0] for r in chosen])
            parts = made.families, made.languages, made.family_weights, made.pair_weights
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(parts)], pa.binary())], ["model"])

    # The bounded sample is what one task learns from; the driver gets the weights alone.
    sampled = drawn.mapInArrow(run, "draw long, lang string, x binary").repartition(1)
    found = sampled.mapInArrow(fit, "model binary").collect()
    return Model(*pickle.loads(found[0]["model"])) if found else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every column of docs, lang_pred and score; only `text` is looked at."""
    kept = docs.schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            said = [(UNKNOWN, 0.0)] * len(texts)
            if model is not None:
                real = [i for i, t in enumerate(texts) if t and has_letter(t)]
                for at in range(0, len(real), 256):
                    some = real[at : at + 256]
                    for i, p in zip(some, model.predict(np.stack([features(texts[i]) for i in some]))):
                        said[i] = p
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept if c not in ("lang_pred", "score")],
                    pa.array([p[0] for p in said], pa.string()),
                    pa.array([p[1] for p in said], pa.float64()),
                ],
                [*[c for c in kept if c not in ("lang_pred", "score")], "lang_pred", "score"],
            )

    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    found = predict(docs.select("doc_id", "text"), learn(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
