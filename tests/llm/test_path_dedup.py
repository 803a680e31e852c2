from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tillmetrics.llm import path_dedup as X

from .conftest import prose


def brute(rows):
    """(doc_id, n_words, n_removed, kept_sha256) for (doc_id, text) rows, window by window."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, words in split:
        for k in range(len(words) - 12 if i is not None else 0):
            window = tuple(words[k : k + 13])
            least[window] = min(i, least.get(window, i))
    made = []
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - 12 if i is not None else 0):
            if least[tuple(words[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        made.append((i, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(made, key=key)


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def found(frame):
    wanted = ("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r[c] for c in wanted) for r in frame.collect()), key=key)


def mixture(dice, count, vocabulary=60):
    base = [prose(dice, dice.randrange(5, 90), vocabulary).split(" ") for _ in range(12)]
    rows = []
    for i in range(count):
        a, b, c = (dice.choice(base) for _ in range(3))
        cut = dice.randrange(len(a))
        own = prose(dice, dice.randrange(30), 9999).split(" ")
        words = dice.choice([
            a, a[:cut] + own + b, own + a[cut:] + c[: len(c) // 2], b + b, own, a + b + c,
            ["é"] * dice.randrange(60), [],
        ])
        text = dice.choice([" ", "\n", " \t\r ", "\x0b"]).join(words)
        rows.append((i - 5 if dice.random() < 0.95 else None, text if dice.random() < 0.97 else None))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_every_window(documents, dice, small, monkeypatch):
    if small:  # many slices and batches, all anchors crowded
        for name, value in (("SLICE", 150), ("PIECES", 20), ("CROWD", 1)):
            monkeypatch.setattr(X, name, value)
    rows = mixture(dice, 400)
    rows += rows[:6]  # repeated rows
    rows += [(rows[20][0], "other text " + rows[30][1] if rows[30][1] else "x"), (rows[21][0], rows[40][1])]
    frame = X.remove_repeats(documents(rows).repartition(7), as_text=False)
    assert found(frame) == brute(rows)
    assert any(r[2] for r in brute(rows))


def test_query_on_prose(spark, documents, dice, folder):
    shared = prose(dice, 80)
    rows = [
        (i, prose(dice, 60, 9999) + " " + (shared if i % 3 else "") + " " + prose(dice, 50, 9999))
        for i in range(40)
    ]
    rows += [(100, rows[1][1]), (101, prose(dice, 120_000, 9999) + " " + shared), (102, "x" * 2_000_000)]
    rows += [(103, ("y" * 200_000 + " ") * 30), (104, ("y" * 200_000 + " ") * 14), (105, "a b c")]
    out = X.op13_path_dedup(spark, folder(documents=documents(rows).withColumnRenamed("lang", "own")))
    assert found(out) == brute(rows)


def test_given_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = brute([(r["doc_id"], r["text"]) for r in rows])
    assert found(X.op13_path_dedup(spark, folder)) == want
    assert any(r[2] for r in want)


def test_spans_and_paths(documents):
    w = [f"w{i}" for i in range(100)]
    rows = [
        (1, " ".join(w[:40])), (2, " ".join(w[20:70])),
        (3, " ".join(["p", *w[:70], "q"])), (4, " ".join(["r", *w[:70]])),
    ]
    spans = [r.asDict() for r in X.spans(documents(rows)).collect()]
    shown = sorted((s["doc"], s["first"], s["n"], s["source"], s["source_first"]) for s in spans)
    # 2 shares w20..w39 with 1; 3 has 1 as a source for w0..w39 and 2 for what follows.
    assert shown == [
        (2, 0, 8, 1, 20), (3, 1, 28, 1, 0), (3, 29, 30, 2, 8), (4, 1, 28, 1, 0), (4, 29, 30, 2, 8)
    ]
    path = {(s["doc"], s["first"]): s["path"] for s in spans}
    assert path[3, 1] == path[3, 29] == path[4, 1] == path[4, 29] != path[2, 0]


def test_a_refuted_span_stays(documents, dice, monkeypatch):
    # All windows get one name: every claim is wrong but those that happen to be right.
    monkeypatch.setattr(X, "word_names", lambda data, starts, ends: starts.astype(X.U) * X.U(0) + X.U(1))
    rows = [(i, prose(dice, 30, 99999)) for i in range(6)]
    assert found(X.remove_repeats(documents(rows), as_text=False)) == brute(rows)


def test_text_that_stays(documents):
    shared = " ".join(f"s{i}" for i in range(13))
    rows = [(2, f"Head\n{shared}  tail é"), (1, shared), (3, "short  one"), (4, None)]
    out = {r.doc_id: r for r in X.remove_repeats(documents(rows)).collect()}
    assert out[2].kept_text == "Head tail é" and out[1].kept_text == shared
    assert out[3].kept_text == "short one" and out[4].kept_text == ""
    assert (out[2].n_words, out[2].n_removed, out[2].n_runs, out[2].n_paths) == (16, 13, 1, 1)
    assert X.remove_repeats(documents(rows).limit(0)).count() == 0


def test_rows_of_a_crowded_anchor_are_spread(dice):
    lines = [prose(dice, 5, 9999) for _ in range(20)]
    texts = [f"{prose(dice, 9, 9999)} {x} {prose(dice, 9, 9999)}" for x in lines for _ in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    rows = [r for b in X._edges(iter([batch])) for r in b.to_pylist()]
    by_anchor: dict = {}
    for r in rows:
        if r["kind"] == X.OPEN:
            by_anchor.setdefault(r["part"], set()).add(r["names"])
    assert max(map(len, by_anchor.values())) <= X.CROWD
    assert any(r["kind"] == X.APART for r in rows)
