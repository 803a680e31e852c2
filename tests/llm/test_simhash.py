from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from tillmetrics.llm import graph
from tillmetrics.llm import simhash_dedup as S

from .conftest import prose


def simhash(text):
    words = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if x]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, radius=4):
    """Smallest index of each connected set of values, all pairs compared."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_fingerprints_and_components(documents, dice, folder, spark):
    base = [prose(dice, n) for n in (30, 200, 400, 800)]
    rows = [(1, None), (2, ""), (3, "One"), (4, "one"), (5, "a b  c\nd e\x1c f é\x85g"), (6, "  \t ")]
    for i in range(120):
        words = dice.choice(base).split()
        for _ in range(dice.randrange(4)):
            words[dice.randrange(len(words))] = f"x{i}"
        rows.append((10 + i, " ".join(words)))
    rows += [rows[8], (500, prose(dice, 70_000, 3000))]
    found = S.op7_simhash_dedup(spark, folder(documents=documents(rows))).collect()
    fps = [simhash(t) for _, t in rows]
    names = roots(fps)
    least = {}
    for (i, _), n in zip(rows, names):
        least[n] = min(least.get(n, i), i)
    want = sorted((i, f"{f:016x}", least[n]) for (i, _), f, n in zip(rows, fps, names))
    assert sorted(map(tuple, found)) == want
    assert len(set(least.values())) < len(set(fps))


def test_rows_without_ids(documents):
    rows = [(None, "same text of five words"), (7, "same text of five words"), (None, "alone here")]
    found = {(r.doc_id, r.component_id) for r in S.groups(documents(rows)).collect()}
    assert found == {(None, 7), (7, 7), (None, None)}


def test_keep_one(documents, dice):
    a, b = prose(dice, 300), prose(dice, 300)
    rows = [(5, a), (3, a), (9, a + " end"), (4, b), (4, b), (None, a), (None, "none"), (None, "none")]
    schema = "doc_id long, text string, root string, fp int"
    docs = documents([(*r, "kept", i) for i, r in enumerate(rows)], schema)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(3, a), (4, b), (0, "none")])
    assert S.keep_one(docs.limit(0)).count() == 0


@pytest.mark.parametrize("same", [1, 2, 3])
def test_close_pairs_share_a_shard(spark, same):
    dice = np.random.default_rng(same)
    values = dice.integers(-(2**63), 2**63, 50)
    rows = []
    for v in values.tolist():
        flipped = sum(1 << int(b) for b in dice.choice(64, 4, replace=False))
        w = (v & (2**64 - 1)) ^ flipped
        rows.append((v, w - 2**64 if w >> 63 else w))
    frame = spark.createDataFrame(rows, "a long, b long")
    keys = frame.select(S.shard_keys(frame.a, 4, same).alias("x"), S.shard_keys(frame.b, 4, same).alias("y"))
    assert keys.selectExpr("min(arrays_overlap(x, y)) ok").first().ok


def test_tree_finds_what_a_scan_finds():
    dice = np.random.default_rng(1)
    center = dice.integers(0, 2**63, dtype=np.uint64)
    noise = np.array([sum(1 << int(b) for b in dice.choice(64, 5)) for _ in range(600)], np.uint64)
    values = np.unique(center ^ noise)
    tree = S.Tree(values, np.arange(len(values)))
    found = np.concatenate(tree.search(values, np.arange(len(values)), 4), axis=1)
    want = np.argwhere(np.bitwise_count(values[:, None] ^ values) <= 4)
    assert sorted(map(tuple, found.T.tolist())) == sorted(map(tuple, want.tolist()))
    assert tree.children and all(isinstance(k, int) for k in tree.children)


def test_crowded_shard_in_chunks(spark):
    dice = np.random.default_rng(2)
    noise = {sum(1 << int(b) for b in dice.choice(62, 3)) for _ in range(300)}
    values = sorted(noise)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    joined = graph.components(S.links(frame, radius=2, chunk=16)).collect()
    names = {v: v for v in values} | {r.node: r.root for r in joined}
    want = [values[i] for i in roots(values, 2)]
    assert [names[v] for v in values] == want


def test_groups_of_many_links_are_joined_as_they_are_found(monkeypatch):
    dice = np.random.default_rng(3)
    noise = [sum(1 << int(b) for b in dice.choice(40, 5, replace=False)) for _ in range(300)]
    values = np.unique(np.array(noise, np.uint64))
    want = roots(values.tolist())
    fps, parts = values.view(np.int64), np.zeros(len(values), np.int64)
    for pending, piece in ((1 << 20, 8192), (40, 16)):
        monkeypatch.setattr(S, "PENDING", pending)
        monkeypatch.setattr(S, "SLICE", piece)
        a, b = S.links_of_shard(fps, parts, (0, 0), 4)
        names = dict(zip(a.tolist(), b.tolist()))
        assert [names.get(v, v) for v in fps.tolist()] == [values[i] for i in want]
    assert 1 < len(set(want)) < len(want)


def test_rows_dealt_out_for_a_crowded_shard():
    assert -(-200_000 // S.CHUNK) < 4 and -(-1_000_000 // S.CHUNK) < 16


def test_chain_of_links(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001), (5, 5)]
    found = graph.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(1, 201)} | {1001: 1000}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
