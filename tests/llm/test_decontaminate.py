from __future__ import annotations

import re

import duckdb
import pytest

from tillmetrics.llm import decontaminate as D

from .conftest import prose

SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return [w for w in re.split(SPLIT, (text or "").lower()) if w]


def brute(docs, items):
    """Every item along every diagonal of every document."""
    made = {}
    for doc, text in set(docs):
        w = words(text)
        for item, passage in set(items):
            b = words(passage)
            block = min(len(b), D.BLOCK)
            if block == 0:
                continue
            need = block - max(D.tolerance(block), 0)  # all words of items shorter than the masks
            best = None
            for d in range(-len(b) + 1, len(w)):
                equal = [0 <= d + k < len(w) and w[d + k] == x for k, x in enumerate(b)]
                if sum(equal) < need:
                    continue
                for s in range(len(b) - block + 1):
                    most = sum(equal[s : s + block])
                    if most >= need:
                        new = (most, sum(equal), -d, -s)
                        best = max(best or new, new)
            if best:
                made[doc, item] = (len(b), best[1], -best[2] - best[3], best[0] / block)
    return {(*k, *v) for k, v in made.items()}


def test_masks_leave_no_gap():
    assert [D.tolerance(n) for n in (7, 8, 12, 14, 16)] == [-1, 0, 1, 2, 3]
    assert 1 - D.tolerance(D.BLOCK) / D.BLOCK >= 0.8


@pytest.fixture
def case(dice):
    items = [(i, prose(dice, n, 5000)) for i, n in enumerate((8, 11, 14, 16, 25, 60, 5, 0, 7, 2, 1))]
    items += [(20, items[4][1]), (21, None), (None, prose(dice, 30, 5000)), items[3]]
    docs = [(1, None), (2, ""), (3, items[5][1]), (3, items[5][1]), (None, "x " + items[4][1])]
    for i in range(30):
        passage = words(dice.choice(items)[1])
        first = dice.randrange(len(passage) + 1) if dice.random() < 0.4 else 0
        passage = passage[first:]
        for _ in range(dice.randrange(6)):
            if passage:
                passage[dice.randrange(len(passage))] = f"sub{dice.randrange(9)}"
        text = " ".join([prose(dice, dice.randrange(30)), *passage, prose(dice, dice.randrange(30))])
        docs.append((10 + i, text.upper() if i % 2 else text))
    docs.append((500, prose(dice, 900) + " " + items[5][1]))
    return docs, items


@pytest.mark.parametrize("broadcast", [D.BROADCAST, 0])
def test_every_diagonal(spark, documents, case, broadcast):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.overlaps(documents(docs), benchmark, broadcast=broadcast).drop("text_key").collect()
    assert len(found) == len(set(found))
    assert {tuple(r) for r in found} == brute(docs, items)


def test_sql_says_the_same(spark, documents, case, folder):
    docs, items = case
    docs = [d for d in docs if d[0] is not None and d[0] < 500]
    items = [i for i in items if i[0] is not None]
    path = folder(
        documents=documents(docs), benchmark=spark.createDataFrame(items, "item_id long, text string")
    )
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{path}/{t}.parquet/*.parquet'")
    assert set(con.sql(D.SQL).fetchall()) == brute(docs, items)


def test_short_items(spark, documents):
    question = "What is the capital of France?"
    docs = [(1, f"Quiz: {question.upper()} Paris."), (2, "what is the capital of france"), (3, "of France")]
    docs += [(4, "what is the old capital of france"), (5, "is the capital of france"), (6, None), (7, "aye")]
    items = [(1, question), (2, "of france"), (3, "aye"), (4, "?!"), (5, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = D.overlaps(documents(docs), benchmark).drop("text_key").collect()
    assert {tuple(r) for r in found} == brute(docs, items)
    assert {r.doc_id for r in found if r.item_id == 1} == {1, 2}
    assert {r.doc_id for r in found if r.item_id == 2} == {1, 2, 3, 4, 5}
    assert {r.doc_id for r in found if r.item_id == 3} == {7}
    only = benchmark.filter("item_id = 1")
    assert [r.doc_id for r in D.clean(documents(docs), only).orderBy("doc_id").collect()] == [3, 4, 5, 6, 7]


def test_clean_documents_stay(spark, documents, case):
    docs, items = case
    rows = [(*d, i, "k") for i, d in enumerate(docs)]
    frame = documents(rows, "doc_id long, text string, hit_id int, hits string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    leaks = {r[0] for r in brute(docs, items)}
    kept = D.clean(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(r.hit_id for r in kept.collect()) == [r[2] for r in rows if r[0] not in leaks]
    assert D.clean(frame, benchmark.limit(0)).count() == len(rows)
    assert D.overlaps(frame.limit(0), benchmark).count() == 0


def test_native(spark, documents, case):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    plan = D.overlaps(documents(docs), benchmark)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
