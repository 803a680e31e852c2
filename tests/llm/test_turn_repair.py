from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tillmetrics.llm import turn_repair as X

from .conftest import prose

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def cheapest(turns):
    """(cost, audit, roles) by uniform-cost search over whole edit sequences, prefixes and all."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, initials = heapq.heappop(heap)
        if i == len(turns) and LEGAL.match(initials):
            return cost, audit, initials
        state = (i, initials[:1] == "s" and len(initials) == 1, initials[-1:], bool(initials))
        if state in done or not re.match(r"s?(ua)*u?\Z", initials):
            continue
        done.add(state)
        steps = [(2, "I", i, r) for r in "ua"]
        if i < len(turns):
            initial, gone, cut = turns[i]
            steps.append((3, "D", i + 1, ""))
            if not gone:
                steps += [(2 + cut, "R", i + 1, r) for r in "ua"]
                if initial:
                    steps.append((cut, "K", i + 1, initial))
        for price, letter, j, more in steps:
            heapq.heappush(heap, (cost + price, audit + letter, j, initials + more))


def brute(rows):
    """The contract by its words: rows are (conv_id, turn, role, text) in any order."""
    made = {}
    for conv_id in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv_id]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or ""))
        left = []
        for _, turn, role, text in own:
            role, text = (" " if x is None else x for x in (role, text))
            key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
            kind = zlib.crc32(key.encode()) % 20
            if kind == 1:
                text = ""
            if kind == 2:
                text = re.sub("[.!?]", "", text)
            if kind == 4:
                role = "user"
            left += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        numbers = {t for t, _, _ in left if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        kinds, turns = [], []
        for i, (_, role, text) in enumerate(left):
            shown = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = (
                "blank" if not shown
                else "duplicate" if (role, text) in [x[1:] for x in left[:i]]
                else "truncated" if shown[-1] not in ".!?" else ""
            )
            kinds.append(kind)
            turns.append((role[:1], kind in ("blank", "duplicate"), kind == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        cost, audit, initials = cheapest(turns)
        names = {"u": "user", "a": "assistant"}
        said, rest = [], iter(left)
        marks = iter(initials)
        for letter in audit:
            row = next(rest) if letter != "I" else (None, "", "")
            if letter == "D":
                continue
            mark = next(marks)
            said.append(f"{row[1] if letter == 'K' else names[mark]}:{row[2]}")
        digest = hashlib.sha256("\n".join(said).encode()).hexdigest()
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        made[conv_id] = (gaps, *counts, illegal, cost, audit, digest)
    return made


def result(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def test_every_short_conversation():
    kinds = [(i, g, c) for i in ("s", "u", "a", " ", "") for g, c in ((0, 0), (1, 0), (0, 1))]
    kinds = [(i, bool(g), bool(c)) for i, g, c in kinds]
    for n in range(3):
        for turns in itertools.product(kinds, repeat=n):
            cost, audit, _ = cheapest(turns)
            assert X.search(list(turns))[:2] == (audit, cost), turns


def test_random_conversations(dice):
    several = 0
    for _ in range(1500):
        turns = [
            (dice.choice("sssuuuaaax"), dice.random() < 0.2, dice.random() < 0.2)
            for _ in range(dice.randrange(3, 12))
        ]
        turns = [(i, g, c and not g) for i, g, c in turns]
        cost, audit, _ = cheapest(turns)
        found = X.search(turns)
        assert found[:2] == (audit, cost)
        assert all(a >= b for a, b in [(cost, found[2][0])])  # the estimate is never too high
        assert found[2] == sorted(set(found[2])) and found[2][-1] == cost
        several += len(found[2]) > 1
    assert several  # the bound had to grow


def test_failed_states_are_kept():
    turns = [("s", False, False), *[("u", True, False)] * 6]
    failed = X.estimate(turns)
    bound = failed[X.START]
    assert X._within(turns, bound, failed) is None
    assert failed[X.START] > bound
    assert X.search(turns)[:2] == ("D" * 7, 21)


def test_long_conversation_takes_few_bounds(dice):
    turns = [(dice.choice("suuaa"), dice.random() < 0.05, False) for _ in range(50_000)]
    audit, cost, bounds = X.search(turns)
    assert len(bounds) <= 3 and len(audit.replace("I", "")) == len(turns)
    price = {"D": 3, "I": 2, "K": 0, "R": 2}
    assert cost == sum(price[x] for x in audit)


@pytest.fixture(scope="module")
def talk():
    import random

    dice = random.Random(5)
    rows = []
    for conv_id in [*range(250), None]:
        for turn in range(dice.randrange(1, 9)):
            role = ("user", "assistant")[turn % 2]
            if dice.random() < 0.15:
                role = dice.choice(["system", "tool", "user", "", None])
            text = prose(dice, dice.randrange(4)) + dice.choice(["", ".", "?! ", "\n", ". \t"])
            shown = turn if dice.random() < 0.9 else dice.choice([None, 3, 40])
            rows.append((conv_id, shown, role, text if dice.random() < 0.95 else None))
    return rows + rows[:40]


def test_query_against_brute_force(spark, talk, folder):
    frame = spark.createDataFrame(talk, SCHEMA).withColumn("audit", F.lit("x"))
    found = result(X.op11_turn_repair(spark, folder(conversations=frame.repartition(5))))
    assert found == brute(talk)
    assert {len(a[6]) > 0 for a in found.values()} == {True, False}


def test_conversation_without_turns_stays(spark, folder):
    gone = next(i for i in range(999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    (row,) = X.op11_turn_repair(spark, folder(conversations=rows)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark, folder):
    rows = spark.createDataFrame([], SCHEMA)
    assert X.op11_turn_repair(spark, folder(conversations=rows)).collect() == []


def test_repaired_turns_and_extremes(spark):
    rows = [
        (1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello."), (1, 2, "user", "So."),
        (2, -(1 << 63), "user", "A?"), (2, (1 << 63) - 1, "assistant", "x " * 300_000 + "."),
    ]
    found = {r.conv_id: r for r in X.repair(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [tuple(t) for t in found[1].turns] == [
        ("system", "Be kind."), ("user", ""), ("assistant", "Hello."), ("user", "So."), ("assistant", "")
    ]
    assert (found[1].audit, found[1].cost) == ("KIKKI", 4)
    assert found[2].gaps == (1 << 63) - 1 and found[2].audit == "KK"


def test_given_table(spark):
    import pyarrow.parquet as pq

    folder = "/root/testdata/sf0.001"
    rows = pq.read_table(f"{folder}/conversations.parquet").to_pylist()
    want = brute([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in rows])
    assert result(X.op11_turn_repair(spark, folder)) == want
