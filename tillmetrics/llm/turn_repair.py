"""Conversation repair: the cheapest edits that make the roles of a conversation alternate.

Roles are legal if their initials read `(s?(ua)+)?`: nothing at all, or exchanges of a user and an
assistant turn, maybe after one system turn. Edits, by the letter they have in an audit:
    D  delete the turn                              3 (blank and duplicate turns must go)
    I  insert an empty user or assistant turn       2
    K  keep the turn                                0, 1 if it is truncated
    R  make it a user or assistant turn             2, 3 if it is truncated
The audit is the letters in order; among the cheapest ones the ASCII-least is taken.

Iterative-deepening A*: a depth-first search tries the edits in ASCII order and never exceeds a
bound; if nothing is accepted, the bound grows to the least cost that was cut off. So the first
accepting path has the least cost and, at that cost, the least audit. A state is the next turn and
what the initials so far ask for (START, SYSTEM, USER, ASSISTANT). Failed states are kept, over all
bounds, with the cost that is known not to be enough from there on (the transposition table); the
table begins with an estimate that is never too high: the cost to go if a system turn needed no
exchange after it. The estimate errs by the price of one exchange at most, so a conversation of any
length takes few bounds, and time and memory in proportion to its turns.

Spark deals the turns by conversation and sorts them; a task holds one conversation at a time.
The search of one conversation, and the text it gives, are sequential, so a single conversation
with a third of all turns keeps one task busy and has to fit there.

Turns are ordered by turn (null first), then role, then text. Null roles and texts are one space
(a turn of any other initial than s, u, a has to be changed or deleted; an empty role has none);
repeated rows are duplicates; rows without a conv_id form one conversation; other columns are
ignored; an empty table gives an empty result. A span of turn numbers beyond the range of a long
counts as the largest one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmetrics.llm.text import table

WHITE = r"\x20\x09-\x0D"
START, SYSTEM, USER, ASSISTANT = range(4)  # what has been read, or what has to come next
AFTER = {  # state: initial: state
    START: {"s": SYSTEM, "u": ASSISTANT},
    SYSTEM: {"u": ASSISTANT},
    USER: {"u": ASSISTANT},
    ASSISTANT: {"a": USER},
}
ROLES = {"u": "user", "a": "assistant"}
ACCEPTING = (START, USER)
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
FOREVER = 1 << 60
LARGEST = (1 << 63) - 1
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
COLUMNS = ["conv_id", *COUNTS, "audit", "turns"]
SCHEMA = (
    "conv_id long, " + "".join(f"{c} long, " for c in COUNTS) + "audit string, "
    "turns array<struct<role: string, text: string>>"
)

Turn = tuple[str, bool, bool]  # initial, must go, truncated


def estimate(turns: list[Turn]) -> list[int]:
    """A lower bound of the cost to go from each state, at 4 * turn + state.

    An exchange is owed by nobody but a user turn here: SYSTEM is as good as USER.
    """
    n = len(turns)
    low = [0] * (4 * n + 4)
    low[4 * n + ASSISTANT] = INSERT
    for i in range(n - 1, -1, -1):
        initial, gone, cut = turns[i]
        at, after = 4 * i, 4 * i + 4
        for state in (START, USER, ASSISTANT):
            best = DELETE + low[after + state]
            if not gone:
                for letter, then in AFTER[state].items():
                    if letter == initial or letter in ROLES:
                        price = (KEEP if letter == initial else REROLE) + cut
                        best = min(best, price + low[after + (USER if then == SYSTEM else then)])
            low[at + state] = best
        # An insertion leads to the other phase of the same turn.
        user, assistant = low[at + USER], low[at + ASSISTANT]
        low[at + START] = min(low[at + START], INSERT + assistant)
        low[at + USER] = min(user, INSERT + assistant)
        low[at + ASSISTANT] = min(assistant, INSERT + user)
    for at in range(0, len(low), 4):
        low[at + SYSTEM] = low[at + USER]
    return low


def moves(turns: list[Turn], i: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, price, next turn, next state), in ASCII order of the letters."""
    made = []
    if i < len(turns):
        made.append(("D", DELETE, i + 1, state))
    letter, then = next((x, s) for x, s in AFTER[state].items() if x in ROLES)
    made.append(("I", INSERT, i, then))
    if i < len(turns) and not turns[i][1]:
        initial, _, cut = turns[i]
        if initial in AFTER[state]:
            made.append(("K", KEEP + cut, i + 1, AFTER[state][initial]))
        if initial != letter:
            made.append(("R", REROLE + cut, i + 1, then))
    return made


def search(turns: list[Turn]) -> tuple[str, int, list[int]]:
    """The audit, its cost, and the bounds that were tried."""
    failed = estimate(turns)  # not enough from a state: anything below this
    bound, bounds = failed[START], []
    while True:
        bounds.append(bound)
        audit = _within(turns, bound, failed)
        if audit is not None:
            return audit, bound, bounds
        bound = failed[START]


def _within(turns: list[Turn], bound: int, failed: list[int]) -> str | None:
    """Depth first, no path dearer than the bound; raises `failed` for the states it gives up."""
    # Of each state on the path: turn, state, what is left to spend, its moves, the next of them,
    # and the least cost from here that those tried so far leave possible.
    path = [[0, START, bound, moves(turns, 0, START), 0, FOREVER]]
    letters: list[str] = []
    while path:
        i, state, left, ahead, tried, least = top = path[-1]
        if i == len(turns) and state in ACCEPTING:
            return "".join(letters)
        if tried == len(ahead):
            at = 4 * i + state
            failed[at] = max(failed[at], least)
            path.pop()
            if path:
                letters.pop()
                above = path[-1]
                above[5] = min(above[5], above[3][above[4] - 1][1] + failed[at])
            continue
        letter, price, j, then = ahead[tried]
        top[4] += 1
        if price + failed[4 * j + then] > left:
            top[5] = min(least, price + failed[4 * j + then])
            continue
        letters.append(letter)
        path.append([j, then, left - price, moves(turns, j, then), 0, FOREVER])
    return None


def apply(audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The repaired (role, text) turns."""
    state, made, rest = START, [], iter(rows)
    for letter in audit:
        role, text = next(rest) if letter != "I" else ("", "")
        if letter == "D":
            continue
        initial = role[:1]
        if letter != "K":
            initial = next(x for x in AFTER[state] if x in ROLES)
            role = ROLES[initial]
        made.append((role, text))
        state = AFTER[state][initial]
    return made


def faults(rows: list[tuple[str, str, bool, bool]]) -> tuple[list[Turn], list[int]]:
    """The turns as the search sees them, and the numbers of blank, duplicate, truncated, illegal."""
    seen: set[tuple[str, str]] = set()
    turns, counts = [], [0, 0, 0, 0]
    for role, text, blank, open_end in rows:
        repeated = (role, text) in seen
        seen.add((role, text))
        cut = open_end and not blank and not repeated
        for k, fault in enumerate((blank, repeated and not blank, cut)):
            counts[k] += fault
        turns.append((role[:1], blank or repeated, cut))
    pairs = zip(turns, turns[1:])
    counts[3] = sum(a[0] + b[0] not in LEGAL for a, b in pairs)
    return turns, counts


def _one(conv_id: int | None, numbers: list[int | None], rows: list[tuple]) -> tuple:
    turns, counts = faults(rows)
    audit, cost, _ = search(turns)
    known = {x for x in numbers if x is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    made = [{"role": r, "text": t} for r, t in apply(audit, [x[:2] for x in rows])]
    return (conv_id, min(gaps, LARGEST), *counts, cost, audit, made)


KINDS = [pa.int64()] * 7 + [
    pa.string(),
    pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])),
]
WAITING = 1000  # results, or turns in them, that go out together


def _repair() -> Callable:
    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        columns = zip(*made)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv_id, numbers, rows = False, None, [], []
        made, waiting = [], 0
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if not begun or key != conv_id:
                    if begun:
                        made.append(_one(conv_id, numbers, rows))
                        waiting += 1 + len(rows)
                        if waiting > WAITING:
                            yield batch_of(made)
                            made, waiting = [], 0
                    begun, conv_id, numbers, rows = True, key, [], []
                turn, role, text, copies, blank, open_end = row
                numbers += [turn] * min(copies, 1)
                rows += [(role, text, blank, open_end)] * copies
        if begun:
            made.append(_one(conv_id, numbers, rows))
        if made:
            yield batch_of(made)

    return run


def repair(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row for each conv_id: what is wrong, the cheapest audit, and the repaired turns.

    `copies` says how often a row counts, adjacently; a conversation whose rows all count zero
    times has no turns, but is in the result.
    """
    said = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("int").alias("copies"),
    ).select(
        "*",
        (~F.col("text").rlike(f"[^{WHITE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{WHITE}]*\z")).alias("open_end"),
    )
    return (
        said.repartition("conv_id")
        .sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
        .mapInArrow(_repair(), SCHEMA)
    )


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with deterministic faults, and how often each then counts."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "")
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return damaged, F.col("copies")


def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return repair(*damage(rows)).select(
        *COLUMNS[:-1], F.sha2(F.array_join(said, "\n"), 256).alias("repaired_sha256")
    )
