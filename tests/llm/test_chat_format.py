from __future__ import annotations

import hashlib
import json

import pytest

from tillmetrics.llm import chat_format as C

ROWS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """What the query's columns are, from plain rows."""
    grouped = {}
    for conv, turn, role, text in rows:
        grouped.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    made = {}
    for conv, turns in grouped.items():
        turns.sort()
        said = "".join(t for *_, r, t in turns if r == "assistant")
        both = "".join(f"{r}\n{t}\n" for *_, r, t in turns)
        size = sum(
            len("<turn:></turn>") + sum(2 if c in "\\<>" else 1 for c in r + t) for *_, r, t in turns
        )
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        made[conv] = (len(turns), sha(both), len(said), sha(said), size)
    return made


def test_against_plain_python(spark, dice):
    bits = ["</turn>", "<turn:user>", "\\", "\\b", "\\l", "\\g", "### Assistant:", "é😀", "\n", "a", ""]
    rows = [(None, 0, "user", "no id"), (1, None, "user", None), (1, 0, None, "x"), (2, 0, "", "")]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "tie")]
    for i in range(200):
        text = "".join(dice.choice(bits) for _ in range(dice.randrange(12)))
        role = dice.choice(["user", "assistant", "system", "as<s>\\ist", "assistant"])
        rows.append((10 + i // 6, dice.randrange(5), role, text))
    rows.append((99, 0, "assistant", "long \\< " * 50_000))
    turns = C.turns_of_rows(spark.createDataFrame(rows, ROWS))
    found = {r.conv_id: tuple(r)[1:] for r in C.digests(C.format_turns(turns)).collect()}
    assert found == brute(rows)


def test_mask_covers_what_the_assistant_says(spark):
    rows = [(1, 0, "user", "q<"), (1, 1, "assistant", "a\\"), (1, 2, "assistant", "")]
    one = C.format_turns(C.turns_of_rows(spark.createDataFrame(rows, ROWS))).first()
    assert one.formatted == "<turn:user>q\\l</turn><turn:assistant>a\\b</turn><turn:assistant></turn>"
    spans = [one.formatted[s.start : s.start + s.length] for s in one.loss if s.start is not None]
    assert spans == ["a\\b", ""]


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]}),
    ({"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}]}),
    ({"instruction": "hi", "output": "yo"}),
    ({"output": "yo", "input": "", "instruction": "hi"}),
    ({"prompt": "hi", "completion": "yo"}),
    ({"question": "hi", "answer": "yo"}),
    ({"turns": [{"turn": 2, "role": "assistant", "text": "yo"}, {"turn": 1, "role": "user", "text": "hi"}]}),
]


@pytest.mark.parametrize("record", LAYOUTS, ids=lambda r: ",".join(r))
def test_layouts_become_the_same_turns(spark, record):
    records = spark.createDataFrame([(1, json.dumps(record))], "conv_id long, record string")
    found = C.turns_of_records(records).orderBy("turn").collect()
    assert [(r.role, r.text) for r in found] == [("user", "hi"), ("assistant", "yo")]
    assert C.unknown(records).count() == 0


def test_unknown_and_odd_records(spark):
    rows = [(1, "{"), (2, None), (3, '{"other": 1}'), (4, '{"messages": []}')]
    rows += [(5, '{"messages": [{"role": "user", "content": null}]}')]
    rows += [(6, '{"instruction": "a", "input": "b", "output": 7}')]
    records = spark.createDataFrame(rows, "conv_id long, record string")
    found = {(r.conv_id, r.role, r.text) for r in C.turns_of_records(records).collect()}
    assert found == {(5, "user", ""), (6, "user", "a\n\nb"), (6, "assistant", "7")}
    assert sum(r["count"] for r in C.unknown(records).collect()) == 3


def test_query(spark, folder):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    probe = [(-7, i, r, C.PROBE) for i, r in enumerate(("user", "assistant"))]
    extra = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", formatted string, at int")
    found = C.op2_chat_format(spark, folder(conversations=extra)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == brute(rows + probe)
    nothing = C.op2_chat_format(spark, folder(conversations=extra.limit(0))).collect()
    assert [r.conv_id for r in nothing] == [-7]


def test_layout_of_a_table(spark):
    with pytest.raises(ValueError):
        C.turns_of_rows(spark.createDataFrame([(1, "x")], "conv_id long, note string"))
