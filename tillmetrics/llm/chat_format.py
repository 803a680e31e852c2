r"""Chat formatting: layouts are told apart by a fingerprint of their nested field paths.

A record's fingerprint is the hash of its field tree, fields in alphabetical order, value types
left out. It selects a declarative Layout, which says where turns, roles and texts lie. A JSON
record is fingerprinted row by row, a DataFrame of nested columns once, by its schema. Records
with an unknown fingerprint give no turns and show up in `unknown`.

Canonical turns (conv_id, turn, role, text) are written as
    <turn:ROLE>TEXT</turn>
In roles and texts `\` becomes `\b`, `<` becomes `\l` and `>` becomes `\g`: no control string can
appear inside, and since every backslash begins such a pair, undoing l, g and b in this order
gives back the text. The loss mask lists, for each turn, where it begins and the span of its text
if the assistant said it.

Offsets come from a window over the turns of a conversation; its rows are shuffled once and
then stay where they are. A digest over a whole conversation needs its turns in one task,
which is the one thing here that grows with the size of a single conversation.

Null roles and texts are empty; turns are ordered by turn (null first), then role, then text;
repeated rows are turns of their own; rows without a conv_id form one conversation; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmetrics.llm.text import table, whole

OPEN, MID, CLOSE = "<turn:", ">", "</turn>"
ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A list of turns with role and text fields, or single fields that each are one turn."""

    name: str
    turns: str | None = None
    role: str = ""
    text: str = ""
    order: str | None = None
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()  # role, fields joined by blank lines

    def tree(self) -> str:
        if self.turns is None:
            return tree_of({f: None for _, names in self.fields for f in names})
        item = {self.role: None, self.text: None} | ({self.order: None} if self.order else {})
        return tree_of({self.turns: [item]})

    def trees(self) -> list[str]:
        """The layout's own tree, and that of a record with an empty list of turns."""
        empty = [] if self.turns is None else [tree_of({self.turns: [None]})]
        return [self.tree(), *empty]


LAYOUTS = (
    Layout("table rows", "turns", "role", "text", order="turn"),
    Layout("messages", "messages", "role", "content"),
    Layout("speakers", "conversations", "from", "value"),
    Layout(
        "instruction with input",
        fields=(("user", ("instruction", "input")), ("assistant", ("output",))),
    ),
    Layout("instruction", fields=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("prompt", fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt, response", fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(
        "system prompt",
        fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
    ),
    Layout("question", fields=(("user", ("question",)), ("assistant", ("answer",)))),
)


def tree_of(value) -> str:
    """Field tree in the notation of Spark's variant schemas, any scalar as *."""
    if isinstance(value, dict):
        return f"OBJECT<{', '.join(f'{k}: {tree_of(value[k])}' for k in sorted(value))}>"
    if isinstance(value, list):
        return f"ARRAY<{tree_of(value[0])}>"
    return "*"


def tree_of_type(kind: T.DataType) -> str:
    def nested(kind):
        if isinstance(kind, T.StructType):
            return {f.name: nested(f.dataType) for f in kind.fields}
        return [nested(kind.elementType)] if isinstance(kind, T.ArrayType) else None

    return tree_of(nested(kind))


def record_fingerprint(parsed: Column) -> Column:
    """Fingerprint of a variant's field paths; types and null values make no difference."""
    scalar = r"(?<=[<:] |<)(?:[A-Z_]+(?:\(\d+(?:, ?\d+)?\))?)(?=[,>])|^[A-Z_]+(?:\([\d, ]+\))?$"
    return F.xxhash64(F.regexp_replace(F.schema_of_variant(parsed), scalar, "*"))


def _hash(tree: str) -> Column:
    return F.xxhash64(F.lit(tree))


def _turn(at: Column, role: Column, text: Column) -> Column:
    return F.struct(at.alias("turn"), whole(role).alias("role"), whole(text).alias("text"))


def _alias(role: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
    return F.coalesce(F.element_at(known, F.lower(whole(role))), role)


def _from_variant(record: Column, layout: Layout) -> Column:
    get = lambda path, kind: F.try_variant_get(record, path, kind)
    if layout.turns is None:
        said = [
            F.concat_ws(
                "\n\n", *[F.nullif(get(f"$.{f}", "string"), F.lit("")) for f in names]
            )
            for _, names in layout.fields
        ]
        return F.array(
            *[
                _turn(F.lit(i).cast("long"), F.lit(role), text)
                for i, ((role, _), text) in enumerate(zip(layout.fields, said))
            ]
        )
    extra = f", `{layout.order}`: bigint" if layout.order else ""
    item = f"array<struct<`{layout.role}`: string, `{layout.text}`: string{extra}>>"
    return F.transform(
        get(f"$.{layout.turns}", item),
        lambda t, i: _turn(
            t[layout.order] if layout.order else i.cast("long"),
            _alias(t[layout.role]),
            t[layout.text],
        ),
    )


def turns_of_records(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Canonical turns of (conv_id, record), record being JSON of any known layout."""
    parsed = records.select("conv_id", F.try_parse_json("record").alias("v")).withColumn(
        "fingerprint", record_fingerprint(F.col("v"))
    )
    turns = F.lit(None).cast("array<struct<turn: bigint, role: string, text: string>>")
    for layout in reversed(layouts):
        known = F.col("fingerprint").isin([_hash(t) for t in layout.trees()])
        turns = F.when(known, _from_variant(F.col("v"), layout)).otherwise(turns)
    return parsed.select("conv_id", F.inline(turns))


def unknown(records: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Records that no layout fits, counted by fingerprint."""
    marked = records.select(record_fingerprint(F.try_parse_json("record")).alias("fingerprint"))
    known = [_hash(t) for x in layouts for t in x.trees()]
    return (
        marked.filter(F.col("fingerprint").isNull() | ~F.col("fingerprint").isin(known))
        .groupBy("fingerprint")
        .count()
    )


def turns_of_rows(rows: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """Canonical turns of a table with one row per turn, its columns found by fingerprint."""
    item = T.StructType([f for f in rows.schema.fields if f.name != "conv_id"])
    for layout in layouts:
        found = tree_of_type(T.StructType([T.StructField(layout.turns or "", T.ArrayType(item))]))
        if layout.order and found == layout.tree():
            at, role, text = (F.col(x) for x in (layout.order, layout.role, layout.text))
            return rows.select("conv_id", F.inline(F.array(_turn(at, role, text))))
    raise ValueError(f"no layout has the fields {sorted(item.names)}")


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def format_turns(turns: DataFrame, taught: str = "assistant") -> DataFrame:
    """conv_id, formatted, and the loss mask: per turn where it begins, and its span if taught."""
    said = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        escape(F.col("role")).alias("head"),
        escape(F.col("text")).alias("body"),
    )
    lead = F.length("head") + len(OPEN) + len(MID)
    size = lead + F.length("body") + len(CLOSE)
    before = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    said = said.withColumn(
        "at",
        F.coalesce(F.sum(size).over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
    )
    mine = F.col("role") == taught
    row = F.struct(
        "at",
        F.concat(F.lit(OPEN), "head", F.lit(MID), "body", F.lit(CLOSE)).alias("piece"),
        F.when(mine, F.col("at") + lead).alias("start"),
        F.when(mine, F.length("body")).alias("length"),
    )
    return (
        said.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
        .select(
            "conv_id",
            F.array_join(F.col("rows.piece"), "").alias("formatted"),
            F.transform(
                "rows",
                lambda r: F.struct(r["at"], r["start"], r["length"]),
            ).alias("loss"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns in the formatted text, and the text under the mask, both unescaped."""
    pieces = F.filter(F.split("formatted", CLOSE), lambda p: p != "")
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            unescape(F.substring(p, F.lit(len(OPEN) + 1), F.instr(p, F.lit(MID)) - len(OPEN) - 1))
            .alias("role"),
            unescape(F.substring(p, F.instr(p, F.lit(MID)) + 1, F.length(p))).alias("text"),
        ),
    )
    taught = F.transform(
        pieces,
        lambda p, i: F.coalesce(
            unescape(
                F.substring(
                    p,
                    (F.get("loss", i)["start"] - F.get("loss", i)["at"] + 1).cast("int"),
                    F.get("loss", i)["length"],
                )
            ),
            F.lit(""),
        ),
    )
    return formatted.select(
        "*", turns.alias("turns"), F.array_join(taught, "").alias("loss_text")
    )


def digests(formatted: DataFrame) -> DataFrame:
    both = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(both, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = r"\### Assistant: </turn> ok"


def _probe(spark: SparkSession) -> DataFrame:
    """Conversation -7, as a record of another layout."""
    say = lambda role: F.struct(F.lit(role).alias("role"), F.lit(PROBE).alias("content"))
    record = F.to_json(F.struct(F.array(say("user"), say("assistant")).alias("messages")))
    return spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), record.alias("record"))


def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    turns = turns_of_rows(rows).unionByName(turns_of_records(_probe(spark)))
    return digests(format_turns(turns))


def _sql_size(column: str) -> str:
    marks = "".join(f" + length({column}) - length(replace({column}, '{p}', ''))" for p, _ in ESCAPES)
    return f"length({column}){marks}"


SQL = f"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
    order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
    filter (where role = 'assistant'), '')) as loss_sha256,
  sum({len(OPEN + MID + CLOSE)} + {_sql_size("role")} + {_sql_size("text")})::bigint
    as formatted_chars
from said group by conv_id
"""
