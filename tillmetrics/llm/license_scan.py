"""License scans: an exact containment join of text blocks with license templates.

Blocks are windows of 2 * STRIDE words, one every STRIDE words, so that every passage as
long as a template lies inside one. A block meets a template when it holds at least
threshold * |template| of the template's distinct words.

1. The templates' words are ordered by how often they occur in all documents, rarest first.
2. Prefix filter: a block that lacks the first |T| - need + 1 words of a template can't meet
   it; only blocks holding such a word are built. Since the words are the rarest, few are.
3. Length filter: the block needs as many distinct template words as the template asks for.
4. Positional filter: the words behind the first common one, on either side, bound the overlap.
5. The survivors' overlap is counted; base phrases are then looked up word by word.

The templates are a bounded set of literals, so the join needs no shuffle: every row is
matched where it is read, however many rows share a source or a text. The only shuffle
carries the counts of the templates' words.

Null and empty texts have no words and no labels; repeated rows give repeated results; other
columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmetrics.llm.text import table, words

STRIDE = 32  # words; no template may be longer
THRESHOLD = 0.8

# Phrases whose every place is counted, with their labels.
BASE = (
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
)
# Labels this method adds: passages found by the share of their words that a block holds.
NOTICES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "bsd-conditions",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation",
    ),
    (
        "mit-grant",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
    ),
    ("mit-release", "released under the mit license"),
)


@dataclass(frozen=True)
class Template:
    label: str
    phrase: tuple[str, ...]
    exact: bool
    threshold: float

    @property
    def need(self) -> int:
        return math.ceil(self.threshold * len(set(self.phrase)) - 1e-9)


def templates(base=BASE, notices=NOTICES, threshold: float = THRESHOLD) -> list[Template]:
    made = [Template(k, tuple(p.split()), True, 1.0) for k, p in base]
    made += [Template(k, tuple(p.split()), False, threshold) for k, p in notices]
    if any(not t.phrase or len(t.phrase) > STRIDE for t in made):
        raise ValueError(f"a template has 1 to {STRIDE} words")
    return made


def rarest_first(docs: DataFrame, wanted: list[Template]) -> list[str]:
    """The templates' words by their number in all documents; a row for each word is collected."""
    vocabulary = sorted({w for t in wanted for w in t.phrase})
    found = F.filter(words("text"), lambda w: w.isin(vocabulary))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").count()
    seen = {r["word"]: r["count"] for r in counts.collect()}
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _meets(block: Column, template: Template, order: list[str]) -> Column:
    """Overlap of a block's template words, rarest first, with the template; 0 if it falls short."""
    ordered = [w for w in order if w in template.phrase]
    need, size = template.need, len(ordered)
    first = F.array_min(
        F.transform(
            F.array_intersect(_strings(ordered[: size - need + 1]), block),
            lambda w: F.array_position(_strings(ordered), w),
        )
    )
    at = F.array_position(block, F.element_at(_strings(ordered), first.cast("int")))
    bound = F.least(F.lit(size) - first, F.size(block) - at) + 1
    overlap = F.size(F.array_intersect(block, _strings(ordered)))
    return F.when(
        (F.size(block) >= need) & first.isNotNull() & (bound >= need) & (overlap >= need), overlap
    ).otherwise(0)


def scan(docs: DataFrame, wanted: list[Template] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, the base phrases' places, labels and the best containment."""
    wanted = templates() if wanted is None else wanted
    order = rarest_first(docs, wanted)
    rare = sorted(
        {
            w
            for t in wanted
            for w in [x for x in order if x in t.phrase][: len(set(t.phrase)) - t.need + 1]
        }
    )
    w = F.col("words")
    rows = docs.select("doc_id", words("text").alias("words"))
    # Starts, in strides, of the blocks that hold a prefix word.
    near = F.flatten(
        F.transform(
            F.filter(
                F.transform(w, lambda x, i: F.when(x.isin(rare), i)), lambda i: i.isNotNull()
            ),
            lambda i: F.array(F.floor(i / STRIDE).cast("int"), F.floor(i / STRIDE).cast("int") - 1),
        )
    )
    blocks = F.when(
        F.arrays_overlap(w, _strings(rare)), F.array_distinct(F.filter(near, lambda b: b >= 0))
    ).otherwise(F.array().cast("array<int>"))
    held = F.transform(
        blocks,
        lambda b: F.struct(
            (b * STRIDE).alias("start"),
            F.array_intersect(_strings(order), F.slice(w, b * STRIDE + 1, 2 * STRIDE)).alias(
                "known"
            ),
        ),
    )
    rows = rows.withColumn("blocks", held)

    def of(block: Column, template: Template) -> Column:
        size = len(template.phrase)
        overlap = _meets(block["known"], template, order)
        starts = F.array().cast("array<int>")
        if template.exact:
            phrase = _strings(template.phrase)
            last = F.least(block["start"] + STRIDE - 1, F.size(w) - size)
            starts = F.when(
                (overlap > 0) & (last >= block["start"]),
                F.filter(
                    F.sequence(block["start"], last), lambda i: F.slice(w, i + 1, size) == phrase
                ),
            ).otherwise(starts)
        return F.struct(
            F.lit(template.label).alias("label"),
            F.lit(template.exact).alias("base"),
            (overlap / F.lit(float(len(set(template.phrase))))).alias("share"),
            starts.alias("starts"),
        )

    found = F.flatten(F.transform("blocks", lambda b: F.array(*[of(b, t) for t in wanted])))
    rows = rows.withColumn("found", F.filter(found, lambda f: f["share"] > 0))
    places = F.flatten(F.transform("found", lambda f: f["starts"]))
    base = F.filter("found", lambda f: f["base"] & (F.size(f["starts"]) > 0))
    added = F.filter("found", lambda f: ~f["base"])
    real = F.filter("found", lambda f: ~f["base"] | (F.size(f["starts"]) > 0))
    label = lambda f: f["label"]
    base_labels = F.transform(base, label)
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        listed(base_labels).alias("base_labels"),
        listed(F.concat(base_labels, F.transform(added, label))).alias("labels"),
        F.coalesce(
            F.array_max(F.transform(real, lambda f: f["share"])), F.lit(0.0)
        ).alias("score"),
    )


def op1_license_scan(spark, folder: str) -> DataFrame:
    return scan(table(spark, folder, "documents", "doc_id", "text"))


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Every block against every template, without a filter.
SQL = f"""
with doc as (
  select row_number() over () as r, doc_id,
    list_filter(
      string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'),
      lambda x: x <> '') as w
  from documents
),
base(label, phrase) as (values {", ".join(f"('{k}', [{_listed(p.split())}])" for k, p in BASE)}),
notice(label, tokens) as (
  values {", ".join(f"('{k}', [{_listed(sorted(set(p.split())))}])" for k, p in NOTICES)}
),
word_at as (select r, unnest(range(len(w))) as i from doc),
place as (
  select d.r, a.i, b.label
  from word_at a join doc d using (r) join base b on d.w[a.i + 1] = b.phrase[1]
  where d.w[a.i + 1 : a.i + len(b.phrase)] = b.phrase
),
block as (select r, w[s + 1 : s + {2 * STRIDE}] as w
  from (select r, w, unnest(range(0, len(w), {STRIDE})) as s from doc)),
met as (
  select r, label, max(len(list_intersect(n.tokens, b.w)) / len(n.tokens)) as share
  from block b, notice n group by all having share >= {THRESHOLD}
),
base_of as (
  select r, count(*) as n_base, min(i) as first_word, max(i) as last_word,
    string_agg(distinct label, ',' order by label) as base_labels
  from place group by r
),
all_of as (
  select r, string_agg(distinct label, ',' order by label) as labels, max(share) as score
  from (select r, label, 1.0::double as share from place union all select r, label, share from met)
  group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
  first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  coalesce(score, 0.0)::double as score
from doc left join base_of using (r) left join all_of using (r)
"""
