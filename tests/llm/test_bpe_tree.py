from __future__ import annotations

import hashlib
import tracemalloc
from pathlib import Path

import pytest

from tillmetrics.llm import bpe_tree as B

from .conftest import prose

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return B.load(Path(PATH).read_text(encoding="utf-8"))


ODD = ["abcdefghij", "the ing tion'll don't 's 're ", "éèüß ñç", "漢字かな 한글 ᄀ", "0123 456 ", "!?.,;:'’--"]
ODD += ["<|endoftext|>", "  \n\t", "é", "İIıſ", "👍🏽‍🚀", " ̸́", " \x1c\x85"]


def odd_text(dice):
    kind = dice.randrange(3)
    if kind == 0:
        return "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(dice.randrange(1, 500)))
    if kind == 1:
        return "".join(dice.choice(dice.choice(ODD)) for _ in range(dice.randrange(1, 300)))
    return "".join(dice.choice([*ODD, "<|startoftext|>", "theandwhich"]) for _ in range(dice.randrange(60)))


def test_joined_leaves_are_the_whole(tokenizer, dice):
    words = B.Words(tokenizer, most=100)
    for _ in range(800):
        text = odd_text(dice)
        pieces = B.halves(text, dice.choice([9, 16, 50, 100]))
        assert "".join(pieces) == text
        edge = dice.choice([1, 5, 40, 1000])
        got = B.concatenate(words, [(p, B.node_of_leaf(words, p, edge)) for p in pieces])
        assert got == words.part(tokenizer.encode(text, add_special_tokens=False).ids)


def test_words_are_the_whole(tokenizer, dice):
    words = B.Words(tokenizer, most=50)
    for _ in range(500):
        texts = [odd_text(dice), odd_text(dice)]
        ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert words.encode(texts) == [words.part(i) for i in ids]
        assert [p[2] for p in words.encode(texts)] == [
            tokenizer.decode(i, skip_special_tokens=False) for i in ids
        ]


def test_memory_of_words_is_bounded(tokenizer, dice):
    words = B.Words(tokenizer, most=200_000)
    held = lambda: [*words.known.items(), *words.before.items()]
    most = 0  # of the texts encoded at a time
    for kind in ("漢字かな", "abcdefgh"):
        for length in (3, B.LONG, B.LONG + 1, 2000):
            for _ in range(20):
                texts = ["".join(dice.choices(kind, k=length)) for _ in range(20)]
                ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
                assert words.encode(texts) == [words.part(i) for i in ids]
                assert all(len(w) <= B.LONG for w, _ in held())
                most = max(most, sum(words.cost(t, words.part(i)) for t, i in zip(texts, ids)))
                assert sum(words.cost(*x) for x in held()) <= words.most + 2 * most


def test_remembered_words_take_what_they_are_counted_for(tokenizer, dice):
    words = B.Words(tokenizer)
    texts = [" ".join("".join(dice.choices("abcdefgh", k=9)) for _ in range(1000)) for _ in range(20)]
    words.encode(texts[:1])
    tracemalloc.start()
    before, counted = tracemalloc.get_traced_memory()[0], words.size
    words.encode(texts)
    taken = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert taken < 1.2 * (words.size - counted)
    assert taken < 280 * (len(words.known) - 1000)  # several strings a word took over 400
    assert B.CACHE <= 64 << 20  # two workers share an executor's memory with its JVM


def digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_table(documents, tokenizer, dice):
    rows = [(1, None), (2, ""), (3, " \n "), (None, "no id " * 40), (4, "<|endoftext|>x")]
    rows += [(10 + i, odd_text(dice)) for i in range(40)] + [(60, prose(dice, 400)), (61, "x" * 900)]
    rows += [rows[-1], rows[-2], rows[3]]
    found = B.encode(documents(rows), PATH, leaf=100, with_ids=True, edge=20).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found]
    want = [(i, *digests(tokenizer, t)) for i, t in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(len(r.ids) == r.n_tokens for r in found)


def test_query(spark, documents, tokenizer, dice, folder):
    rows = [(1, prose(dice, 9000)), (2, "short")]
    assert len(rows[0][1]) > B.LEAF
    found = B.op10_bpe_tree(spark, folder(documents=documents(rows))).collect()
    assert sorted(map(tuple, found)) == [(i, *digests(tokenizer, t)) for i, t in rows]
    assert B.op10_bpe_tree(spark, folder(documents=documents([]))).count() == 0


def test_kept_columns(documents):
    docs = documents([(1, "a b", 5, "z")], "doc_id long, text string, leaf int, piece string")
    row = B.encode(docs, PATH, keep=("doc_id",)).first()
    assert row.n_tokens == 2
