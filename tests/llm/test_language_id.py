from __future__ import annotations

import zlib

import numpy as np

from tillmetrics.llm import language_id as L

WORDS = {
    "de": "schicht keit ung heit über nicht auch werden zwischen straße größe müssen",
    "en": "thing with have would the which there should between health through",
    "es": "ción para niño ellos también mañana porque señor llamar años pequeño",
    "fr": "être où déjà français beaucoup chaque leçon était aujourd'hui même",
    "xx": "qzq zzxq xqzz qqxz zxzx",
}


def text_of(dice, language, count=80):
    return " ".join(dice.choice(WORDS[language].split()) for _ in range(count))


def rows_of(dice, count):
    made = [(i, text_of(dice, k), k, "s", 1) for i in range(count) for k in [dice.choice(list(WORDS))]]
    return made


def test_held_out_accuracy(spark, documents, dice, folder):
    rows = rows_of(dice, 300)
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "12 !? 345", "de", "s", 0)]
    rows += [(None, text_of(dice, "fr"), None, None, None), rows[0], (903, text_of(dice, "es"), None, "s", 1)]
    rows += [(904, text_of(dice, "de", 60_000), "de", "s", 1)]
    found = L.op8_language_id(spark, folder(documents=documents(rows))).collect()
    assert len(found) == len(rows)
    said = {r.doc_id: r for r in found}
    for r in rows:
        if r[0] is not None:
            assert said[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 3 == 1)
    right = [said[r[0]].lang_pred == r[2] for r in rows[:300] if said[r[0]].held_out]
    assert len(right) > 50 and np.mean(right) > 0.98
    assert [(said[i].lang_pred, said[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert said[None].lang_pred == "fr" and not said[None].held_out
    assert said[903].lang_pred == "es" and said[904].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in found)


def test_labels_of_held_out_rows_are_not_used(documents, dice):
    rows = rows_of(dice, 200)
    swapped = [
        (i, t, "xx" if zlib.crc32(str(i).encode()) % 3 == 1 else k, s, n) for i, t, k, s, n in rows
    ]
    one, other = (L.learn(documents(r)) for r in (rows, swapped))
    assert (one.family_weights == other.family_weights).all()


def test_text_alone_decides(documents, dice):
    model = L.learn(documents(rows_of(dice, 100)))
    text = text_of(dice, "fr")
    docs = documents([(1, text, "en", "a", 1), (2, text, None, None, None)])
    assert len({(r.lang_pred, r.score) for r in L.predict(docs, model).collect()}) == 1


def test_nothing_to_learn_from(spark, documents, folder):
    rows = [(1, "words without label", None, "s", 1), (2, None, "en", "s", 0)]
    found = L.op8_language_id(spark, folder(documents=documents(rows))).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2
    assert L.op8_language_id(spark, folder(documents=documents([]))).count() == 0
    single = [(i, "only one language", "en", "s", 1) for i in range(6)]
    one = L.op8_language_id(spark, folder(documents=documents(single))).collect()
    assert {(r.lang_pred, r.score) for r in one} == {("en", 1.0)}


def test_sample_is_bounded_and_stable(documents, dice):
    docs = documents(rows_of(dice, 300))
    one, other = L.learn(docs, sample=10), L.learn(docs.repartition(7), sample=10)
    assert (one.family_weights == other.family_weights).all()


def test_pieces_count_every_pair_once(dice, monkeypatch):
    text = text_of(dice, "fr", 50) + "é"
    want = L.features(text)
    for size in (1, 2, 3, 7):
        monkeypatch.setattr(L, "PIECE", size)
        np.testing.assert_allclose(L.features(text), want, rtol=1e-5)


def test_columns_of_the_same_name(documents, dice):
    docs = documents([(1, "text", 3, "x")], "doc_id long, text string, score int, lang_pred string")
    assert L.predict(docs, None).columns == ["doc_id", "text", "lang_pred", "score"]
