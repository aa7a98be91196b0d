"""Held-out accuracy on made-up languages and quality classes, machines and neighbours against plain versions, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import odd_rows, prose
from tierline.llm import language_id as I
from tierline.llm import quality as Q
from tierline.llm.common import held_out

VOICES = {"aa": "ka mu ti ro ", "ab": "ka mu te ri ", "ba": "стр кла что мне", "bb": "стр кло чта мню", "cc": "über schön groß ähnlich"}


def spoken(rng, lang):
    return "".join(rng.choice(VOICES[lang].split()) + rng.choice(["", " ", " ", ". "]) for _ in range(60))


def test_families_then_languages(documents):
    rng = random.Random(1)
    rows = [(k, spoken(rng, lang := rng.choice(sorted(VOICES))), lang) for k in range(500)] + [(1000, None, "aa"), (1001, "123 --", "bb"), (1002, "ka mu", None), (None, "ka mu ti ro", "aa")]
    docs, out = documents(rows), held_out(F.col("doc_id"), 3, 1)
    model = I.fit(docs, ~out)
    assert sorted(x for f in model.families for x in f) == sorted(VOICES)
    assert any({"ba", "bb"} <= set(f) for f in model.families)
    got = docs.select("doc_id", "lang", "text", out.alias("out"), I.prediction(model).alias("p")).collect()
    right = [r["p"]["language"] == r["lang"] for r in got if r["out"] and r["doc_id"] < 1000]
    assert len(right) > 100 and np.mean(right) > 0.97
    by_id = {r["doc_id"]: r["p"] for r in got}
    assert tuple(by_id[1000]) == tuple(by_id[1001]) == ("und", 1.0)
    assert all(0 <= r["p"]["score"] <= 1 for r in got)


def test_language_without_or_with_one_language(documents):
    docs = documents(odd_rows())
    none = I.fit(docs, F.lit(False))
    assert {r[0]["language"] for r in docs.select(I.prediction(none)).collect()} == {"und"}
    one = I.fit(docs, F.col("lang") == "en")
    got = {(r["text"] is not None and any(c.isalpha() for c in r["text"]), r["p"]["language"]) for r in docs.select("text", I.prediction(one).alias("p")).collect()}
    assert got == {(False, "und"), (True, "en")}
    assert documents([]).select(I.prediction(I.fit(documents([]), F.lit(True)))).count() == 0


def test_blocks_do_not_change_features(monkeypatch):
    text = "Some längerer text, ÉTÉ 123 日本語 " * 40
    whole = I.shares(text), Q.terms(text)
    monkeypatch.setattr(I, "BLOCK", 256)
    monkeypatch.setattr(Q, "BLOCK", 64)
    assert np.corrcoef(whole[0], I.shares(text))[0, 1] > 0.999
    assert np.allclose(whole[1], Q.terms(text))


def test_machine_parts_what_can_be_parted():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5))
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0, 1.0, -1.0)
    w, b = I.support_vector_machine(x, y, c=10.0)
    assert ((x @ w + b > 0) == (y > 0)).mean() > 0.97


def classes(rng, n):
    rows, marks = [], []
    for k in range(n):
        words = prose(rng, 40, "a few words that make up an ordinary sentence. They go on\nfor a while, and end.".split(" "))
        good = k % 4 > 0
        bad = [" ".join(w + "###" for w in words.split()), " | ".join(words.split()), " ".join([words.split()[0]] * 40)][k % 3]
        rows.append((k, words if good else bad, "en", "s"))
        marks.append((k, int(good), 0))
    return rows, marks


@pytest.fixture(scope="module")
def quality(documents, labels):
    rows, marks = classes(random.Random(3), 600)
    docs = documents(rows)
    return docs, Q.fit(docs, labels(marks + [(None, 1, 1), (5, None, 1), (99999, 0, 0)]), ~held_out(F.col("doc_id"), 4, 2))


def test_quality_of_held_out_rows(quality):
    docs, model = quality
    got = docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("out"), Q.score(model).alias("s")).collect()
    right = [(r["s"] >= 0.7) == (r["doc_id"] % 4 > 0) for r in got if r["out"]]
    assert len(right) > 100 and np.mean(right) > 0.97


def test_scores_are_those_of_all_cosines(quality):
    docs, model = quality
    texts = [r["text"] for r in docs.select("text").limit(40).collect()]
    for text, score in zip(texts, model.score(texts)):
        v = (Q.terms(text) * model.weight) @ model.space
        cosine = model.vectors @ (v / np.linalg.norm(v))
        near = np.argsort(-cosine, kind="stable")[: Q.NEAREST]
        votes = np.maximum(cosine[near], 0).astype(float) ** Q.SHARPNESS
        assert score == pytest.approx((votes * model.labels[near]).sum() / votes.sum(), abs=0.05)


def test_document_frequencies(documents):
    rows = odd_rows()
    n, frequency = Q.document_frequencies(documents(rows))
    assert n == len(rows) and frequency.tolist() == sum((Q.terms(r[1]) > 0).astype(int) for r in rows).tolist()


def test_quality_of_odd_rows(quality, documents, labels):
    scores = [r[0] for r in documents(odd_rows()).select(Q.score(quality[1])).collect()]
    assert len(scores) == len(odd_rows()) and all(0 <= s <= 1 for s in scores)
    none = Q.fit(documents(odd_rows()), labels([]), F.lit(True))
    assert {r[0] for r in documents(odd_rows()).select(Q.score(none)).collect()} == {0.5}
    assert documents([]).select(Q.score(Q.fit(documents([]), labels([(1, 1, 1)]), F.lit(True)))).count() == 0


def test_more_languages_than_one_sample_of_each_fits(documents, monkeypatch):
    monkeypatch.setattr(I, "LEARNED", 140)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = random.Random(6)
    word = lambda n: letters[n % 26] + letters[(3 * n + 1) % 26] + rng.choice("xyz") + letters[(n // 26 + 5) % 26]
    rows = [(100 * n + k, " ".join(word(n) for _ in range(30)), f"l{n}", None) for n in range(70) for k in range(4)]
    docs = documents(rows)
    model = I.fit(docs, F.lit(True))
    assert sum(map(len, model.families)) == 70
    found = docs.select("lang", I.prediction(model).alias("p")).collect()
    assert sum(r["lang"] == r["p"]["language"] for r in found) > 0.95 * len(rows)
