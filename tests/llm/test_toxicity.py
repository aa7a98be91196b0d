"""The decoder against all readings, counts against a plain version, and held-out accuracy on planted words, plain and disguised."""

from __future__ import annotations

import itertools
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import odd_rows, prose
from tierline.llm import toxicity as T
from tierline.llm.common import held_out

CLEAN = "river stone garden window letter morning travel simple number orange winter kitchen story music paper".split()
TOXIC = ["idiot", "moron", "worthless"]


def corpus(n, rng):
    rows, labels = [], []
    for k in range(n):
        words = prose(rng, 30, CLEAN).split()
        if toxic := k % 5 == 0:
            words.insert(rng.randrange(30), rng.choice(TOXIC))
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(documents, labels):
    rows, marks = corpus(800, random.Random(1))
    docs = documents(rows + [(None, None)])
    return docs, T.fit(docs, labels(marks + [(None, 1, 1), (3, 1, None), (99999, 1, 1)]), ~held_out(F.col("doc_id"), 5, 0))


def test_counts_are_the_plain_ones(documents, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 7)
    rows = odd_rows()[:5] + [(8, "Some Text, with signs! é"), (9, "exactly7")]
    got = {r["code"]: r["n"] for r in T.trigram_counts(documents(rows)).collect()}
    want = Counter()
    for _, text, *_ in rows:
        s = T.symbols(f"  {text or ''} ").tolist()
        want.update(a << 10 | b << 5 | c for a, b, c in zip(s, s[1:], s[2:]))
    assert got == dict(want)


def test_viterbi_finds_the_cheapest_of_all_readings(fitted):
    decoder = fitted[1].decoder

    def cost(reading):
        s = [0, 0, *T.symbols(reading).tolist(), 0]
        return sum(decoder.cost[a, b, c] for a, b, c in zip(s, s[1:], s[2:]))

    for word in ("1d10t", "m0r0n", "w0rthl3$$", "iiidiot", "st0ne", "k1tch3n", "a1"):
        paths = itertools.product(*decoder._lattice(word))
        best = min(cost("".join(x for x, _ in p)) + sum(c for _, c in p) for p in paths)
        restored = decoder.restore(word)
        extra = min(sum(c for _, c in p) for p in itertools.product(*decoder._lattice(word)) if "".join(x for x, _ in p) == restored)
        assert cost(restored) + extra == pytest.approx(best)


def test_disguised_words_are_restored(fitted):
    words = fitted[1].decoder.words
    for raw, want in (("1d10t", "idiot"), ("m0r0n", "moron"), ("idiooot", "idiot"), ("i.d.i.o.t", "idiot"), ("w0rthle$s!", "worthless")):
        assert words(raw) == [want]
    for raw in ("stone", "stone,", "(paper)"):
        assert words(raw) == [raw.strip(",()")]
    assert words("idi" + "o" * 90 + "t") == ["idiot"]
    assert "idiot" in words("you,are,an,1d10t,and/that,is,all,there,is,to,say") and "moron" in words("m.0.r.0.n,")
    assert words("2024") == [] and words("192.168.0.1") == []


@pytest.mark.parametrize(
    "text, want",
    [
        ("so m o r o n here", ["moron"]), ("i d i o t, go", ["idiot"]), ("you i d i o t.", ["idiot"]), ("m o r o n. i d i o t", ["moron", "idiot"]),
        ("what an id iot", ["idiot"]), ("the mor on said", ["moron"]), ("i.d.i.o.t and m-o-r-o-n", ["idiot", "moron"]), ("1 d 1 0 t", ["idiot"]),
        ("i  d  i\no t", ["idiot"]), ("m 0 r 0 n!", ["moron"]),
    ],
)
def test_blanks_and_marks_are_in_the_lattice(fitted, text, want):
    found = T.Reader(fitted[1].decoder, lambda w: (w,))(text)
    assert set(want) <= found, found


def test_plain_words_stay_and_long_runs_are_linear(fitted):
    read = T.Reader(fitted[1].decoder, lambda w: (w,))
    assert read("river stone garden, window") == {"river", "stone", "garden", "window"}
    assert read("1 2 3 4 5") == set() and read("\u00b2 \u0660 a") is not None
    started = time.perf_counter()
    read("x" + "01" * 50_000 + "y")
    read("a b " * 20_000)
    assert time.perf_counter() - started < 60


def test_held_out_rows_are_told_apart(fitted):
    docs, model = fitted
    got = docs.filter("doc_id IS NOT NULL").select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("out"), T.score(model).alias("s")).collect()
    right = [(r["s"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in got if r["out"]]
    assert len(right) > 100 and np.mean(right) == 1.0


def test_disguised_and_odd_texts_are_scored(fitted, documents):
    rng = random.Random(2)
    toxic = [(k, prose(rng, 10, CLEAN) + f" {w} " + prose(rng, 10, CLEAN)) for k, w in enumerate(["1d10t", "M0R0N", "i d i o t", "wooorthless", "w0rthle$$"])]
    assert all(r[0] >= 0.5 for r in documents(toxic).select(T.score(fitted[1])).collect())
    scores = [r[0] for r in documents(odd_rows()).select(T.score(fitted[1])).collect()]
    assert all(0 <= s < 0.5 for s in scores)


def test_without_labels_or_documents(documents, labels):
    for docs, marks in ((documents(odd_rows()), labels([])), (documents([]), labels([(1, 1, 1)])), (documents(odd_rows()), labels([(4, 1, 1), (4, 1, 1)]))):
        model = T.fit(docs, marks, F.lit(True))
        assert all(r[0] < 1e-9 for r in docs.select(T.score(model)).collect())


def test_logistic_recovers_a_rule():
    x = (np.random.default_rng(1).random((500, 4)) < 0.5).astype(np.float32)
    w, b = T.logistic(x, (x[:, 0] > 0).astype(float))
    assert w[0] > 5 and b < -2 and np.abs(w[1:]).max() < 1
