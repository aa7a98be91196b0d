from __future__ import annotations

import random
import re

import regex
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import odd_rows, prose
from tierline.llm import spot_signatures as S


def short(*parts):
    value = 42
    for p in parts:
        value = xxhash.xxh64_intdigest(p.encode(), value) if p is not None else value
    return (value & 0xFFFFFFFF) - (1 << 31)


def plain(text):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    content = [(w, words[k - 1] if k else None) for k, w in enumerate(words) if w not in S.COMMON]
    get = lambda of, k: of[k] if k < len(of) else None
    names = [w for w, _ in content]
    found = {short(b, w, get(names, k + 1), get(names, k + 2)) for k, (w, b) in enumerate(content) if b in S.COMMON}
    return found or {short(w, get(words, k + 1), get(words, k + 2)) for k, w in enumerate(words)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def texts(rng, n):
    words = ["the", "of", "und", "le", "Straße", "été", "cat", "dog", "house", "x1", "tree."]
    return [(k, prose(rng, rng.randrange(0, 60), words)) for k in rng.sample(range(10 * n), n)]


def test_signatures_are_the_plain_ones(documents):
    rows = texts(random.Random(1), 60) + odd_rows()
    got = S.with_signatures(documents(rows).select("text"), "text", "s").collect()
    for r in got:
        assert set(r["s"]) == plain(r["text"]) and r["s"] == sorted(set(r["s"]))
    assert S.with_signatures(documents([]).select("text"), "text", "s").count() == 0


def test_next_document_and_edited_text(documents, monkeypatch):
    monkeypatch.setattr(S, "ROWS", 7)
    rows = texts(random.Random(2), 200)
    edited = S.edited(S.with_next(documents(rows), ["text"]))
    got = {r["doc_id"]: r for r in edited.collect()}
    order = sorted(rows)
    for k, (key, text) in enumerate(order):
        after, n = order[(k + 1) % len(order)][1], len(text)
        assert got[key]["next_text"] == after
        assert got[key]["n_chars"] == n and got[key]["edited"] == text[: n - n // 2] + after[: n // 2]


def test_next_of_odd_rows(documents, monkeypatch):
    monkeypatch.setattr(S, "ROWS", 2)
    docs = documents(odd_rows())
    led = S.with_next(docs, ["doc_id", "text"])
    assert led.columns == [*docs.columns, "next_doc_id", "next_text"]
    rows = led.collect()
    assert len(rows) == len(odd_rows())
    assert sorted(repr(r["next_doc_id"]) for r in rows) == sorted(repr(r[0]) for r in odd_rows())
    assert [r["next_doc_id"] for r in rows if r["doc_id"] in (1, 2, 3)] == [2, 3, 4]
    assert S.with_next(documents([]), ["text"]).count() == 0
    assert [r["next_text"] for r in S.with_next(documents([(1, "a")]), ["text"]).collect()] == ["a"]


def test_buckets_in_two_steps(spark):
    edges = [10 * k for k in range(1, 40)]
    ids = spark.range(-5, 450).select("id", S._bucket(F.col("id"), edges).alias("b")).collect()
    assert all(r["b"] == sum(e <= r["id"] for e in edges) for r in ids)


def test_likeness(spark):
    frame = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([], [1]), ([1], [1, 2, 3, 4, 5])], "a array<int>, b array<int>")
    assert [r[0] for r in frame.select(S.likeness(F.col("a"), F.col("b"))).collect()] == [0.5, 1.0, 0.0, 0.2]
    assert [r[0] for r in frame.select(S.likeness(F.col("a"), F.col("b"), 0.5)).collect()] == [0.5, 1.0, 0.0, 0.0]


def test_pairs_by_length_partitions(spark):
    rng = random.Random(3)
    sets = []
    for _ in range(60):
        base = set(rng.sample(range(3000), rng.randrange(1, 60)))
        sets += [base, base | {rng.randrange(3000)}, base - {min(base)} if len(base) > 1 else base, base | set(rng.sample(range(3000), 9))]
    sets = [sorted(s) for s in {tuple(sorted(s)) for s in sets}]
    frame = spark.createDataFrame(list(enumerate(sets)), "id long, signatures array<int>")
    got = {(r["a"], r["b"]) for r in S.near_pairs(frame, 0.8).collect()}
    assert got == {(i, j) for j in range(len(sets)) for i in range(j) if jaccard(set(sets[i]), set(sets[j])) >= 0.8} and got


def test_no_python_in_the_plan(documents, capsys):
    S.with_next(S.with_signatures(documents([(1, "a"), (2, "b")]), "text", "s"), ["text", "s"]).explain("formatted")
    text = capsys.readouterr().out
    assert not re.search("PythonUDF|EvalPython|InPandas|InArrow|Cartesian|NestedLoop", text)


