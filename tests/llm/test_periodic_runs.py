"""Runs and their digests against brute force, in pieces of any length, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.conftest import odd_rows
from tierline.llm import periodic_runs as P
from tierline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def force(words, exponent=4, shortest=6):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((i, n, q) for (i, n), q in found.items())


def samples(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        words = [str(rng.randrange(rng.choice([1, 2, 2, 3, 5]))) for _ in range(rng.randrange(120))]
        if rng.random() < 0.6 and len(words) > 4:
            a = rng.randrange(len(words))
            p = 1 + rng.randrange((len(words) - a) // 3 + 1)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, len(words))]
        yield words * rng.choice([1, 1, 2, 5])


@pytest.mark.parametrize("exponent, shortest", [(2, 2), (3, 6), (4, 6), (5, 1)])
def test_runs_equal_brute_force(exponent, shortest, monkeypatch):
    for k, words in enumerate(samples(exponent, 300)):
        monkeypatch.setattr(P, "PIECE", (5, 64, 1 << 18)[k % 3])
        assert P.runs_of(words, exponent, max(shortest, exponent)) == force(words, exponent, max(shortest, exponent))


def test_appended_word_by_word():
    for words in samples(9, 20):
        catcher = P.RunCatcher()
        numbers = np.array([int(w) for w in words], np.int64)
        for k in range(len(numbers)):
            catcher.append(numbers[k : k + 1])
            if k % 17 == 0 or k == len(numbers) - 1:
                assert catcher.runs() == force(words[: k + 1])


def test_words_of_one_hash_are_told_apart(monkeypatch):
    class Word(str):
        __hash__ = lambda self: 1

    words = [Word(f"w{k % 50}") for k in range(120)] + [Word("x")] * 7
    assert P.runs_of(words) == force(words) == [(120, 7, 1)]


def test_long_texts():
    for words in ([b"a"] * 100_000, [b"x%d" % (k % 777) for k in range(100_000)], [b"x%d" % (k // 6) for k in range(60_000)], [b"x%d" % k for k in range(100_000)]):
        runs = P.runs_of(words)
        assert runs == ([(0, 100_000, 1)] if words[0] == words[1] == words[7] else [(0, 100_000, 777)] if words[777:778] == words[:1] else [(6 * k, 6, 1) for k in range(10_000)] if words[0] == words[1] else [])


def plain(key, text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = force(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return key, len(runs), *top, sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)), sha(left)


def test_query_equals_brute_force(spark):
    want = [plain(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r["text"] or "") < 30_000]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert [got[r[0]] for r in want] == want and len(got) == 200


def test_odd_rows(documents):
    rows = [r for r in odd_rows() if r[0] != 5] + [(8, "a " * 30 + "b c " * 30, None, None), (8, "x y " * 8 + "\x0b\x0c\x1f\r z", "en", None), (9, "a b a b a b a b a b a a a a a a", None, None)]
    found = P.digest(P.periodic_runs(documents(rows), rewrite=True))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(plain(*r[:2])) for r in rows)
    assert P.periodic_runs(documents([])).count() == 0
