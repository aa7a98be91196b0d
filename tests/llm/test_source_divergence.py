"""Distances and terms against a plain count, in small blocks and cells, and on odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import odd_rows, prose
from tierline.llm import source_divergence as S


def plain(rows, least, top):
    count, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = Counter(re.findall(S.TERM, low))
        count[lang, source].update(terms)
        held[lang].update(terms.keys())
        groups[lang].add(source)
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        number = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}
        p = {s: number(count[lang, s]) for s in sources}
        q = number(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept)) for o in sources - {s}]
            terms = [(t, (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode("utf-8", "surrogatepass")))
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(items[:most], 1)}
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("w", "The", "é", "Ü", "日本") for b in "abcdefgh"] + ["the", "THE,the", "x/y", "don't", "a-b c", "1,2", "the.", "(the)"]
    return [(k, prose(rng, rng.randrange(60), words), rng.choice(["en", "en", "fr", None, "solo"]), rng.choice(["s1", "s2", "S3", "ß", None, ""])) for k in range(150)]


@pytest.mark.parametrize("block, sources, terms", [(6_000_000, 128, 2048), (90, 2, 3)])
def test_equals_a_plain_count(documents, monkeypatch, block, sources, terms):
    monkeypatch.setattr(S, "SOURCES", sources)
    monkeypatch.setattr(S, "TERMS", terms)
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "TOGETHER", 3)
    monkeypatch.setattr(S, "SLICE", 20 if block < 100 else 500_000)
    rows = [(k, t, lang, "only" if lang == "solo" else s) for k, t, lang, s in corpus(1)] + odd_rows() + [(900, None, "none", "a"), (901, "rare", "none", "b"), (902, "", "en", "empty")]
    got = [tuple(r) for r in S.divergence(documents(rows).repartition(3), least=10, top=10).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, 10, 10)


def test_a_document_counts_once_for_all_chunks_with_a_term(documents):
    rows = [(1, "a a, A. (a) b", "en", "s"), (2, "a", "en", "s"), (2, "a", "en", "t")]
    got = {(r["source"], r["term"]): (r["docs"], r["n"]) for r in S.term_counts(documents(rows)).collect()}
    assert got == {("s", "a"): (2, 5), ("s", "b"): (1, 1), ("t", "a"): (1, 1)}


def test_empty_table(documents):
    assert S.divergence(documents([])).count() == 0
