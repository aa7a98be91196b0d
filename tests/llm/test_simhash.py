"""Fingerprints against a plain version, links and groups against brute force, and what the stage keeps."""

from __future__ import annotations

import random

import numpy as np
import xxhash

from tests.llm.conftest import odd_rows, prose
from tierline.llm import simhash_dedup as S
from tierline.llm.common import components


def plain(text, width=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_force(prints, reach):
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= reach:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def test_fingerprint_is_the_plain_one():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50):
        text = prose(rng, n, ["The", "QUICK", "brown", "Füchse", "É", "a\tb", "x"])
        assert S.fingerprint(text) == plain(text)
    assert S.fingerprint(None) == S.fingerprint(" \n ") == 0
    assert S.fingerprint("É a b") != S.fingerprint("é a b")  # only A-Z is lowered


def near_points(rng, n):
    """Random points, and chains and stars around some."""
    points = [rng.getrandbits(64) for _ in range(n)]
    for p in points[: n // 8]:
        for _ in range(4):
            p ^= 1 << rng.randrange(64)
            points.append(p)
    return list(dict.fromkeys(points))


def test_links_over_many_shards_join_what_all_pairs_join(spark):
    points = near_points(random.Random(2), 1500)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fingerprint long")
    for reach in (0, 2, 5):
        found = components(S.links(frame, reach, shard=100)).collect()
        root = {r["node"]: r["root"] for r in found}
        mine = [root.get(p - (1 << 64) if p >> 63 else p, p) for p in points]
        force = groups_by_force(points, reach)
        assert len(set(zip(mine, force))) == len(set(mine)) == len(set(force))


def test_splitting_in_memory_finds_every_pair(monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 16)
    monkeypatch.setattr(S, "FOLD", 10)
    points = near_points(random.Random(3), 800)
    labels = S.near_links(np.array(points, np.uint64), len(points), 2)
    assert labels.tolist() == groups_by_force(points, 2)


def test_one_dense_group_stays_linear(spark):
    base = random.Random(4).getrandbits(62)
    points = [base ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)]
    frame = spark.createDataFrame([(p,) for p in points], "fingerprint long")
    links = S.links(frame, 2, shard=100).collect()
    assert len(links) < 20 * len(points)
    assert len({r["root"] for r in components(spark.createDataFrame(links)).collect()}) == 1


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5000), (-3, -9), (-9, 7000), (7000, -3)]
    rng.shuffle(edges)
    root = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {root[k] for k in range(301)} == {0} and {root[1000 + k] for k in range(400)} == {1000}
    assert root[-3] == root[7000] == -9 and 5000 not in root


def test_groups_of_odd_rows(documents):
    rows = odd_rows()
    got = S.near_groups(S.fingerprints(documents(rows))).collect()
    assert len(got) == len(rows)
    zero = [r for r in got if r["fingerprint"] == 0]
    assert len(zero) == 4 and {r["component"] for r in zero} == {1}
    assert {r["component"] for r in got if r["id"] == 4} == {4}
    assert [r["component"] for r in got if r["id"] is None and r["fingerprint"]] == [6]
    assert S.near_groups(S.fingerprints(documents([]))).count() == 0


def test_one_of_each_group_stays(documents):
    docs = documents(odd_rows())
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    # Rows without words are one group (ids 1, 2, 3 and one without id), the two of seven words another (6 and one without id).
    got = sorted((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect())
    assert got == [(1, ""), (4, "one"), (5, got[2][1]), (6, "one t"), (7, "the o"), (7, "Ünï c")]
    assert S.keep_one(documents([])).count() == 0


def test_rows_go_by_their_text_and_not_by_their_id(documents):
    rng, words = random.Random(8), [f"w{k}" for k in range(300)]
    t, other = prose(rng, 80, words), prose(rng, 80, words)
    kept = S.keep_one(documents([(3, t), (7, t), (7, other), (None, t), (None, t + " x"), (9, other), (9, other)]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["text"] in (t, other)) == [(3, t), (7, other)]
