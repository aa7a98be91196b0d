from __future__ import annotations

import random
import zlib

from tests.llm.conftest import odd_rows
from tierline.llm import kd_sharding as K


def shards(docs, n):
    return K.shard_by_tree(K.sizes(docs, K.metadata(docs)), n).toPandas()


def check(got, rows, n):
    assert len(got) == len(rows)
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert got["shard"].between(0, n - 1).all()
    want = sorted(((r[0] is None, r[0] or 0), len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    ids = [(i != i, 0 if i != i else int(i)) for i in got["id"].astype(float)]
    assert sorted(zip(ids, got["size"], got["text_crc32"])) == want


def test_bytes_are_near_equal_for_skewed_sizes_and_sources(documents):
    rng = random.Random(1)
    rows = [(k, "x" * int(rng.paretovariate(0.9) * 10 % 3000), "en", "hot" if k % 3 else f"s{k % 7}") for k in range(3000)]
    for n in (8, 5, 1):
        got = shards(documents(rows), n)
        check(got, rows, n)
        sums = got.groupby("shard")["size"].sum()
        assert len(sums) == n and sums.max() - sums.min() <= 2 * 3000 + 0.001 * sums.sum()


def test_a_group_of_repeated_rows_is_cut_anywhere(documents):
    rows = [(7, "same text", "en", "s")] * 900 + [(k, "other", "en", "t") for k in range(100)]
    got = shards(documents(rows), 8)
    check(got, rows, 8)
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 3 * 10


def test_odd_rows(documents):
    got = shards(documents(odd_rows()), 8)
    check(got, odd_rows(), 8)
    assert len(shards(documents([]), 8)) == 0
    assert len(shards(documents([(1, "a")]), 8)) == 1


def test_large_ids_survive(documents):
    big = (1 << 53) + 1
    rows = K.shard_by_tree(K.sizes(d := documents([(big, "a"), (None, "b"), (big + 2, "c")]), K.metadata(d)), 2).collect()
    assert {r["id"] for r in rows} == {big, None, big + 2}


def test_shards_for_a_target(documents):
    docs = documents([(k, "x" * 99) for k in range(10)])
    assert K.shards_for(K.sizes(docs, K.metadata(docs)), 300) == 4
    assert K.shards_for(K.sizes(documents([]), K.metadata(docs)), 300) == 1
