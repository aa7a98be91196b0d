from __future__ import annotations

import random
from collections import Counter

import numpy as np

from tests.llm.conftest import odd_rows, prose
from tierline.llm import decontamination as D


def plain(text, items, threshold=D.THRESHOLD):
    words, out = D.words_of(text), {}
    for key, item in items:
        own = D.words_of(item)
        if not words or not own:
            continue
        for start in range(max(1, len(words) - len(own) + 1)):
            part = words[start : start + len(own)]
            value = D.similarity(Counter(D.shingles_of(part)), Counter(D.shingles_of(own)))
            if value >= threshold and (key not in out or value > out[key][0]):
                out[key] = (value, start, len(part))
    return out


def test_multi_index_finds_all_pairs_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 200, np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k % 30, replace=False)) for k in range(300)], np.uint64)
    windows = prints[np.arange(300) % 200] ^ flips
    for radius in (0, 3, 12, 18):
        a, b = D.MultiIndex(prints, radius).near(windows)
        want = np.argwhere(np.bitwise_count(windows[:, None] ^ prints[None, :]) <= radius)
        assert list(zip(a.tolist(), b.tolist())) == [tuple(x) for x in want.tolist()]


def test_multi_index_prunes_and_bounds_what_it_compares(monkeypatch):
    monkeypatch.setattr(D, "PAIRS", 500)
    rng = np.random.default_rng(2)
    prints, windows = (rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + rng.integers(0, 2, n, np.uint64) for n in (300, 2_000))
    index, compared = D.MultiIndex(prints, D.RADIUS), 0
    for low, _, values, _ in index.blocks:
        own = (windows >> low).astype(np.uint16)
        compared += int((np.searchsorted(values, own, "right") - np.searchsorted(values, own, "left")).sum())
    assert compared < len(prints) * len(windows) / 5
    assert all(len(a) <= 500 + len(prints) for a, _ in index.near_in_parts(windows))
    a, b = index.near(windows)
    want = np.argwhere(np.bitwise_count(windows[:, None] ^ prints[None, :]) <= D.RADIUS)
    assert list(zip(a.tolist(), b.tolist())) == [tuple(x) for x in want.tolist()]
    assert all(len(x) == 0 for x in index.near(windows[:0]))


def cases():
    rng = random.Random(2)
    words = [f"w{k}" for k in range(500)]
    items = [(k, prose(rng, rng.randrange(12, 55), words)) for k in range(40)] + [(50, "short one"), (51, "w1 w1 w1 w1 w1 w1 w1 w1"), (52, None), (53, "  "), (54, items_twice := "a b c d e f g h"), (55, items_twice)]
    docs = []
    for k in range(160):
        item = rng.choice(items[:40])[1].split()
        for _ in range(k % 4):  # edits
            item[rng.randrange(len(item))] = "changed"
        docs.append((k, " ".join([prose(rng, rng.randrange(0, 80), words), *item, prose(rng, rng.randrange(0, 80), words)]).upper()))
    docs += [(200, "short one"), (201, "a short one here and more words"), (202, "w1 " * 300), (203, "a b c d e f g h " * 3), (204, items[3][1][:-4])]
    return items, docs


def test_windows_equal_brute_force(documents, spark):
    items, docs = cases()
    finder = D.Finder(items, D.WIDTH, D.THRESHOLD, D.RADIUS)
    missed = 0
    for key, text in docs:
        got = {finder.items[i][0]: v for i, v in finder.find(text).items()}
        want = plain(text, items)
        assert got.keys() <= want.keys() and all(got[k] == want[k] for k in got if k != 51)
        missed += len(want.keys() - got.keys())
        assert all(v[0] < 0.9 for k, v in want.items() if k not in got)
    assert missed <= 1


def test_in_blocks_of_items(documents, spark, monkeypatch):
    items, docs = cases()
    frame = spark.createDataFrame([(*i, "7", "7") for i in items], "item_id long, text string, doc_id string, words string")
    rows = lambda: sorted(tuple(r) for r in D.matches(documents(docs + odd_rows()), frame).collect())
    whole = rows()
    monkeypatch.setattr(D, "BLOCK_ITEMS", 7)
    assert rows() == whole and len(whole) > 50


def test_clean_drops_leaks_only(documents, spark):
    items, docs = cases()
    frame = spark.createDataFrame(items, "item_id long, text string")
    clean = [(300, "nothing of the kind is said in here at all"), *odd_rows()]
    table = documents(docs + clean)
    kept = D.clean(table, frame)
    assert kept.columns == table.columns
    want = [r[0] for r in clean] + [k for k, t in docs if not plain(t, items)]
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == sorted(map(repr, want))


def test_rows_go_by_their_text_and_not_by_their_id(documents, spark):
    items, docs = cases()
    frame = spark.createDataFrame(items, "item_id long, text string")
    key, leak = next((k, t) for k, t in docs if plain(t, items))
    kept = D.clean(documents([(key, leak), (key, "a clean text of the same id"), (None, leak), (None, "another")]), frame)
    assert sorted(r["text"] for r in kept.collect()) == ["a clean text of the same id", "another"]


def test_empty_tables(documents, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(documents(odd_rows()), none).count() == 0
    assert D.matches(documents([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
