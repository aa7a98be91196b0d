"""Benchmark decontamination: which documents hold a passage of which benchmark item.

A document is reported for an item if one of its windows of the item's length in words has a weighted-shingle similarity of at least
THRESHOLD to the item: shingles of five words, weighted by how often they occur; the sum of the smaller weights over the sum of the greater.
Words are what white space separates, in lower case.

Method: a window can only be similar if it shares a shingle with the item, so positions of benchmark shingles pick the windows. Their SimHash
is looked up in a multi-index of four blocks of 16 bits: any item fingerprint within RADIUS bits is within 4 bits of it in one of the first
three blocks or within 3 in the last, and stands in the block's table under all such values.
Candidates within the radius are verified by the exact similarity of their shingles. What is beyond the radius is not reported: at
similarity 0.8 fingerprints differ by 10 bits on average (deviation 3), so a radius of 18 leaves out less than one such window in a hundred,
and near-identical ones never.

Plan: one pass over the documents per block of items; a block is bounded by BLOCK_ITEMS and BLOCK_BYTES and is all that tasks hold besides
their rows: the tables of a full block take about 200 MB in a Python process. Nothing is shuffled. A long document is worked through in parts that overlap by the longest item.

Null or blank texts hold nothing; null or blank items are found nowhere. Texts shorter than an item are one window; sequences shorter than five words
are one shingle. Repeated rows give repeated results, also with a null id. An empty table on either side gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH, THRESHOLD, RADIUS = 5, 0.8, 18
BLOCK_ITEMS, BLOCK_BYTES, PART, PAIRS = 4_000, 1 << 24, 1 << 15, 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def shingles_of(words: list[str], width: int = WIDTH) -> list[str]:
    return [" ".join(words[k : k + width]) for k in range(max(1, len(words) - width + 1))] if words else []


def similarity(a: Counter, b: Counter) -> float:
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (a.total() + b.total() - common) if a or b else 0.0


def quick_hashes(words: list[str], width: int) -> np.ndarray:
    """One number for each full shingle, the same for equal shingles within a Python process; used only to find positions to look at."""
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - width + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(width if n > 0 else 0):
        out += (h[k : k + n] ^ (h[k : k + n] >> np.uint64(29))) * _ODD[k % 5]
    return out ^ (out >> np.uint64(32))


def bits_of(shingles: list[str]) -> np.ndarray:
    """(shingle, 64) of 0 and 1."""
    hashes = np.array([xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 42) for s in shingles], "<u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def packed(ones: np.ndarray, of: int) -> np.ndarray:
    """Fingerprints of rows of bit counts over `of` shingles."""
    return np.packbits(2 * ones > of, axis=-1, bitorder="little").view("<u8")[..., 0]


class MultiIndex:
    """Fingerprints in four blocks of 16 bits; `near` finds all pairs within the radius.

    Block k reaches `reach[k]` bits, and the reaches and their number add up to the radius and one: a pair that is further apart in every
    block is beyond the radius. Each fingerprint stands in a block's table under all values within the reach, so a window looks up its own
    value only. At a radius of 18 the reaches are 4, 4, 4 and 3: of random pairs one in eight is compared, and a fingerprint has 8,248 entries.
    """

    BLOCKS, BITS = 4, 16

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius, self.blocks = prints, radius, []
        for k in range(self.BLOCKS):
            low, reach = np.uint64(k * self.BITS), (radius + 1) // self.BLOCKS - 1 + (k < (radius + 1) % self.BLOCKS)
            masks = np.arange(1 << self.BITS, dtype=np.uint16)
            masks = masks[np.bitwise_count(masks) <= reach] if reach >= 0 else masks[:0]
            values = ((prints >> low).astype(np.uint16)[:, None] ^ masks).ravel()
            order = np.argsort(values, kind="stable")
            self.blocks.append((low, reach, values[order], (order // max(1, len(masks))).astype(np.int32)))

    def near_in_parts(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, fingerprint) positions of all pairs within the radius, each once; about PAIRS of them are compared at a time."""
        for k, (low, _, values, prints) in enumerate(self.blocks):
            own = (windows >> low).astype(np.uint16)
            first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            until, start = np.cumsum(last - first), 0
            while start < len(windows):
                before = until[start - 1] if start else 0
                end = max(start + 1, int(np.searchsorted(until, before + PAIRS, "right")))
                count = (last - first)[start:end]
                window = np.repeat(np.arange(start, end), count)
                at = np.arange(len(window)) - np.repeat(until[start:end] - count - before, count) + np.repeat(first[start:end], count)
                item = prints[at]
                apart = windows[window] ^ self.prints[item]
                new = np.bitwise_count(apart) <= self.radius
                for other, reach, _, _ in self.blocks[:k]:  # what an earlier block has found
                    new &= np.bitwise_count((apart >> other).astype(np.uint16)) > reach if reach >= 0 else True
                yield window[new], item[new]
                start = end

    def near(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same pairs at once, sorted."""
        window, item = (np.concatenate(x) for x in zip((np.zeros(0, int), np.zeros(0, int)), *self.near_in_parts(windows)))
        order = np.lexsort((item, window))
        return window[order], item[order]


class Finder:
    """Items of one block, indexed once in each Python process."""

    def __init__(self, items: list[tuple[int, str]], width: int, threshold: float, radius: int):
        self.width, self.threshold = width, threshold
        self.items, self.by_size = [], {}
        for key, text in items:
            if words := words_of(text):
                self.by_size.setdefault(len(words), []).append(len(self.items))
                self.items.append((key, words, Counter(shingles_of(words, width))))
        self.longest = max(self.by_size, default=0)
        self.index, hashes, sizes, self.short = {}, [], [], {}
        for size, which in self.by_size.items():
            prints = []
            for i in which:
                bits = bits_of(list(self.items[i][2].elements()))
                prints.append(packed(bits.sum(axis=0, dtype=np.int64), len(bits)))
            self.index[size] = MultiIndex(np.array(prints, np.uint64), radius)
            for i in which:
                if size >= width:
                    own = np.unique(quick_hashes(self.items[i][1], width))
                    hashes.append(own)
                    sizes.append(np.full(len(own), size))
                else:
                    self.short.setdefault(size, []).append(i)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.sizes = self.hashes[order], self.sizes[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.hashes >> np.uint64(42)] = True

    def find(self, text: str | None) -> dict[int, tuple[float, int, int]]:
        """Item position -> (similarity, first word, words) of its best window, the earliest of equals."""
        words, best = words_of(text), {}
        if not words or not self.items:
            return best
        if len(words) < self.width:
            self._verify(words, 0, len(words), [i for i in self.short.get(len(words), ())], best)
            return best
        for size, which in self.short.items():
            keys = {tuple(self.items[i][1]): [] for i in which}
            for i in which:
                keys[tuple(self.items[i][1])].append(i)
            for at in range(len(words) - size + 1):
                self._verify(words, at, size, keys.get(tuple(words[at : at + size]), ()), best)
        hashes = quick_hashes(words, self.width)
        hits = np.flatnonzero(self.seen[hashes >> np.uint64(42)])
        if len(hits):
            first, last = np.searchsorted(self.hashes, hashes[hits], "left"), np.searchsorted(self.hashes, hashes[hits], "right")
            hits, first, last = hits[last > first], first[last > first], last[last > first]
        at = 0
        while at < len(hits):  # parts of the document around hits; windows of one hit reach no further than the longest item
            end = at + 1
            while end < len(hits) and hits[end] - hits[end - 1] < self.longest and hits[end] - hits[at] < PART:
                end += 1
            self._windows(words, hits[at:end], first[at:end], last[at:end], best)
            at = end
        return best

    def _windows(self, words: list[str], hits: np.ndarray, first: np.ndarray, last: np.ndarray, best: dict) -> None:
        low, high = max(0, int(hits[0]) - self.longest), min(len(words), int(hits[-1]) + self.longest + self.width)
        ones = np.cumsum(bits_of(shingles_of(words[low:high], self.width)), axis=0, dtype=np.int32)
        ones = np.concatenate([np.zeros((1, 64), np.int32), ones])
        of_size = np.repeat(hits, last - first), self.sizes[np.concatenate([np.arange(a, b) for a, b in zip(first, last)])]
        for size in np.unique(of_size[1]).tolist():
            used = min(size, len(words))
            count = used - self.width + 1
            marks = np.zeros(len(ones), np.int64)
            marks[1 + of_size[0][of_size[1] == size] - low] = 1
            marks = np.cumsum(marks)
            starts = np.arange(max(0, min(high, len(words)) - used - low + 1))
            starts = starts[marks[starts + count] > marks[starts]]
            if not len(starts):
                continue
            prints = packed(ones[starts + count] - ones[starts], count)
            of_size_items = np.array(self.by_size[size])
            for window, item in self.index[size].near_in_parts(prints):
                for start, i in zip((starts[window] + low).tolist(), of_size_items[item].tolist()):
                    self._verify(words, start, used, (i,), best)

    def _verify(self, words: list[str], start: int, size: int, which, best: dict) -> None:
        own = Counter(shingles_of(words[start : start + size], self.width)) if which else None
        for i in which:
            value = similarity(own, self.items[i][2])
            if value >= self.threshold and (i not in best or (-value, start) < (-best[i][0], best[i][1])):
                best[i] = (value, start, size)


_FINDERS: dict[tuple, Finder] = {}


def matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, start, words): for each document and item the best window, its first word and its length in words."""
    found = None
    for block in _blocks(items):
        part = _in_block(docs, block, width, threshold, radius)
        found = part if found is None else found.unionByName(part)
    return found


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The distinct items in bounded blocks, each sorted; one block, empty, where there are none."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-count // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).distinct()
        yield sorted([(r[0], r[1]) for r in block.collect()], key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))


def _key(items: list[tuple[int, str]], width: int, threshold: float, radius: int) -> tuple:
    return xxhash.xxh64_hexdigest(repr(items).encode("utf-8", "surrogatepass")), width, threshold, radius


def _finder(key: tuple, items: list[tuple[int, str]], width: int, threshold: float, radius: int) -> Finder:
    if key not in _FINDERS:
        _FINDERS.clear()
        _FINDERS[key] = Finder(items, width, threshold, radius)
    return _FINDERS[key]


def _in_block(docs: DataFrame, items: list[tuple[int, str]], width: int, threshold: float, radius: int) -> DataFrame:
    key = _key(items, width, threshold, radius)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _finder(key, items, width, threshold, radius)
        for batch in batches:
            rows = [(n, finder.items[i][0], *x) for n, text in enumerate(batch.column("text").to_pylist()) for i, x in sorted(finder.find(text).items())]
            of, item, value, start, size = zip(*rows) if rows else [()] * 5
            columns = [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(item, pa.int64()), pa.array(value, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(start, pa.int64()), pa.array(size, pa.int64())], names)

    names = ["doc_id", "item_id", "similarity", "start", "words"]
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(find, "doc_id long, item_id long, similarity double, start long, words long")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that hold no benchmark passage, in their own columns: one pass over the texts, nothing is shuffled. Each row is judged by its own text."""
    for found in _blocks(items):
        docs = docs.filter(~_holds(found, WIDTH, THRESHOLD, RADIUS)("text"))
    return docs


def _holds(items: list[tuple[int, str]], width: int, threshold: float, radius: int):
    key = _key(items, width, threshold, radius)

    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        finder = _finder(key, items, width, threshold, radius)
        return pd.Series([bool(finder.find(t)) for t in texts], dtype=bool)

    return holds
