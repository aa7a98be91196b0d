"""Periodic runs of words: stretches that repeat themselves, found online by dyadic catchers of squares.

A run is a stretch of consecutive words with smallest period q, at least `exponent` periods and `shortest` words long, that no neighbouring word
extends at that period.

Method: words are appended; whenever a block of s words that starts at a multiple of s is complete (s = 1, 2, 4, ...), it becomes a catcher.
A catcher compares itself with the last s words of the text as long as their distance is 2s to 4s (and 1 for s = 1), so that each appended
word advances two comparisons of a level, by a hash of s words put together from two of s / 2. A match means s equal pairs of words at that
distance, and a repetition of q words holds an unbroken chain of such matches of neighbouring blocks. Chains are merged, extended to both
sides word by word, and reported as runs. A chain inside a known run whose period divides its own says nothing new and is dropped.

Cost: n log n comparisons of numbers for n words, done for a piece of PIECE words at a time; what is kept between pieces is the hashes of
complete blocks and the last s positions of each level, 40 bytes a word at most. Runs are verified on the words themselves.

Null and blank texts have no words and no runs. A document is one row: repeated rows and ids get their own results. Other columns are not read;
they may have any names. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose comparisons are advanced together.
PIECE = 1 << 18
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_SHIFT = np.uint64(29)


class _Level:
    """Catchers of one block size: hashes of complete blocks, and of the last `size` positions, with the chains that go on there."""

    def __init__(self, size: int):
        self.size, self.seen = size, 0
        #: Distances in blocks at which a catcher looks for itself: 2s + r and 3s + r for a remainder r below s, besides 1 for single words.
        self.far = (1, 2, 3) if size == 1 else (2, 3)
        self.blocks = np.zeros(0, np.uint64)
        self.tail = np.zeros(0, np.uint64)
        self.matched = {r: np.zeros(size, bool) for r in self.far}
        self.begun: dict[int, list[np.ndarray]] = {r: [] for r in self.far}
        self.ended: dict[int, list[np.ndarray]] = {r: [] for r in self.far}

    def advance(self, hashes: np.ndarray) -> np.ndarray:
        """Takes the hashes of `size` words at the next positions, compares each with its catchers, and returns the hashes of the next level."""
        size, at = self.size, self.seen
        self.seen += len(hashes)
        first = -at % size
        self.blocks = np.concatenate([self.blocks, hashes[first::size]])
        positions = np.arange(at, self.seen)
        for r in self.far:
            # The suffix of `size` words at position i looks at the block r blocks before its own.
            block = positions // size - r
            same = np.zeros(len(hashes), bool)
            known = int(np.searchsorted(block, 0))
            same[known:] = self.blocks[block[known:]] == hashes[known:]
            if same.any() or self.matched[r].any():
                line = np.concatenate([self.matched[r], same])
                now, before = line[size:], line[:-size]
                self.begun[r].append(np.flatnonzero(now & ~before) + at)
                self.ended[r].append(np.flatnonzero(before & ~now) + at - size)
                self.matched[r] = line[len(line) - size :]
        line = np.concatenate([self.tail, hashes])
        self.tail = line[max(0, len(line) - size) :]
        double = line[: len(line) - size] * _MIX[0] + line[size:] * _MIX[1] if len(line) > size else line[:0]
        return double ^ (double >> _SHIFT)

    def chains(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, words, distance) of every chain of at least `least` matches of neighbouring blocks."""
        out = []
        for r in self.far:
            if not self.begun[r]:
                continue
            going = np.flatnonzero(self.matched[r]) + self.seen - self.size
            begun, ended = np.concatenate(self.begun[r]), np.concatenate([*self.ended[r], going])
            # Of one remainder, beginnings and ends take turns.
            begun = begun[np.lexsort((begun, begun % self.size))]
            ended = ended[np.lexsort((ended, ended % self.size))]
            long = ended - begun >= (least - 1) * self.size
            begun, ended = begun[long], ended[long]
            start = (begun // self.size - r) * self.size
            out.append((start, ended - begun + self.size, begun - start))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


class RunCatcher:
    """Words as 64-bit numbers go in by `append`, in pieces of any length; `runs` tells the runs of all words so far."""

    def __init__(self, exponent: int = 4, shortest: int = 6):
        self.exponent, self.shortest = exponent, shortest
        self.pieces: list[np.ndarray] = []
        self.levels = [_Level(1)]
        self.count = 0

    def append(self, words: np.ndarray) -> None:
        for at in range(0, len(words), PIECE):
            hashes = words[at : at + PIECE].view(np.uint64)
            self.pieces.append(hashes)
            self.count += len(hashes)
            for k in range(self.count.bit_length() + 1):
                if not len(hashes) or self.exponent * 2 * (1 << k) > self.count and k:
                    break
                if k == len(self.levels):
                    hashes = self._late(k)
                    self.levels.append(_Level(1 << k))
                hashes = self.levels[k].advance(hashes)

    def _late(self, k: int) -> np.ndarray:
        """Hashes of all positions for a level that begins now: it was too high for the words there were before."""
        line = np.concatenate(self.pieces)
        for j in range(k):
            size = 1 << j
            line = line[: len(line) - size] * _MIX[0] + line[size:] * _MIX[1]
            line = line ^ (line >> _SHIFT)
        return line

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, smallest period) by start, then period."""
        words = np.concatenate(self.pieces) if self.pieces else np.zeros(0, np.uint64)
        found: list[tuple[int, int, int]] = []
        for level in self.levels:
            start, size, period = level.chains(max(1, 2 * self.exponent - 3) if level.size > 1 else 1)
            if not len(start):
                continue
            order = np.argsort(start, kind="stable")
            start, size, period = start[order], size[order], period[order]
            new = np.ones(len(start), bool)
            for first, length, known in found:
                low, high = np.searchsorted(start, (first, first + length))
                inside = (start[low:high] + size[low:high] + period[low:high] <= first + length) & (period[low:high] % known == 0)
                new[low:high] &= ~inside
            for first, length, distance in zip(start[new].tolist(), size[new].tolist(), period[new].tolist()):
                first, end = self._extended(words, first, first + length, distance)
                length = end + distance - first
                if length >= max(self.shortest, self.exponent * distance):
                    found.append((first, length, distance))
        least: dict[tuple[int, int], int] = {}
        for first, length, distance in found:
            least[first, length] = min(distance, least.get((first, length), distance))
        return sorted((first, length, distance) for (first, length), distance in least.items())

    @staticmethod
    def _extended(words: np.ndarray, first: int, end: int, distance: int) -> tuple[int, int]:
        """The longest stretch around [first, end) whose words equal those `distance` further on, in doubling steps."""
        step = 16
        while first > 0:
            low = max(0, first - step)
            other = np.flatnonzero(words[low:first] != words[low + distance : first + distance])
            first, step = (low + int(other[-1]) + 1, 0) if len(other) else (low, 2 * step)
            if not step:
                break
        step = 16
        while end + distance < len(words):
            high = min(len(words) - distance, end + step)
            other = np.flatnonzero(words[end:high] != words[end + distance : high + distance])
            end, step = (end + int(other[0]), 0) if len(other) else (high, 2 * step)
            if not step:
                break
        return first, end


def words_of(text: bytes | None) -> list[bytes]:
    """What blanks, tabs, line ends, vertical tabs and form feeds separate."""
    return text.split() if text else []


def runs_of(words: list, exponent: int = 4, shortest: int = 6) -> list[tuple[int, int, int]]:
    """All runs of a list of words, verified on the words; where two words have one hash, they are numbered and searched again."""
    if len(words) < max(shortest, exponent):
        return []
    found = _caught(np.fromiter(map(hash, words), np.int64, len(words)), exponent, shortest)
    if all(words[a : a + n - q] == words[a + q : a + n] for a, n, q in found):
        return found
    number: dict = {}
    return _caught(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)), exponent, shortest)


def _caught(numbers: np.ndarray, exponent: int, shortest: int) -> list[tuple[int, int, int]]:
    catcher = RunCatcher(exponent, shortest)
    catcher.append(numbers)
    return catcher.runs()


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that some run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(keep)]


def rewritten(words: list, key: int | None) -> list:
    """The words with a periodic end, for a tenth of all ids: from word a on they repeat p words. A null id is never rewritten."""
    h = zlib.crc32(str(key).encode()) if key is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", exponent: int = 4, shortest: int = 6, rewrite: bool = False) -> DataFrame:
    """(id, runs, collapsed): the runs of each text as an array of (start, length, period), and the text with one period left of each.

    With `rewrite`, texts first get the periodic ends of `rewritten`. One pass, nothing is shuffled.
    """
    schema = "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = rewritten(words_of(text), key) if rewrite else words_of(text)
                own = runs_of(words, exponent, shortest)
                runs.append([{"start": a, "length": n, "period": q} for a, n, q in own])
                texts.append(b" ".join(collapsed(words, own)))
            columns = [batch.column(0), pa.array(runs, arrow), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "runs", "collapsed"])

    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").cast("binary").alias("text"))
    return read.mapInArrow(find, schema)


def digest(found: DataFrame) -> DataFrame:
    """(id, n_runs, the run of greatest exponent, hashes of all runs and of the collapsed text) of what `periodic_runs` returns.

    Exponents are compared as exact fractions; ties go to the smallest start, then the smallest period.
    """
    # length / period as a whole part and a remainder over the period, so that a fraction is compared by cross multiplication.
    better = "x.length * best.period > best.length * x.period or (x.length * best.period = best.length * x.period and (x.start, x.period) < (best.start, best.period))"
    best = F.expr(f"aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), runs[0], (best, x) -> if({better}, x, best))")
    lines = "concat_ws('', transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\\n')))"
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.expr(f"sha2({lines}, 256)").alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
