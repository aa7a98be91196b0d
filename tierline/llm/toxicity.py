"""Toxicity of texts whose words may be disguised: restore the words, then score what they say.

Restoring is a noisy-channel decoder. A word with signs that may stand for letters, or with letters repeated, is a lattice of readings: each sign
as itself or as a letter, each repetition, however long, shortened to two, one or left. A blank or mark between runs of at most SHORT signs is
in the lattice as well, as a word boundary or as nothing: where two such neighbours are single signs, or are read as one word, the stretch of all
such neighbours is decoded as a whole, next to its words as they stand. The path of least cost under a character trigram model and the channel's costs is
found by the Viterbi algorithm, in time linear in the length. A word without such signs has one reading and stays as it is. Runs with marks inside
are parted there first, so words joined by commas or slashes are decoded one by one.

The trigram model counts all texts of the table (one pass, reduced in the tasks to at most 32,768 counts each). The score is a logistic
regression over features of the restored words: each word and its beginnings of 4 to 6 letters, one feature each per text. Features and
weights are learned from labelled rows only, at most SAMPLE of each label, taken in the order of a hash of the id; the FEATURES that
part the labels most are kept. One more feature says whether one was found that a share COMMON of label 1 has, and surely STRONG times that of label 0: texts
with a single telling word would else be scored by the company that word usually keeps. The labels' share among all labelled rows that may be learned from sets the intercept.

Bounds: the driver holds the trigram counts, FEATURES names, and the sample's feature numbers. A task remembers REMEMBERED words.

Null and empty texts are scored by the intercept alone. Rows with null labels or ids teach nothing; without labels of both kinds all scores
are 0. Documents that are labelled more than once teach once per label row. Repeated rows are scored alike. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import staged

SAMPLE, FEATURES, LEAST, COMMON, STRONG, REMEMBERED, BLOCK, SHORT = 4_000, 256, 4, 0.02, 5, 300_000, 1 << 20, 4
#: Letters that a sign may stand for.
LEET = {
    "0": "ou", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h", "€": "e", "£": "l",
}
#: Costs of the channel, in nats: a sign read as a letter, one kept as it is, a repetition shortened, one left, a blank that is no boundary.
AS_LETTER, AS_SIGN, SHORTENED, LEFT, JOINED = 0.5, 9.0, 0.5, 6.0, 3.0
_REPEATED = re.compile(r"([^\W\d_])\1\1")
_SIGN = re.compile(r"[^\W\d_][0-9@$!|+(*#€£]+[^\W\d_]|^[0-9@$!|+(*#€£]{1,2}[^\W\d_]{2,}|[^\W\d_][0-9@$!|+(€£]+[^\W\d_]?$")
_LETTERS = re.compile(r"[^\W\d_]+")
_PUNCTUATION = ".,;:?\"'`()[]{}<>«»„“”‘’…~^&%=\\/-_"
#: Marks that part a run; those that may stand for letters do not.
_INNER = re.compile(r"[.,;:?\"`\[\]{}<>«»„“”…~^&%=\\/_\-]+")


def symbols(text: str) -> np.ndarray:
    """Letters a to z as 1 to 26, other letters as 27, all else as 0."""
    return _SYMBOL[np.frombuffer(text.lower().encode("latin-1", "replace"), np.uint8)]


_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SYMBOL[0xC0:] = 27
_SYMBOL[[0xD7, 0xF7]] = 0


def trigram_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(code, n) over all texts: the counts that the character model is made of."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << 15, np.int64)
        for batch in batches:
            for text in batch["text"]:
                padded = f"  {text} "
                for at in range(0, len(padded) - 2, BLOCK):
                    s = symbols(padded[at : at + BLOCK + 2])
                    total += np.bincount(s[:-2] << 10 | s[1:-1] << 5 | s[2:], minlength=1 << 15)
        codes = np.flatnonzero(total)
        yield pd.DataFrame({"code": codes, "n": total[codes]})

    read = docs.select(F.coalesce(text_column, F.lit("")).alias("text"))
    return read.mapInPandas(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


class ShortRuns(dict):
    """Of each run met: None, or for one of at most SHORT signs that may be part of a word the run without punctuation and what tells of a gap after
    and before it. For two plain runs, of which neither is a single sign, that is the two letters next to the gap."""

    def __missing__(self, run: str) -> tuple[str, str, str] | None:
        word, found = bare(run) if len(run) <= 2 * SHORT else "", None
        if 0 < len(word) <= SHORT and all(c in LEET or c.isalpha() for c in word):
            plain = len(word) > 1 and word.isalpha() and not _REPEATED.search(word)
            found = (word, *((word[-2:] + " ", word[:2]) if plain else (word + "  ", "  " + word)))
        self[run] = found
        return found


class Decoder:
    """Restores words by the Viterbi algorithm. `cost[a, b, c]` is the model's cost of symbol c after a and b."""

    def __init__(self, counts: dict[int, int]):
        n = np.full((32, 32, 32), 0.05)
        for code, k in counts.items():
            n[code >> 10, code >> 5 & 31, code & 31] += k
        two = n.sum(axis=2, keepdims=True)
        back = n.sum(axis=0, keepdims=True)
        back = back / back.sum(axis=2, keepdims=True)
        self.cost = -np.log((n + 20 * back) / (two + 20))
        #: Whether a gap is none, by the signs that tell.
        self.gaps: dict[str, bool] = {}
        self.short = ShortRuns()
        #: Words of stretches of two or three runs.
        self.stretches: dict[tuple[str, ...], list[str]] = {}

    def restore(self, word: str) -> str:
        """The cheapest reading of a word. Equal costs: the reading met first."""
        lattice = self._lattice(word)
        if all(len(x) == 1 for x in lattice):
            return "".join(x[0][0] for x in lattice)
        cost = self.cost
        # Of each state the cost and the readings so far, as a chain that paths share.
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for choices in lattice:
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (so_far, before) in paths.items():
                for reading, extra in choices:
                    x, y, total = a, b, so_far + extra
                    for s in symbols(reading).tolist():
                        total += cost[x, y, s]
                        x, y = y, s
                    if (x, y) not in after or total < after[x, y][0]:
                        after[x, y] = (total, (before, reading))
            paths = after
        chain, out = min(((total + cost[a, b, 0], chain) for (a, b), (total, chain) in paths.items()), key=lambda x: x[0])[1], []
        while chain is not None:
            chain, reading = chain
            out.append(reading)
        return "".join(reversed(out))

    @staticmethod
    def _lattice(word: str) -> list[list[tuple[str, float]]]:
        out, at = [], 0
        while at < len(word):
            end = at + 1
            while end < len(word) and word[end] == word[at]:
                end += 1
            n, sign = end - at, word[at]
            if sign == " ":
                out.append([(" ", 0.0), ("", JOINED)])
                at = end
                continue
            kept = AS_SIGN if sign in LEET else 0.0
            readings = [(sign, kept), *((x, AS_LETTER) for x in LEET.get(sign, ""))]
            choices = []
            for x, c in readings:
                if n <= 2:
                    choices.append((x * n, c * n))
                    if n == 2 and sign in LEET:
                        choices.append((x, c + SHORTENED))
                else:
                    choices += [(x, c + SHORTENED), (x * 2, c + SHORTENED), (x * n, c * n + LEFT)]
            out.append(choices)
            at = end
        return out

    def words(self, raw: str) -> list[str]:
        """The words that one run without blanks stands for: without outer punctuation, parted at inner marks, and restored where they look disguised."""
        word = bare(raw)
        if word.isalpha() and not _REPEATED.search(word):
            return [word]
        parts = [p for p in _INNER.split(word) if p]
        if len(parts) > 3 and all(len(p) == 1 for p in parts):
            return self.spelled(parts)
        out = [w for p in parts for w in self._plain(p)]
        return out + self.spelled(parts) if len(parts) > 1 else out

    def _plain(self, word: str) -> list[str]:
        if _SIGN.search(word) or _REPEATED.search(word):
            word = self.restore(word)
        return _LETTERS.findall(word)

    def joins(self, a: str, b: str) -> bool:
        """Whether the gap between two short runs may be none: single signs, or runs that the lattice reads as one word."""
        if len(a) == len(b) == 1:
            return True
        if (a + b).isalpha() and not _REPEATED.search(a) and not _REPEATED.search(b):  # two readings, which differ around the gap only
            p, q, r, s = symbols((" " + a)[-2:] + (b + " ")[:2]).tolist()
            cost = self.cost
            return bool(JOINED + cost[p, q, r] + cost[q, r, s] < cost[p, q, 0] + cost[q, 0, r] + cost[0, r, s])
        return " " not in self.restore(f"{a} {b}")

    def spelled(self, runs: list[str]) -> list[str]:
        """The words of all stretches of runs whose gaps may be none."""
        out, chain, gaps = [], [], self.gaps
        short = list(map(self.short.__getitem__, runs))
        for a, b in zip(short, [*short[1:], None]):
            if a and b:
                gap = a[1] + b[2]
                joined = gaps.get(gap)
                if joined is None:
                    joined = gaps[gap] = self.joins(a[0], b[0])
                if joined:
                    chain = chain or [a[0]]
                    chain.append(b[0])
                    continue
            if chain:
                out += self._stretch(tuple(chain))
                chain = []
        return out

    def _stretch(self, bared: tuple[str, ...]) -> list[str]:
        """A stretch as a whole and, where it has longer runs as well, its stretches of single signs, which are spelled out for certain."""
        if len(bared) > 3:
            return self._decoded(bared)
        if len(self.stretches) > REMEMBERED:
            self.stretches.clear()
        if bared not in self.stretches:
            self.stretches[bared] = self._decoded(bared)
        return self.stretches[bared]

    def _decoded(self, bared: tuple[str, ...]) -> list[str]:
        texts = [" ".join(bared)]
        if any(len(x) > 1 for x in bared):
            texts += [" ".join(g) for one, g in groupby(bared, lambda x: len(x) == 1) if one]
        return [w for t in texts if _LETTERS.search(t) and " " in t for w in _LETTERS.findall(self.restore(t))]


def bare(run: str) -> str:
    """A run without the punctuation around it."""
    return run.strip(_PUNCTUATION).rstrip("!" + _PUNCTUATION) or run.strip(_PUNCTUATION)


def features_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in (4, 5, 6) if len(word) > n)]


class Reader:
    """What `look` makes of each restored word of a text, remembered by the run it came from."""

    def __init__(self, decoder: Decoder, look: Callable[[str], tuple]):
        self.decoder, self.look, self.known = decoder, look, {}

    def __call__(self, text: str | None) -> set:
        runs = (text or "").lower().split()
        out, known = set(), self.known
        for memory in (known, self.decoder.short, self.decoder.gaps):
            if len(memory) > REMEMBERED:
                memory.clear()
        for run in set(runs):
            got = known.get(run)
            if got is None:
                got = known[run] = tuple(f for w in self.decoder.words(run) for f in self.look(w))
            if got:
                out.update(got)
        for w in self.decoder.spelled(runs):
            out.update(self.look(w))
        return out


@dataclass
class Model:
    decoder: Decoder
    places: dict[str, int]
    strong: frozenset[int]
    weights: np.ndarray
    intercept: float

    def row(self, found: set[int]) -> list[int]:
        """Numbers of the features of a text; the last one stands for any strong one."""
        return sorted(found) + [len(self.places)] * (not self.strong.isdisjoint(found))

    def score(self, found: set[int]) -> float:
        z = self.intercept + (float(self.weights[self.row(found)].sum()) if found else 0.0)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))

    def looker(self) -> Callable[[str], tuple]:
        return lambda word: tuple(self.places[f] for f in features_of(word) if f in self.places)


def _sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column) -> tuple[DataFrame, dict[int, int]]:
    """At most SAMPLE labelled texts of each label, in the order of a hash of the id, and how many rows there are of each."""
    keys = labels.filter(F.col(label).isin(0, 1) & learn).select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
    counts = {r[0]: r[1] for r in keys.join(docs.select("doc_id"), F.col("_id") == F.col("doc_id")).groupBy("y").count().collect()}
    keys = keys.withColumn("_order", F.xxhash64("_id"))
    chosen = [keys.filter(F.col("y") == y).orderBy("_order", "_id").limit(SAMPLE) for y in (0, 1)]
    chosen = staged(chosen[0].unionByName(chosen[1]), "chosen")
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("_id")).select("text", "y")
    return staged(texts, "sample"), counts


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic") -> Model:
    """Learns from the rows of (doc_id, label) for which `learn` holds."""
    decoder = Decoder({r[0]: r[1] for r in trigram_counts(docs).collect()})
    sample, counts = _sample(docs, labels, label, learn)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, n = Reader(decoder, lambda w: tuple(features_of(w))), (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                n[y].update(read(text))
        names = list(n[0].keys() | n[1].keys())
        columns = [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in n)]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

    sizes = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Model(decoder, {}, frozenset(), np.zeros(1), -50.0)
    sums = sample.mapInArrow(count, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    p, q = (F.col("t") + 0.5) / (sizes[1] + 1), (F.col("c") + 0.5) / (sizes[0] + 1)
    apart = F.abs(p - q) / F.sqrt(p * (1 - p) / sizes[1] + q * (1 - q) / sizes[0])
    best = sums.filter(F.col("c") + F.col("t") >= LEAST).orderBy(apart.desc(), "feature").limit(FEATURES)
    surely, at_most = (F.col("t") - 2 * F.sqrt("t")) / sizes[1], (F.col("c") + 1) / sizes[0]
    names = [(r[0], r[1]) for r in best.select("feature", (surely >= STRONG * at_most) & (p >= COMMON)).collect()]
    strong = frozenset(k for k, (_, is_strong) in enumerate(names) if is_strong)
    model = Model(decoder, {f: k for k, (f, _) in enumerate(names)}, strong, np.zeros(len(names) + 1), 0.0)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = Reader(decoder, model.looker())
        for batch in batches:
            yield pd.DataFrame({"y": batch["y"], "found": [model.row(read(t)) for t in batch["text"]]})

    rows = sorted(sample.mapInPandas(gather, "y int, found array<int>").collect())  # at most 2 SAMPLE rows
    x, y = np.zeros((len(rows), len(names) + 1), np.float32), np.array([r[0] for r in rows], np.float64)
    for k, r in enumerate(rows):
        x[k, r[1]] = 1
    model.weights, bias = logistic(x, y)
    model.intercept = bias + math.log(counts[1] / counts[0]) - math.log(sizes[1] / sizes[0])
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression, by Newton steps. The last column is hardly held back."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1).astype(np.float64)
    w, penalty = np.zeros(x.shape[1]), np.append(np.full(x.shape[1] - 2, ridge), [ridge / 100, 1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def score(model: Model, text: str | Column = "text") -> Column:
    """The score of a text column."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        read = Reader(model.decoder, model.looker())
        for texts in batches:
            yield pd.Series([model.score(read(t)) for t in texts], dtype="float64")

    return of(text)
