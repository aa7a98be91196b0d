"""Language identification in two steps: the family first, then one-versus-one linear support vector machines within the family.

Features are the shares of hashed character pairs and triples in the lower-cased letters of a text, so a linear machine's value is
the mean weight of what the text holds. Families are found from the learned rows: languages whose mean features are closest are merged until
about the square root of their number is left. One machine per pair of families and one per pair of languages within a family vote; ties go to
the greater sum of margins, then to the first name.

Learning uses at most SAMPLE labelled texts of each language, and LEARNED of all together, in the order of a hash of the id; their features are
computed in tasks and gathered (at most LEARNED rows of DIMS numbers), machines are fitted by dual coordinate descent. Every language is learned
and can be predicted; with more than LEARNED / SAMPLE of them each gets an equal, smaller share of the rows. Every text is then read whole, in blocks, in one pass without a shuffle.

Null text, and text without letters, is `und` with score 1. Rows with null text or language teach nothing; a row with a null id is not held out.
With one learned language all texts get it; with none, `und` with score 0. Repeated rows are treated alike. Other columns are not read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import staged

#: Learned rows of a language, and of all together: with many languages each one gets fewer, but every language is learned.
SAMPLE, LEARNED, DIMS, BLOCK = 1_000, 64_000, 1 << 12, 1 << 18
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _blocks(text: str) -> Iterator[np.ndarray]:
    """Hashed features of a text, block by block: codes of character pairs and triples. Runs of what is no letter count as one blank."""
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(text[max(0, at - 2) : at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        letter = _is_letter(points)
        points = np.where(letter, points, np.uint64(32))
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        points = points[keep]
        if len(points) < 2:
            continue
        pairs = points[:-1] << np.uint64(21) | points[1:]
        triples = points[:-2] << np.uint64(42) | pairs[1:]
        yield np.concatenate([_hash(pairs), _hash(triples)])


def _hash(codes: np.ndarray) -> np.ndarray:
    codes = (codes ^ codes >> np.uint64(31)) * _MIX
    return (codes >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int64)


_LETTERS = np.array([chr(c).isalpha() for c in range(0x3000)])


def _is_letter(points: np.ndarray) -> np.ndarray:
    """From U+3000 on nearly all signs of running text are letters or ideographs; they count as such."""
    return np.where(points < 0x3000, _LETTERS[np.minimum(points, 0x2FFF).astype(np.int64)], (points > 0x3004) & ((points < 0xE000) | (points > 0xFFFF)) & ~((points >= 0x1F000) & (points < 0x20000)))


def shares(text: str) -> np.ndarray:
    """Features of a text: shares of its pairs and triples, with length 1."""
    total = np.zeros(DIMS)
    for codes in _blocks(text):
        total += np.bincount(codes, minlength=DIMS)
    return total / max(np.linalg.norm(total), 1e-12)


def support_vector_machine(x: np.ndarray, y: np.ndarray, c: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss for y of 1 and -1, by dual coordinate descent; rows with y of 0 take no part."""
    norm = np.einsum("ij,ij->i", x, x) + 1 + 0.5 / c
    w, bias, alpha, rng, among = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(len(x)), np.random.default_rng(5), np.flatnonzero(y)
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(among):
            gradient = y[i] * (float(x[i] @ w) + bias) - 1 + alpha[i] * 0.5 / c
            new = max(0.0, alpha[i] - gradient / norm[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                worst = max(worst, abs(step))
                w += np.float32(step) * x[i]
                bias += step
                alpha[i] = new
        if worst < 1e-3:
            break
    return w, bias


def families_of(means: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages in families: the closest are merged, by the mean cosine between their members, until about the square root of their number is left."""
    groups = [[name] for name in sorted(means)]
    near = lambda a, b: float(np.mean([means[p] @ means[q] / (np.linalg.norm(means[p]) * np.linalg.norm(means[q])) for p in a for q in b]))
    while len(groups) > max(1, round(math.sqrt(len(means)))):
        a, b = max(itertools.combinations(range(len(groups)), 2), key=lambda ab: near(groups[ab[0]], groups[ab[1]]))
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


@dataclass
class Model:
    """Machines as columns of `weights`; `families` are lists of languages."""

    families: list[list[str]]
    among: list[tuple[int, int, int]]
    within: list[list[tuple[int, int, int]]]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float]:
        values, total = np.zeros(self.weights.shape[1]), np.zeros(DIMS)
        seen = False
        for codes in _blocks(text or ""):
            seen = True
            total += np.bincount(codes, minlength=DIMS)
        if not seen:
            if not any(c.isalpha() for c in text or ""):
                return UNKNOWN, 1.0
        if not self.families:
            return UNKNOWN, 0.0
        values = total @ self.weights / max(np.linalg.norm(total), 1e-12) + self.bias
        family, sure = _vote(self.among, len(self.families), values)
        language, surer = _vote(self.within[family], len(self.families[family]), values)
        return self.families[family][language], sure * surer


def _vote(machines: list[tuple[int, int, int]], n: int, values: np.ndarray) -> tuple[int, float]:
    """Winner of one-versus-one votes, and how sure its least sure machine is."""
    votes, margins, least = [0] * n, [0.0] * n, [1.0] * n
    for a, b, k in machines:
        won, lost = (a, b) if values[k] > 0 else (b, a)
        votes[won] += 1
        margins[won] += abs(values[k])
        margins[lost] -= abs(values[k])
        least[won] = min(least[won], 1 / (1 + math.exp(-min(50.0, 4 * abs(values[k])))))
    best = max(range(n), key=lambda i: (votes[i], margins[i], -i))
    return best, least[best]


def fit(docs: DataFrame, learn: Column) -> Model:
    """Learns from text and language of the documents for which `learn` holds."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & learn)
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    names = sorted(counts)
    if not names:
        return Model([], [], [], np.zeros((DIMS, 0)), np.zeros(0))
    order = known.select("lang", F.xxhash64("doc_id", "text").alias("_order"), "text")
    # The order is a hash, so the first rows of a language lie below a bound that its count tells, with room for four times as many: only those
    # few are ranked, however many tasks read the table. The bounds are one row a language, which the driver holds already.
    share = max(1, min(SAMPLE, LEARNED // len(names)))
    bounds = [(n, min((1 << 63) - 1, (1 << 64) * 4 * share // count - (1 << 63))) for n, count in counts.items()]
    bounds = docs.sparkSession.createDataFrame(bounds, "_lang string, _bound long")
    first = order.select("lang", "_order").join(F.broadcast(bounds), F.col("lang") == F.col("_lang")).filter(F.col("_order") <= F.col("_bound"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_order"))
    chosen = first.select("lang", "_order").withColumn("_rank", rank).filter(F.col("_rank") <= share)
    chosen = staged(chosen.select("_order", F.col("lang").alias("_lang")), "chosen").distinct()
    texts = order.join(chosen, (order["_order"] == chosen["_order"]) & (F.col("lang") == F.col("_lang"))).select(order["_order"], "lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [shares(t).astype(np.float32).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_order"), batch.column("lang"), pa.array(x, pa.binary())], ["o", "lang", "x"])

    rows = texts.mapInArrow(features, "o long, lang string, x binary").dropDuplicates(["o", "lang"]).orderBy("lang", "o").collect()
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows])
    of = np.array([names.index(r["lang"]) for r in rows])
    del rows
    groups = families_of({n: x[of == k].mean(axis=0) for k, n in enumerate(names)})
    family = np.array([next(i for i, g in enumerate(groups) if n in g) for n in names])
    machines, weights, bias = [], [], []

    def machine(a: np.ndarray, b: np.ndarray) -> int:
        w, c = support_vector_machine(x, a.astype(float) - b)
        weights.append(w)
        bias.append(c)
        return len(weights) - 1

    among = [(a, b, machine(family[of] == a, family[of] == b)) for a, b in itertools.combinations(range(len(groups)), 2)]
    for group in groups:
        index = [names.index(n) for n in group]
        machines.append([(a, b, machine(of == index[a], of == index[b])) for a, b in itertools.combinations(range(len(group)), 2)])
    columns = np.stack(weights, axis=1) if weights else np.zeros((DIMS, 0))
    return Model(groups, among, machines, columns, np.array(bias))


def prediction(model: Model, text: str | Column = "text") -> Column:
    """A struct of language and score for a text column."""

    @F.pandas_udf("language string, score double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [model.predict(t) for t in texts]
            yield pd.DataFrame({"language": [x[0] for x in found], "score": [x[1] for x in found]})

    return of(text)
