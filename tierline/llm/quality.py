"""Quality by nearest neighbours: labelled documents as latent-semantic vectors, exact cosine products with all of them, similarity-weighted votes.

Terms are hashed: character triples of the lower-cased text, the same of its shape (kinds of characters instead of letters), and how often a
word follows itself or comes back. Term frequencies are damped by a logarithm and weighted by the inverse document frequency over all
documents. The latent space is spanned by the leading right singular vectors of the labelled sample.

Plan: one pass counts in how many documents a term occurs (DIMS sums a task). The labelled sample, at most SAMPLE rows in the order of a hash of the id,
becomes term vectors in tasks; the driver gathers them (SAMPLE rows of DIMS numbers at most) and finds the latent space. Vectors
and labels of the sample (SAMPLE x RANK numbers, the proven bound of what is broadcast) go to all tasks. One more pass reads every
text whole and multiplies blocks of documents with all labelled vectors.

The score is the mean label of the NEAREST neighbours, weighted by similarity to the power SHARPNESS; without any similar neighbour, the mean label.
Null and empty texts have no terms, so they score the mean label of labelled texts without terms, or the mean of all. Without labels the score is 0.5.
Rows with null labels teach nothing. Equal similarities: the neighbour that comes first in the order of the sample. Repeated rows
are scored alike. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import staged

SAMPLE, DIMS, RANK, NEAREST, SHARPNESS, ROWS, BLOCK = 4_000, 2_048, 48, 25, 8, 256, 1 << 18
#: Shapes get this many times the weight of letters, and repetition that many.
SHAPES, REPEATS = 2.0, 3.0
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LETTERS, _SHAPE, _WORDS = 1_000, 2_000, 48


def _kinds() -> np.ndarray:
    """Kinds of the first 0x250 code points: letters small and great, digits; signs and blanks stand for themselves."""
    out = np.arange(0x250)
    for c in range(0x250):
        out[c] = 97 if chr(c).islower() else 65 if chr(c).isalpha() else 48 if chr(c).isdigit() else c
    return out


_KINDS = _kinds().astype(np.uint64)


def _hash(codes: np.ndarray, dims: int) -> np.ndarray:
    return ((codes ^ codes >> np.uint64(31)) * _MIX >> np.uint64(40)).astype(np.int64) % dims


def _triples(points: np.ndarray) -> np.ndarray:
    return points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]


def terms(text: str | None) -> np.ndarray:
    """Damped term frequencies of a whole text, read in blocks."""
    text, total = text or "", np.zeros(DIMS, np.float32)
    letters, shapes = np.zeros(_LETTERS), np.zeros(_SHAPE - _LETTERS)
    for at in range(0, len(text), BLOCK):
        part = text[max(0, at - 2) : at + BLOCK]
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        kinds = np.where(points < 0x250, _KINDS[np.minimum(points, 0x24F).astype(np.int64)], np.uint64(97))
        small = np.where((points >= 65) & (points <= 90), points + np.uint64(32), points)
        letters += np.bincount(_hash(_triples(small), _LETTERS), minlength=_LETTERS)
        shapes += np.bincount(_hash(_triples(kinds), _SHAPE - _LETTERS), minlength=_SHAPE - _LETTERS)
    total[:_LETTERS], total[_LETTERS:_SHAPE] = _unit(np.log1p(letters)), SHAPES * _unit(np.log1p(shapes))
    words = text.lower().split()
    if words:
        again = sum(a == b for a, b in zip(words, words[1:])) / len(words)
        new = len(set(words)) / len(words) * max(1.0, np.log10(len(words)))
        length = len(text) / len(words)
        lines = np.log2(1 + len(words) / (1 + text.count("\n")))
        places = [min(15, int(16 * again)), 16 + min(15, int(4 * new)), 32 + min(7, int(length / 2)), 40 + min(7, int(lines))]
        total[[_SHAPE + p for p in places]] = REPEATS / 4
    return total


def _unit(x: np.ndarray) -> np.ndarray:
    return x / max(np.linalg.norm(x), 1e-9)


def document_frequencies(docs: DataFrame, text_column: str = "text") -> tuple[int, np.ndarray]:
    """How many documents there are, and how many have each term."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(DIMS, np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                total += terms(text) > 0
                n += 1
        yield pd.DataFrame({"term": np.arange(-1, DIMS), "n": np.concatenate([[n], total])})

    read = docs.select(F.coalesce(text_column, F.lit("")).alias("text"))
    sums = read.mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n")).collect()
    found = np.zeros(DIMS + 1, np.int64)
    for term, n in sums:
        found[term + 1] = n
    return int(found[0]), found[1:]


@dataclass
class Model:
    weight: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    mean: float
    blank: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Scores of a block of texts, by cosines with all labelled vectors."""
        rows = np.stack([terms(t) for t in texts]) * self.weight
        latent = rows @ self.space
        size = np.linalg.norm(latent, axis=1, keepdims=True)
        if not len(self.vectors):
            return np.full(len(texts), self.mean)
        cosine = (latent / np.maximum(size, 1e-9)) @ self.vectors.T
        k = min(NEAREST, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < cosine.shape[1] else np.broadcast_to(np.arange(k), cosine.shape)
        votes = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
        sums = votes.sum(axis=1)
        scores = np.where(sums > 1e-12, (votes * self.labels[near]).sum(axis=1) / np.maximum(sums, 1e-12), self.mean)
        return np.clip(np.where(size[:, 0] > 1e-9, scores, self.blank), 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality") -> Model:
    """Learns from the rows of (doc_id, label) for which `learn` holds."""
    documents, frequency = document_frequencies(docs)
    weight = np.log((1 + documents) / (1 + frequency)).astype(np.float32) + np.float32(0.1)
    keys = labels.filter(F.col(label).isin(0, 1) & learn).select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
    keys = staged(keys.withColumn("_order", F.xxhash64("_id")).orderBy("_order", "_id", "y").limit(SAMPLE), "chosen")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [terms(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_order"), batch.column("y"), pa.array(x, pa.binary())], ["o", "y", "x"])

    sample = docs.select("doc_id", "text").join(keys, F.col("doc_id") == F.col("_id")).select("_order", "y", "text")
    rows = sample.mapInArrow(vectors, "o long, y int, x binary").dropDuplicates().orderBy("o", "y", "x").collect()
    if not rows:
        return Model(weight, np.zeros((DIMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5, 0.5)
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]) * weight
    y = np.array([r["y"] for r in rows], np.float64)
    space = latent_space(x)
    latent = x @ space
    size = np.linalg.norm(latent, axis=1)
    there = size > 1e-9
    blank = float(y[~there].mean()) if (~there).any() else float(y.mean())
    return Model(weight, space, latent[there] / size[there, None], y[there], float(y.mean()), blank)


def latent_space(x: np.ndarray, rounds: int = 6) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    basis = np.linalg.qr(x.T @ np.random.default_rng(3).normal(size=(len(x), RANK + 16)).astype(np.float32))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(x.T @ np.linalg.qr(x @ basis)[0])[0]
    turned = np.linalg.svd(x @ basis, full_matrices=False)[2]
    return np.ascontiguousarray((basis @ turned.T)[:, :RANK]).astype(np.float32)


def score(model: Model, text: str | Column = "text") -> Column:
    """The score of a text column."""

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            blocks = [model.score(list(texts[at : at + ROWS])) for at in range(0, len(texts), ROWS)]
            yield pd.Series(np.concatenate(blocks) if blocks else [], dtype="float64")

    return of(F.coalesce(text, F.lit("")))
