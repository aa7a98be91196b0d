"""SimHash near-dedup: fingerprints of word shingles, exact Hamming pairs through a vantage-point tree, groups of linked documents.

Plan: one pass makes (id, fingerprint). Equal fingerprints become one row. A vantage-point tree, fitted on a bounded sample, deals the
distinct fingerprints to shards; a fingerprint so near to a boundary that a partner may lie beyond it also visits the shard there.
Each shard goes on splitting in memory by the same rule and reports links as a spanning forest, never as all pairs of a group.
Links become groups by stars (common.components).

Bounds: the tree is fitted on at most SAMPLE fingerprints; all fingerprints are indexed and the result is exact whatever the sample was.
A sample that fits badly only makes shards uneven. Null text and text without words have the fingerprint zero and are linked like any
other. A null id is no candidate for the smallest id of its group; such a row still gets its group. Repeated rows stay as they are.
An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import components, staged

#: Fingerprints that a shard is meant to hold, sampled fingerprints for each shard, and the most that are sampled.
SHARD, PER_SHARD, SAMPLE = 20_000, 64, 262_144
#: Size below which a shard is compared in one block, and links gathered before they are folded into a forest.
BLOCK, FOLD = 512, 2_000_000
#: Shingles whose bits are counted at once: bounds memory for a very long text.
COUNTED = 1 << 16


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of all word shingles of a text: a bit is set if it is set in over half of the shingles' XXH64 (seed 42)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, 42)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: 1 - width or None].tolist(), ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), COUNTED):
        hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts[at : at + COUNTED], ends[at : at + COUNTED])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint) of every row; the fingerprint as a signed long of the same bits."""

    return docs.select(F.col(id_column).alias("id"), fingerprint_of(text_column, width).alias("fingerprint"))


def fingerprint_of(text_column: str, width: int = 3) -> Column:
    """The fingerprint as a signed long of the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return of(text_column)


class VantageTree:
    """Inner nodes have a vantage point and a radius: a point within the radius has its home in the inner child, others in the outer one.

    By the triangle inequality two points within reach of each other differ by no more than that in their distance to the vantage point.
    A pair that a boundary parts meets inside: there the outer point visits. A visitor goes wherever a partner may be at home.
    Kept as arrays, so that batches descend level by level. Node 0 is the root; a leaf has no children and a shard number.
    """

    def __init__(self, sample: np.ndarray, leaves: int, reach: int):
        self.reach = reach
        self.vantage, self.radius, self.inner, self.shard = [], [], [], []
        rng, todo, self.leaves = np.random.default_rng(7), [(self._add(), sample, leaves)], 0
        while todo:
            node, points, share = todo.pop()
            split = _best_split(points, reach, rng) if share > 1 else None
            if split is None:
                self.shard[node], self.leaves = self.leaves, self.leaves + 1
                continue
            self.vantage[node], self.radius[node] = split
            inside = _distance(points, split[0]) <= split[1]
            self.inner[node] = self._add()
            self._add()
            part = min(share - 1, max(1, round(share * inside.mean())))
            todo += [(self.inner[node], points[inside], part), (self.inner[node] + 1, points[~inside], share - part)]
        self.vantage, self.radius = np.array(self.vantage, np.uint64), np.array(self.radius, np.int64)
        self.inner, self.shard = np.array(self.inner, np.int64), np.array(self.shard, np.int64)

    def _add(self) -> int:
        for column, value in ((self.vantage, 0), (self.radius, 0), (self.inner, -1), (self.shard, -1)):
            column.append(value)
        return len(self.shard) - 1

    def deal(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shard, position in points, whether at home) for each point, and again for each shard that it has to visit."""
        node, who, home = np.zeros(len(points), np.int64), np.arange(len(points)), np.ones(len(points), bool)
        done = []
        while len(node):
            at_leaf = self.inner[node] < 0
            done.append((self.shard[node[at_leaf]], who[at_leaf], home[at_leaf]))
            node, who, home = node[~at_leaf], who[~at_leaf], home[~at_leaf]
            distance, radius = _distance(points[who], self.vantage[node]), self.radius[node]
            own = distance <= radius
            inward, outward = distance <= radius + self.reach, ~own | (~home & (distance > radius - self.reach))
            node, who, home = (
                np.concatenate([self.inner[node][inward], self.inner[node][outward] + 1]),
                np.concatenate([who[inward], who[outward]]),
                np.concatenate([(home & own)[inward], (home & ~own)[outward]]),
            )
        return tuple(np.concatenate(x) for x in zip(*done))


def _distance(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ to).astype(np.int64)


def _best_split(points: np.ndarray, reach: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """Of a few vantage points and radii, the one with the fewest visits, among halves that are not too uneven."""
    if len(points) < 4:
        return None
    best = None
    for vantage in points[rng.choice(len(points), min(8, len(points)), replace=False)]:
        below = np.cumsum(np.bincount(_distance(points, vantage), minlength=65 + reach))
        for radius in range(64):
            share = below[radius] / len(points)
            if 0.25 <= share <= 0.75:
                cost = (below[radius + reach] - below[radius]) / len(points) + abs(share - 0.5) / 4
                if best is None or cost < best[0]:
                    best = (cost, vantage, radius)
    return best[1:] if best else None


def near_links(points: np.ndarray, homes: int, reach: int) -> np.ndarray:
    """For each point the smallest position of its group, by links between points within reach of which at least one is among the first `homes`."""
    labels, found, held, rng = np.arange(len(points)), [], 0, np.random.default_rng(11)
    todo = [(np.arange(homes), np.arange(homes, len(points)))]
    while todo:
        home, visiting = todo.pop()
        if not len(home):
            continue
        split = _best_split(points[home], reach, rng) if len(home) > BLOCK else None
        if split is not None:
            vantage, radius = split
            d, e = _distance(points[home], vantage), _distance(points[visiting], vantage)
            crossing = home[(d > radius) & (d <= radius + reach)]
            todo.append((home[d <= radius], np.concatenate([visiting[e <= radius + reach], crossing])))
            todo.append((home[d > radius], visiting[e > radius - reach]))
            continue
        others = np.concatenate([home, visiting])
        for at in range(0, len(home), BLOCK):
            rows = home[at : at + BLOCK]
            for to in range(0, len(others), 16 * BLOCK):
                columns = others[to : to + 16 * BLOCK]
                x, y = np.nonzero(np.bitwise_count(points[rows][:, None] ^ points[columns][None, :]) <= reach)
                found.append((rows[x], columns[y]))
                held += len(x)
                if held > FOLD:
                    labels, found, held = _fold(labels, found), [], 0
    return _fold(labels, found)


def _fold(labels: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest label over all that is linked, by repeated minimum and pointer jumping."""
    if not found:
        return labels
    a, b = (np.concatenate(x) for x in zip(*found))
    while True:
        x, y = labels[a], labels[b]
        if (x == y).all():
            return labels
        least = np.minimum(x, y)
        labels = labels.copy()
        np.minimum.at(labels, x, least)
        np.minimum.at(labels, y, least)
        while not np.array_equal(labels, labels[labels]):
            labels = labels[labels]


def links(distinct: DataFrame, reach: int, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join the same groups as all pairs within `reach` bits do."""
    leaves = max(1, -(-distinct.count() // shard))
    chosen = distinct.select("fingerprint").orderBy(F.xxhash64("fingerprint")).limit(min(SAMPLE, PER_SHARD * leaves))
    sample = np.array([r[0] for r in chosen.collect()] if leaves > 1 else [], np.int64).view(np.uint64)
    tree = VantageTree(sample, leaves, reach)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points = batch["fingerprint"].to_numpy()
            at, who, home = tree.deal(points.view(np.uint64))
            yield pd.DataFrame({"shard": at, "fingerprint": points[who], "home": home})

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["home", "fingerprint"], ascending=[False, True])
        points = rows["fingerprint"].to_numpy()
        labels = near_links(points.view(np.uint64), int(rows["home"].sum()), reach)
        linked = labels != np.arange(len(labels))
        return pd.DataFrame({"a": points[linked], "b": points[labels[linked]]})

    dealt = distinct.select("fingerprint").mapInPandas(deal, "shard long, fingerprint long, home boolean")
    return dealt.groupBy("shard").applyInPandas(compare, "a long, b long")


def _rooted(prints: DataFrame, reach: int) -> DataFrame:
    """(fingerprint, root, least) for each distinct fingerprint of (id, fingerprint): root is the same all over a group, least the smallest id."""
    distinct = staged(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct")
    roots = components(links(distinct, reach))
    joined = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left")
    return joined.select("fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least")


def near_groups(prints: DataFrame, reach: int = 2) -> DataFrame:
    """(id, fingerprint, component) for each row of (id, fingerprint): component is the smallest id reachable over links of up to `reach` bits."""
    prints = staged(prints, "fingerprints")
    known = _rooted(prints, reach)
    named = known.join(known.groupBy("root").agg(F.min("least").alias("component")), "root").select("fingerprint", "component")
    return prints.join(named, "fingerprint").select("id", "fingerprint", "component")


def hexadecimal(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, reach: int = 2, width: int = 3) -> DataFrame:
    """One row of each group, in its own columns: the one with the smallest id, of rows with that id the first as stored.

    Rows are told apart by their place in the table, not by their id: rows of one id with different texts belong to different groups, and each
    group keeps one row. A row with a null id stays only if its group has no other id. Texts are written once, with their fingerprints.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.monotonically_increasing_id().alias("uid"), fingerprint_of("text", width).alias("fingerprint"))
    rows = staged(rows, "rows")
    prints = rows.select("uid", F.col("row.doc_id").alias("id"), "fingerprint")
    roots = _rooted(prints, reach).select("fingerprint", "root")
    first = F.min(F.struct(F.col("id").isNull(), "id", "uid"))["uid"].alias("kept")
    kept = prints.join(roots, "fingerprint").groupBy("root").agg(first).select("kept")
    return rows.join(kept, rows["uid"] == kept["kept"], "left_semi").select("row.*")
