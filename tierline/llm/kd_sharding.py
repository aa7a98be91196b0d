"""Sharding by a k-d tree: a node splits at the weighted median of its widest metadata dimension until its leaves are shards of near-equal bytes.

Plan: texts are read once, for a narrow table (id, size, checksum, dimensions) in the shared folder. All nodes of a level split together. The
spread of each dimension per node picks the dimension; the weighted median is found by histograms of the weight, each round narrowing every
node's interval to one bin, in one pass with sums reduced in the tasks. The driver sees only bins, at most BINS for a whole level or 16 a node.

Ties: a value that is shared by many rows (one source, copies) is split further by a hash of the row and at last by its place in the
table, so that any group may be cut anywhere. Shards are then as equal as EVEN allows: each split is off by at most that share of its node,
or by one row if that is more.

Null text has no bytes, so size 1 and checksum 0. Null metadata sorts first. Repeated rows are rows of their own. An empty table gives no
rows. Dimension values beyond +-2^61 count as equal to that bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import numbered, staged

BINS, EVEN, LIMIT = 65_536, 1e-4, 1 << 61



def sizes(docs: DataFrame, dimensions: dict[str, Column], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The narrow table: id, size (UTF-8 bytes of the text and 1), text_crc32, one long per dimension, tie and uid."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    frame = docs.select(
        F.col(id_column).cast("long").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.coalesce(c.cast("long"), F.lit(-LIMIT)))).alias(f"dim_{n}") for n, c in dimensions.items()],
    )
    return frame.withColumns({"tie": F.shiftright(F.xxhash64("id", "text_crc32", "size"), 2), "uid": F.monotonically_increasing_id()})


def metadata(docs: DataFrame) -> dict[str, Column]:
    """Dimensions of `documents`; names become numbers by a checksum, so that rows of one name lie together."""
    return {
        "chars": F.col("n_chars"),
        "id": F.col("doc_id"),
        "lang": F.crc32(F.col("lang").cast("binary")),
        "source": F.crc32(F.col("source").cast("binary")),
    }


@dataclass
class Node:
    """Shards [first, first + share); once split, rows whose key (column `dim`, tie, uid) is at most `key` go to `inner`, others to `inner` + 1.

    While it is being split, the key's parts so far are fixed, and the next one lies in [low, high]; `need` is the weight still to be found there.
    """

    first: int
    share: int
    weight: int = 0
    dim: int = 0
    key: tuple[int, ...] = ()
    low: int = 0
    high: int = 0
    need: float = 0
    step: int = 0
    inner: int = -1
    done: bool = False


class Tree:
    def __init__(self, shards: int, columns: list[str]):
        self.nodes, self.columns = [Node(0, shards)], columns

    def arrays(self) -> dict[str, np.ndarray]:
        get = lambda f: np.array([f(n) for n in self.nodes], np.int64)
        keys = [[*n.key, *[LIMIT * 2] * (3 - len(n.key))] for n in self.nodes]
        return {
            "dim": get(lambda n: n.dim), "inner": get(lambda n: n.inner), "first": get(lambda n: n.first), "key": np.array(keys, np.int64),
            "fixed": get(lambda n: len(n.key)), "low": get(lambda n: n.low), "high": get(lambda n: n.high), "step": get(lambda n: n.step),
        }


def _keys(batch: pd.DataFrame, columns: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.stack([batch[c].to_numpy() for c in columns]), batch["tie"].to_numpy(), batch["uid"].to_numpy()


def _descend(dims: np.ndarray, tie: np.ndarray, uid: np.ndarray, tree: dict[str, np.ndarray]) -> np.ndarray:
    node, row = np.zeros(len(tie), np.int64), np.arange(len(tie))
    while (moving := tree["inner"][node] >= 0).any():
        value, (a, b, c) = dims[tree["dim"][node], row], tree["key"][node].T
        left = (value < a) | ((value == a) & ((tie < b) | ((tie == b) & (uid <= c))))
        node = np.where(moving, tree["inner"][node] + ~left, node)
    return node


def _spreads(narrow: DataFrame, tree: Tree) -> dict[int, tuple]:
    """Weight, and least and greatest value of each dimension, by node."""
    arrays, columns = tree.arrays(), tree.columns

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["node"] = _descend(*_keys(batch, columns), arrays)
            groups = batch.groupby("node")
            yield pd.concat([groups["size"].sum().rename("w"), *[groups[c].agg(f).rename(f"{f}_{c}") for c in columns for f in ("min", "max")]], axis=1).reset_index()

    fields = [f"{f}_{c}" for c in columns for f in ("min", "max")]
    partial = narrow.mapInPandas(reduce, ", ".join(f"{c} long" for c in ["node", "w", *fields]))
    rows = partial.groupBy("node").agg(F.sum("w"), *[getattr(F, x[:3])(x) for x in fields]).collect()
    return {r[0]: (r[1], list(zip(r[2::2], r[3::2]))) for r in rows}


def _histograms(narrow: DataFrame, tree: Tree) -> dict[int, list[tuple[int, int]]]:
    """(bin, weight) of the nodes that are being split, over the rows that agree with what is fixed of the key."""
    arrays, columns = tree.arrays(), tree.columns

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            dims, tie, uid = _keys(batch, columns)
            node = _descend(dims, tie, uid, arrays)
            fixed, key = arrays["fixed"][node], arrays["key"][node]
            value = dims[arrays["dim"][node], np.arange(len(node))]
            agree = ((fixed < 1) | (value == key[:, 0])) & ((fixed < 2) | (tie == key[:, 1])) & (arrays["step"][node] > 0)
            part = np.choose(fixed.clip(0, 2), [value, tie, uid])
            agree &= (part >= arrays["low"][node]) & (part <= arrays["high"][node])
            bins = (part - arrays["low"][node]) // np.maximum(arrays["step"][node], 1)
            kept = pd.DataFrame({"node": node[agree], "bin": bins[agree], "w": batch["size"].to_numpy()[agree]})
            yield kept.groupby(["node", "bin"], as_index=False)["w"].sum()

    out: dict[int, list[tuple[int, int]]] = {}
    for r in narrow.mapInPandas(reduce, "node long, bin long, w long").groupBy("node", "bin").agg(F.sum("w")).orderBy("node", "bin").collect():
        out.setdefault(r[0], []).append((r[1], r[2]))
    return out


def _narrow_down(node: Node, bins: list[tuple[int, int]]) -> None:
    """Takes the bin in which the wanted weight is reached; the split is done once that bin weighs next to nothing or holds one row."""
    below = 0
    for k, weight in bins:
        if below + weight >= node.need:
            break
        below += weight
    node.need -= below
    start = node.low + k * node.step
    node.low, node.high = start, min(node.high, start + node.step - 1)
    if weight <= EVEN * node.weight or len(node.key) == 2 and node.low == node.high:
        node.key, node.done = (*node.key, node.high if 2 * node.need >= weight else node.low - 1), True
    elif node.low == node.high:
        node.key = (*node.key, node.low)
        node.low, node.high = (-LIMIT, LIMIT) if len(node.key) == 1 else (0, 2 * LIMIT)


def shard_by_tree(narrow: DataFrame, shards: int) -> DataFrame:
    """Adds `shard` (0 to shards - 1, of near-equal size) and `slot` (gapless from 0 within a shard) to the narrow table."""
    narrow = staged(narrow, "narrow")
    columns = [c for c in narrow.columns if c.startswith("dim_")]
    tree, level, whole = Tree(shards, columns), [0], None
    while level := [k for k in level if tree.nodes[k].share > 1]:
        spreads = _spreads(narrow, tree)
        whole = whole or [max(1, high - low) for low, high in spreads.get(0, (0, [(0, 0)] * len(columns)))[1]]
        level = [k for k in level if k in spreads]
        for k in level:
            node = tree.nodes[k]
            node.weight, ranges = spreads[k]
            node.dim = max(range(len(columns)), key=lambda d: (ranges[d][1] - ranges[d][0]) / whole[d])
            node.low, node.high = ranges[node.dim]
            node.need = node.weight * (node.share // 2) / node.share
        while todo := [tree.nodes[k] for k in level if not tree.nodes[k].done]:
            bins = max(16, BINS // len(todo))
            for node in todo:
                node.step = (node.high - node.low) // bins + 1
            found = _histograms(narrow, tree)
            for k in level:
                if not tree.nodes[k].done:
                    _narrow_down(tree.nodes[k], found[k])
                    tree.nodes[k].step = 0
        below = []
        for k in level:
            node = tree.nodes[k]
            node.inner = len(tree.nodes)
            tree.nodes += [Node(node.first, node.share // 2), Node(node.first + node.share // 2, node.share - node.share // 2)]
            below += [node.inner, node.inner + 1]
        level = below
    arrays = tree.arrays()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys(batch.select([*columns, "tie", "uid"]).to_pandas(), columns)
            shard = arrays["first"][_descend(*keys, arrays)].astype(np.int32)
            yield batch.select(["id", "size", "text_crc32", "uid"]).append_column("shard", pa.array(shard))

    schema = "id long, size long, text_crc32 long, uid long, shard int"
    return numbered(staged(narrow.mapInArrow(assign, schema), "sharded"), "shard", "slot").drop("uid")


def shards_for(narrow: DataFrame, target_bytes: int) -> int:
    """How many leaves reach the target."""
    return max(1, -(-(narrow.agg(F.sum("size")).first()[0] or 0) // target_bytes))
