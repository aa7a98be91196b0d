"""Best-fit packing: cuts documents into pieces of at most the capacity and packs pieces into sequences, large items first.

Pieces above a third of the capacity are paired at most twice per sequence by greedy matching: the longest takes the longest partner that
still fits. All others fill the gaps by best fit, longest first, and open a sequence only where no gap fits.

Plan: lengths are whole numbers up to the capacity, so the packing depends only on how many pieces have each length. That histogram (at most
`capacity` rows, at any size of the table) is packed on the driver, with runs of equal sequences handled at once; the result is a list of
placements by length and position. Spark then numbers the pieces of each length (common.numbered, no group in one task) and looks each
one's placement up. Texts are read once; token ids leave the first step only if asked for.

Null text is an empty text: one piece that holds the end id alone. Repeated rows and rows with a null id are packed like others. An empty
table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tierline.llm.common import numbered, staged

CAPACITY, END = 4096, 1
#: Remembered runs of a Python process; forgotten all at once when there are more.
REMEMBERED = 600_000
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)")
_KEPT = "\x1c\x1d\x1e\x1f"
_RUN = re.compile(r"[^ \t\n\r]+")


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, remembered for runs between white space.

    The vocabulary drops white space before it merges letters, and none of its steps looks past it, so that the ids of a text are those
    of its runs, one after the other. A run of Latin letters and closing marks goes to the merges at once, letters and marks apart, as the
    vocabulary's own pattern parts them; all other runs take the whole way. Four control signs that Python takes for white space and the
    vocabulary does not are kept in their runs. tests/llm compare this with whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer, self.known, self.marks = Tokenizer.from_file(path), {}, {}
        self.merge, self.as_bytes = self.tokenizer.model.tokenize, ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __call__(self, text: str) -> bytes:
        runs = _RUN.findall(text) if any(c in text for c in _KEPT) else text.split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, runs))
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for run in set(runs).difference(known):
            known[run] = self._run(run)
        return b"".join(map(known.__getitem__, runs))

    def _run(self, run: str) -> bytes:
        plain = _PLAIN.fullmatch(run)
        if not plain:
            return self._whole(run)
        letters, marks = plain[1].lower(), plain[2]
        if not letters.isascii():
            letters = self.as_bytes(letters)[0][0]
        ids = [t.id for t in self.merge(letters)]
        out = struct.pack(f"<{len(ids)}I", *ids)
        if marks:
            if marks not in self.marks:
                self.marks[marks] = self._whole(marks)
            out += self.marks[marks]
        return out

    def _whole(self, run: str) -> bytes:
        return np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for all tasks of a Python process."""
    return Encoder(path)


def pieces(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) and, if asked for, ids: each document's ids and the end id, cut at the capacity."""
    path = path or public_tokenizers.path("word_bpe_49k.json")
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows, of = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part), part))
                    of.append(i)
            piece, start, length, crc, parts = zip(*rows) if rows else [()] * 5
            columns = [batch.column("id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if keep_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in parts], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    return read.mapInArrow(cut, schema)


class Plan:
    """Placements of a histogram of lengths: of length `length`, the pieces from position `rank` on go to `copies` each of the sequences from
    `first` on, at `offset`. `gaps` holds runs (first, count, used) of equal sequences by the room that is left in them."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.placed: list[tuple[int, int, int, int, int]] = []
        self.rank = dict.fromkeys(counts, 0)
        self.gaps: dict[int, list[tuple[int, int, int]]] = {}
        self.sizes: list[int] = []
        left = dict(counts)
        self._pair({n: c for n, c in left.items() if 3 * n > capacity})
        for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
            self._fill(n, left[n])

    def _place(self, length: int, first: int, count: int, copies: int, offset: int) -> None:
        self.placed.append((length, self.rank[length], first, copies, offset))
        self.rank[length] += count * copies

    def _keep(self, first: int, count: int, used: int) -> None:
        room = self.capacity - used
        if count and room:
            if room not in self.gaps:
                bisect.insort(self.sizes, room)
                self.gaps[room] = []
            self.gaps[room].append((first, count, used))

    def _open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def _pair(self, left: dict[int, int]) -> None:
        lengths = sorted(left)
        while lengths:
            n = lengths[-1]
            at = bisect.bisect_right(lengths, self.capacity - n) - 1
            if at < 0:
                first, count = self._open(left[n]), left[n]
                self._place(n, first, count, 1, 0)
                self._keep(first, count, n)
                lengths.pop()
                continue
            m = lengths[at]
            count = left[n] // 2 if m == n else min(left[n], left[m])
            if not count:  # one is left, and its only partner would be itself
                lengths_below = lengths[:at]
                if lengths_below:
                    m = lengths_below[-1]
                    count = 1
                else:
                    first = self._open(1)
                    self._place(n, first, 1, 1, 0)
                    self._keep(first, 1, n)
                    lengths.pop()
                    continue
            first = self._open(count)
            if m == n:
                self._place(n, first, count, 2, 0)
            else:
                self._place(n, first, count, 1, 0)
                self._place(m, first, count, 1, n)
            self._keep(first, count, n + m)
            left[n] -= count
            left[m] -= count
            for x in {n, m}:
                if not left[x]:
                    lengths.remove(x)

    def _fill(self, n: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self.sizes, n)
            if at == len(self.sizes):
                copies = self.capacity // n
                first, runs = self._open(-(-count // copies)), -(-count // copies)
                self._keep(first, runs, 0)
                continue
            room = self.sizes[at]
            first, runs, used = self.gaps[room].pop()
            if not self.gaps[room]:
                del self.gaps[room], self.sizes[at]
            copies = min(room // n, count)
            full = min(runs, count // copies)
            self._place(n, first, full, copies, used)
            self._keep(first, full, used + copies * n)
            self._keep(first + full, runs - full, used)
            count -= full * copies

    def lookup(self) -> dict[str, np.ndarray]:
        rows = np.array(sorted(self.placed), np.int64).reshape(-1, 5)
        return dict(zip(("length", "rank", "first", "copies", "offset"), rows.T))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces with the column `length` (1 to capacity)."""
    pieces = staged(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    histogram = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    plan = Plan({r["length"]: r["count"] for r in histogram}, capacity).lookup()
    key = plan["length"] * (1 << 48) + plan["rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            beyond = rank - plan["rank"][at]
            sequence, offset = plan["first"][at] + beyond // plan["copies"][at], plan["offset"][at] + beyond % plan["copies"][at] * length
            yield batch.drop_columns(["rank"]).append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    ranked = numbered(pieces, "length", "rank").drop("uid")
    fields = [f"`{c}` {t}" for c, t in ranked.dtypes if c != "rank"]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed token sequences themselves, from pieces that kept their ids. A sequence holds at most the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
