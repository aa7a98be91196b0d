"""Source divergence audit: how far the word use of the sources of a language lies apart, and which terms make a source differ.

Terms are the stretches of letters and non-ASCII signs of a text, A-Z in lower case. A language keeps the terms that at least `least` of its
documents hold; V is their number. Over kept terms, a group (language, source, or a whole language) with count c of a term and N of all terms
gives it p = 1 + floor(SCALE * (c + 2) / (N + 2 V)), and two groups differ at a term by f = floor((p - q)^2 / (p + q)). All numbers are whole.

Method (chunk factorization): no term reaches over white space, so texts are counted by the chunks between white space. A task counts the
chunks of its documents and folds them into blocks of whole documents: the distinct chunks of a block, and for each the documents that hold it
with their numbers of occurrences. Each globally distinct chunk is taken apart into terms once. A term whose chunks are held by fewer than
`least` documents, counted over all chunks and languages, cannot be kept; it is left out before the terms are joined back to the chunks of the
blocks. Within a block the documents of all chunks with a term are put together, so that a document counts once; blocks have no document in
common, so their counts add up.

At size: blocks are folded before any shuffle and travel compressed; a frequent chunk is one row for each block, and what comes together in one
task is TOGETHER blocks. Pairs of sources are compared in cells of SOURCES x SOURCES x TERMS; a cell holds every source of its two blocks of sources, so that
counts of zero need no rows. The ten best terms of a group are found by a ranking that is cut off on the map side.

Null text, language and source count as empty; empty texts hold no terms, and a group without kept terms still takes part. Every row is a
document of its own, also with a repeated or null id. Ties in a ranking go to the smaller item by its UTF-8 bytes. Other columns are not read;
they may have any names. An empty table gives no rows; a language without kept terms gives pairs of value 0 and no terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import staged, staged_by

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
#: Words after which a block is handed on; a block ends with a document. It bounds the memory of a task.
BLOCK = 6_000_000
#: Blocks that one task puts together, on average, and (document, chunk) pairs it looks at at once.
TOGETHER, SLICE = 3, 500_000
#: Sources and terms of a cell, on average.
SOURCES, TERMS = 128, 2048


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(numbers, np.int32).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int32)


def chunk_blocks(docs: DataFrame) -> DataFrame:
    """One row for each block of documents: (block, chunks, held, doc, n, groups, own), compressed.

    chunks: the distinct chunks, a line each. held: how many documents hold each. doc, n: for each chunk after the other the documents that hold it,
    as steps from one to the next, and the occurrences there. groups, own: the (lang, source) of the block, and the number of that of each document.
    """
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    read = docs.select(F.spark_partition_id().cast("long").alias("part"), *columns, F.col("text").cast("binary").alias("text"))
    schema = "block long, chunks binary, held binary, doc binary, n binary, groups array<struct<lang: string, source: string>>, own binary"
    pair = pa.list_(pa.struct([("lang", pa.string()), ("source", pa.string())]))

    def block_of(number: int, chunks: dict, codes: list, sizes: list, groups: dict, own: list) -> pa.RecordBatch:
        at = np.repeat(np.arange(len(sizes)), sizes)
        key, n = np.unique(np.concatenate(codes).astype(np.int64) * len(sizes) + at, return_counts=True)
        code, doc = np.divmod(key, len(sizes))
        names = zstandard.ZstdCompressor(level=3).compress(b"\n".join(chunks))
        values = [[number], [names], [_packed(np.bincount(code))], [_packed(np.diff(doc, prepend=0))], [_packed(n)]]
        values += [pa.array([[{"lang": a, "source": b} for a, b in groups]], pair), [_packed(np.array(own))]]
        return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in values], "block chunks held doc n groups own".split())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, codes, sizes, groups, own, words, blocks, part = {}, [], [], {}, [], 0, 0, 0
        for batch in batches:
            for part, lang, source, text in zip(*[c.to_pylist() for c in batch.columns]):
                found = text.split() if text else ()
                if not found:
                    continue
                codes.append(np.fromiter((chunks.setdefault(c, len(chunks)) for c in found), np.int32, len(found)))
                sizes.append(len(found))
                own.append(groups.setdefault((lang, source), len(groups)))
                words += len(found)
                if words >= BLOCK:
                    yield block_of((part << 32) + blocks, chunks, codes, sizes, groups, own)
                    chunks, codes, sizes, groups, own, words, blocks = {}, [], [], {}, [], 0, blocks + 1
        if words:
            yield block_of((part << 32) + blocks, chunks, codes, sizes, groups, own)

    return read.mapInArrow(count, schema)


def _chunks(blocks: DataFrame) -> DataFrame:
    """(block, k, chunk, held) for each distinct chunk of each block."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, chunks, held in zip(*[c.to_pylist() for c in batch.columns]):
                names = zstandard.ZstdDecompressor().decompress(chunks).split(b"\n")
                held = _unpacked(held)
                for at in range(0, len(names), 100_000):
                    part = names[at : at + 100_000]
                    columns = [pa.repeat(pa.scalar(block, pa.int64()), len(part)), pa.array(np.arange(at, at + len(part), dtype=np.int32))]
                    columns += [pa.array(part, pa.binary()).cast(pa.string()), pa.array(held[at : at + len(part)])]
                    yield pa.RecordBatch.from_arrays(columns, ["block", "k", "chunk", "held"])

    return blocks.select("block", "chunks", "held").mapInArrow(unfold, "block long, k int, chunk string, held int")


def term_counts(docs: DataFrame, least: int = 1) -> DataFrame:
    """(lang, source, term, docs, n): documents that hold a term, and its occurrences. Terms that fewer than `least` documents hold in all may be missing."""
    blocks = staged(chunk_blocks(docs), "blocks")
    # Dealt out by chunk once, and stored that way: neither the count nor the join shuffles it again.
    chunks = staged_by(_chunks(blocks), "chunk", "chunks")
    words = F.regexp_extract_all(F.translate("chunk", UPPER, LOWER), F.lit(TERM), F.lit(0))
    terms = chunks.groupBy("chunk").agg(F.sum("held").alias("held")).select("chunk", "held", F.explode(words).alias("term"))
    terms = staged(terms, "terms")
    likely = terms.groupBy("term").agg(F.sum("held").alias("held")).filter(F.col("held") >= least)
    likely = staged(likely.select("term", F.monotonically_increasing_id().alias("id")), "likely")
    found = chunks.select("block", "k", "chunk").join(terms.join(likely, "term").select("chunk", "id"), "chunk")
    # Blocks are numbered by part and place there: neighbouring parts go to different teams, so that teams are even.
    teams = max(1, blocks.count() // TOGETHER)
    team = F.pmod(F.shiftright("block", 32) + F.col("block").bitwiseAND((1 << 32) - 1), F.lit(teams)).alias("team")
    columns = ["block", "held", "doc", "n", "groups", "own"]
    counted = (
        blocks.select(team, *columns).groupBy("team").cogroup(found.select(team, "block", "k", "id").groupBy("team"))
        .applyInPandas(_counted, "lang string, source string, id long, docs long, n long")
    )
    summed = counted.groupBy("lang", "source", "id").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    return summed.join(likely, "id").select("lang", "source", "term", "docs", "n")


def _counted(blocks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """Documents and occurrences by (lang, source, term id) over the blocks of a team, one block after the other, so many occurrences at a time."""
    groups: dict[tuple, int] = {}
    for own in blocks["groups"]:
        for g in own:
            groups.setdefault((g["lang"], g["source"]), len(groups))
    code, ids = pd.factorize(rows["id"].to_numpy())
    code, k, block = code.astype(np.int32), rows["k"].to_numpy(np.int32), rows["block"].to_numpy()
    total = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for one in blocks.to_dict("records"):
        mine = np.flatnonzero(block == one["block"])
        mine = mine[np.argsort(code[mine], kind="stable")]
        group = np.array([groups[g["lang"], g["source"]] for g in one["groups"]], np.int64)[_unpacked(one["own"])]
        n, doc, held = _unpacked(one["n"]), np.cumsum(_unpacked(one["doc"]), dtype=np.int32), _unpacked(one["held"])
        first, parts = np.cumsum(held, dtype=np.int64) - held, [total]
        # Slices end with a term.
        reach, ends = np.cumsum(held[k[mine]], dtype=np.int64), np.flatnonzero(np.diff(code[mine], append=-1)) + 1
        at = 0
        while at < len(mine):
            start = reach[at - 1] if at else 0
            last = ends[min(len(ends) - 1, max(np.searchsorted(ends, at, "right"), np.searchsorted(reach[ends - 1], start + SLICE, "right") - 1))]
            part, at = mine[at:last], last
            size = held[k[part]].astype(np.int64)
            # Places in doc and n of all documents of all chunks of these terms.
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - first[k[part]], size)
            key, row = np.unique(np.repeat(code[part], size).astype(np.int64) * len(group) + doc[place], return_inverse=True)
            times = np.bincount(row, n[place]).astype(np.int64)
            # Now one row for each term and document; next one for each term and group.
            parts.append(_summed(key // len(group) * len(groups) + group[key % len(group)], np.ones(len(key), np.int64), times))
        total = _summed(*[np.concatenate(x) for x in zip(*parts)])
    out = pd.DataFrame({"id": ids[total[0] // max(1, len(groups))], "docs": total[1], "n": total[2]})
    for place, column in enumerate(("lang", "source")):
        names = np.array([g[place] for g in groups], object)
        out.insert(place, column, pd.Series(names[total[0] % len(groups)] if len(total[0]) else [], dtype=object))
    return out


def _summed(key: np.ndarray, docs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(key):
        return key, docs, n
    key, at = np.unique(key, return_inverse=True)
    return key, np.bincount(at, docs).astype(np.int64), np.bincount(at, n).astype(np.int64)


def _weight(count: str, total: str, terms: str) -> str:
    """p as SQL, exact for any count below 10^19; 1 where there are no kept terms."""
    return f"if({terms} = 0, 1L, 1 + (cast({SCALE} as decimal(11,0)) * (cast({count} as decimal(20,0)) + 2)) div (cast({total} as decimal(20,0)) + 2 * cast({terms} as decimal(20,0))))"


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def divergence(docs: DataFrame, least: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): for each group its distance to every other source of the language (`pair`), and the `top`
    terms that it uses more than the language does (`term`)."""
    counts = staged(term_counts(docs, least), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least).drop("docs")
    kept = staged(kept, "kept")
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    entries = counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    groups = docs.select(*empty).distinct()
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    groups = groups.join(sizes, "lang").join(of_lang, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = staged(groups.fillna(0, ["terms", "lang_total", "total"]).selectExpr("*", f"{_weight('0', 'total', 'terms')} as p0"), "groups")
    weighed = entries.join(groups, ["lang", "source"]).selectExpr(
        "lang", "source", "term", f"{_weight('n', 'total', 'terms')} as p", f"{_weight('lang_n', 'lang_total', 'terms')} as q", "sources", "terms"
    )
    weighed = staged(weighed, "weighed")
    telling = weighed.filter("p > q").selectExpr("lang", "source", "'term' as part", "term as item", f"{_apart('p', 'q')} as value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [telling.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)]
    ranked.append(_pairs(weighed, groups).withColumn("rank", F.row_number().over(order)))
    return ranked[1].unionByName(ranked[0])


def _pairs(weighed: DataFrame, groups: DataFrame) -> DataFrame:
    """Distance of each ordered pair of sources of a language, over all its kept terms."""
    blocks, parts = f"cast(ceil(sources / {SOURCES}) as int)", f"cast(greatest(1, ceil(terms / {TERMS})) as int)"
    own = f"pmod(xxhash64(source), {blocks})"
    with_own = f"{own} as own"
    rows = weighed.selectExpr("lang", "source", "term", "p", with_own, f"pmod(xxhash64(term), {parts}) as part", f"explode(sequence(0, {blocks} - 1)) as other")
    heads = groups.selectExpr("lang", "source", "cast(null as string) as term", "p0 as p", with_own, f"{blocks} as blocks", f"explode(sequence(0, {parts} - 1)) as part")
    heads = heads.selectExpr("lang", "source", "term", "p", "own", "cast(part as long) as part", "explode(sequence(0, blocks - 1)) as other")
    cells = rows.unionByName(heads).selectExpr("lang", "least(own, other) as low", "greatest(own, other) as high", "part", "source", "own", "term", "p")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        lang, low, high = cell["lang"].iloc[0], cell["low"].iloc[0], cell["high"].iloc[0]
        head = cell[cell["term"].isna()].sort_values("source")
        rows = cell[cell["term"].notna()]
        names, base, own = head["source"].to_numpy(), head["p"].to_numpy(np.int64), head["own"].to_numpy()
        place = {s: k for k, s in enumerate(names)}
        code, distinct = pd.factorize(rows["term"])
        p = np.repeat(base[:, None], max(1, len(distinct)), axis=1)[:, : len(distinct)]
        p[[place[s] for s in rows["source"]], code] = rows["p"].to_numpy(np.int64)
        x, y, value = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a in np.flatnonzero(own == low):
            b = np.flatnonzero(own == high)
            b = b[b > a] if low == high else b
            x.append(np.full(len(b), a))
            y.append(b)
            value.append(((p[a] - p[b]) ** 2 // (p[a] + p[b])).sum(axis=1))
        x, y = np.concatenate(x), np.concatenate(y)
        out = pd.DataFrame({"value": np.concatenate(value), "seen": len(distinct), "px": base[x], "py": base[y]})
        for column, text in (("lang", [lang] * len(x)), ("x", names[x]), ("y", names[y])):
            out[column] = pd.Series(text, dtype=object)
        return out

    schema = "lang string, x string, y string, value long, seen long, px long, py long"
    parted = cells.groupBy("lang", "low", "high", "part").applyInPandas(compare, schema)
    summed = parted.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.max("px").alias("px"), F.max("py").alias("py"))
    of_lang = groups.groupBy("lang").agg(F.max("terms").alias("terms"))
    whole = summed.join(of_lang, "lang").selectExpr("lang", "x", "y", f"value + (terms - seen) * ({_apart('px', 'py')}) as value")
    both = whole.select("lang", F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item")))).alias("s"), "value")
    return both.select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
