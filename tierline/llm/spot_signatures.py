"""Document fingerprints by spot signatures: chains of content words that follow a common word.

Words are runs of letters and digits, in lower case. Common words of the four languages are anchors and are skipped in chains. A signature is an anchor with the
next CHAIN content words, hashed to 32 bits; the fingerprint is the set of a text's signatures. A text without
anchors takes chains of all its words instead, so that texts that differ do not share an empty fingerprint; a text without words has the empty one.
Likeness is the Jaccard index of two sets; two empty sets are alike by 1. As it is at most the smaller length over the greater, sets are compared only
within partitions of neighbouring lengths, and only if they share one of the signatures that any similar pair has to share.

All of it is column expressions and joins. Null text is an empty text. Repeated rows are rows of their own. Empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import staged

CHAIN, ROWS, BUCKETS, HALF = 3, 2_000, 65_536, 1 << 31
#: Common words: anchors, and no part of chains.
COMMON = (
    "the of and to in is that for it as was with be by on not he this are or from at an a "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le et les en un du une que est pour qui dans par plus il au ce "
    "el y los se del las por con no su para es al lo como más"
).split()


def with_signatures(frame: DataFrame, text: str, name: str, chain: int = CHAIN) -> DataFrame:
    """The frame with the set of signatures of `text` (sorted, distinct ints) as the column `name`. Own helper columns start with `_sp_`."""
    follows = lambda of, k, field=None: [F.get(F.col(of), k + n) if field is None else F.get(F.col(of), k + n)[field] for n in range(1, chain)]
    frame = frame.withColumn("_sp_w", F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    placed = F.transform("_sp_w", lambda w, i: F.struct(w.alias("word"), F.get(F.col("_sp_w"), i - 1).alias("before")))
    frame = frame.withColumn("_sp_c", F.filter(placed, lambda x: ~x["word"].isin(COMMON)))
    spots = F.transform(
        "_sp_c",
        lambda x, k: F.when(x["before"].isin(COMMON), _short(x["before"], x["word"], *follows("_sp_c", k, "word"))),
    )
    frame = frame.withColumn("_sp_s", F.filter(spots, lambda s: s.isNotNull()))
    every = F.transform("_sp_w", lambda w, k: _short(w, *follows("_sp_w", k)))
    chosen = F.when(F.size("_sp_s") > 0, F.col("_sp_s")).otherwise(every)
    return frame.withColumn(name, F.array_sort(F.array_distinct(chosen))).drop("_sp_w", "_sp_c", "_sp_s")


def _short(*parts: Column) -> Column:
    """32 bits of a hash, as an int."""
    return (F.xxhash64(*parts).bitwiseAND(0xFFFFFFFF) - HALF).cast("int")


def as_text(signatures: Column) -> Column:
    """A fingerprint as eight hex digits for each signature."""
    return F.array_join(F.transform(signatures, lambda s: F.lower(F.lpad(F.hex(s.cast("long") + HALF), 8, "0"))), " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard index of two sets; 0 without a comparison where the lengths alone rule out `least`."""
    common = F.size(F.array_intersect(a, b))
    exact = F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(common / (F.size(a) + F.size(b) - common))
    return F.when(F.least(F.size(a), F.size(b)) < least * F.greatest(F.size(a), F.size(b)), 0.0).otherwise(exact)


def with_next(docs: DataFrame, columns: list[str], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Adds `next_<column>`: the values of the row that follows by id (null ids last; equal ids by a hash of the text); after the last row comes the first.

    Rows are dealt to buckets of neighbouring ids, whose edges are percentiles (at most BUCKETS of them, the bound of what the driver holds). Into each
    bucket the first row of the next one comes as a guest, so that rows cross the network once and no task holds all ids.
    """
    order = [F.col(id_column).asc_nulls_last(), F.col("_nx_hash")]
    rows = docs.count()
    count = max(1, min(BUCKETS, rows // ROWS))
    edges = docs.agg(F.percentile_approx(id_column, [k / count for k in range(1, count)] or [0.5], 10 * BUCKETS)).first()[0] or []
    edges = sorted(set(edges)) if count > 1 else []
    hashed = docs.withColumns({"_nx_hash": F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))), "_nx_bucket": _bucket(F.col(id_column), edges)})
    smallest = F.min(F.struct(F.col(id_column).isNull().alias("n"), F.col(id_column).alias("id"), F.col("_nx_hash").alias("h")))
    firsts = hashed.groupBy("_nx_bucket").agg(smallest.alias("f")).orderBy("_nx_bucket").collect()  # at most BUCKETS + 1 rows
    pairs = [(firsts[k]["_nx_bucket"], *firsts[(k + 1) % len(firsts)]["f"][1:]) for k in range(len(firsts))]
    spark = docs.sparkSession
    guests = spark.createDataFrame(pairs, "_nx_to int, _nx_id long, _nx_h long")
    match = hashed[id_column].eqNullSafe(guests["_nx_id"]) & (hashed["_nx_hash"] == guests["_nx_h"])
    visiting = hashed.join(F.broadcast(guests), match).dropDuplicates(["_nx_to"])
    visiting = visiting.withColumn("_nx_bucket", F.col("_nx_to")).select(*hashed.columns, F.lit(1).alias("_nx_guest"))
    together = hashed.withColumn("_nx_guest", F.lit(0)).unionByName(visiting)
    window = Window.partitionBy("_nx_bucket").orderBy("_nx_guest", *order)
    led = together.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
    return led.filter("_nx_guest = 0").drop("_nx_guest", "_nx_bucket", "_nx_hash")


def _bucket(key: Column, edges: list[int]) -> Column:
    """How many edges are at most the key, in two steps of about the square root of their number; null keys come last."""
    if not edges:
        return F.lit(0)
    step = math.isqrt(len(edges)) + 1
    groups = [edges[k : k + step] for k in range(0, len(edges), step)]
    tops = F.array(*[F.lit(g[0]) for g in groups])
    group = F.size(F.filter(tops, lambda e: e <= key)) - 1
    inner = F.get(F.array(*[F.array(*[F.lit(e) for e in g]) for g in groups]), group)
    within = F.when(group < 0, 0).otherwise(group * step + F.size(F.filter(inner, lambda e: e <= key)))
    return F.when(key.isNull(), len(edges)).otherwise(within).cast("int")


def edited(docs: DataFrame) -> DataFrame:
    """Columns n_chars and edited: the last half of each text gives way to the start of the next document's text."""
    n = F.char_length(F.coalesce("text", F.lit("")))
    half = F.floor(n / 2).cast("int")
    text = F.concat(F.substr(F.coalesce("text", F.lit("")), F.lit(1), n - half), F.substr(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    return docs.withColumns({"n_chars": n.cast("long"), "edited": text})


def near_pairs(sets: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness) with a < b for all pairs of (id, signatures) that are alike by `least` or more; ids are unique, equal sets are one row before.

    Two such sets share a signature among the first len - ceil(least * len) + 1 of each, in the order from rare to common. Partitions span lengths by the factor
    1 / least, so that partners lie in the same partition or in the next one: each row is kept in its own and visits the next.
    """
    counted = sets.select("id", F.explode("signatures").alias("s"))
    rarity = counted.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    ranked = counted.join(rarity, "s").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "s"))).alias("r"))
    prefix = F.slice("r", F.lit(1), F.size("r") - F.ceil(F.size("r") * least - 1e-9).cast("int") + 1)
    keys = ranked.select("id", F.floor(F.log(F.size("r").cast("double")) / math.log(1 / least) + 1e-9).alias("p"), F.size("r").alias("len"), F.explode(prefix).alias("x"))
    keys = staged(keys.select("id", "p", "len", F.col("x.s").alias("s")), "prefixes")
    own, other = keys, keys.select(F.col("id").alias("b"), F.explode(F.array("p", F.col("p") - 1)).alias("p"), F.col("p").alias("bp"), F.col("len").alias("blen"), "s")
    met = own.join(other, ["s", "p"]).filter(
        (F.col("id") != F.col("b")) & ((F.col("bp") > F.col("p")) | (F.col("id") < F.col("b"))) & (F.least("len", "blen") >= least * F.greatest("len", "blen"))
    )
    pairs = met.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()
    left, right = (sets.select(F.col("id").alias(x), F.col("signatures").alias(f"s{x}")) for x in "ab")
    compared = pairs.join(left, "a").join(right, "b").withColumn("likeness", likeness(F.col("sa"), F.col("sb"), least))
    return compared.filter(F.col("likeness") >= least).select("a", "b", "likeness")
