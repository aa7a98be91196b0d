"""Line dedup by the spread of lines over sites: a line that stands on many sites is boilerplate and stays with its first holder only.

Lines are what line feeds separate, compared without outer blanks; blank lines are never boilerplate. A line's spread is the number of
distinct sites of the documents that hold it. A short line is boilerplate from SITES sites on. A long one, of LONG_WORDS words or more, is no
chance phrase: it is boilerplate from LONG_SITES sites on, and on one site if SITES documents hold it.

Plan: one row per document and line is grouped by the line's hash into a HyperLogLog sketch of its sites. Sketches merge,
so that a line of any share of the rows is reduced on the map side first. Lines whose estimate lies within the sketch's error of the threshold, and
long lines that occur twice, get their exact distinct counts from one more aggregate, over these lines only; the others are decided by the
estimate. Hits (document, line) are found by one join on the hash, which may be split for a hot line, are gathered by document, and are taken out
of the text in place: texts are shuffled at most once, for that join by document.

Lines are told apart by 96 bits of hash. The first holder is the smallest document id, so a passage that is shared by all is not lost; repeats
within the first holder stay. Null text stays null. A null source counts as one site. A row with a null id holds lines for their spread but
loses none, as its rows cannot be told apart, and is no document of its own; repeated rows are treated alike. An empty table gives no rows. Other
columns pass unchanged, whatever their names, but those named `_ld_lines` and `_ld_removed`, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import staged

#: Sites from which on a line is boilerplate; logarithm of a sketch's registers, and its relative standard error.
SITES, REGISTERS = 5, 10
#: Words from which on a line is long, and sites from which on such a line is boilerplate.
LONG_WORDS, LONG_SITES = 50, 2
ERROR = 1.04 / 2 ** (REGISTERS / 2)


def line_keys(text: Column) -> Column:
    """Hash pairs of a text's lines, in their order; null for blank lines."""
    return F.transform(
        F.split(text, "\n"),
        lambda line: F.when(F.trim(line) != "", F.struct(F.xxhash64(F.trim(line)).alias("a"), F.hash(F.trim(line)).alias("b"))),
    )


def _is_long(line: Column) -> Column:
    """Words are what blanks and tabs separate; most lines are too short to be looked at."""
    words = F.size(F.filter(F.split(line, "[ \t]+"), lambda w: w != ""))
    return F.when(F.char_length(line) >= 2 * LONG_WORDS - 1, words >= LONG_WORDS).otherwise(F.lit(False))


def boilerplate(docs: DataFrame, sites: int = SITES, id_column: str = "doc_id", site_column: str = "source") -> tuple[DataFrame, DataFrame]:
    """(hits, spread): (id, key) of every line to take out, and (key, sites, first) of every boilerplate line."""
    lines = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(site_column).cast("string"), F.lit("")).alias("site"),
        F.explode(F.filter(F.transform(F.split("text", "\n"), lambda line: F.trim(line)), lambda line: line != "")).alias("line"),
    )
    held = lines.select("id", "site", F.xxhash64("line").alias("a"), F.hash("line").alias("b"), _is_long(F.col("line")).alias("long"))
    sketched = held.groupBy("a", "b").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(REGISTERS))).alias("sites"),
        F.min("id").alias("first"),
        F.bool_or("long").alias("long"),
        F.count(F.lit(1)).alias("times"),
    )
    margin = max(1.0, 4 * ERROR * sites)
    possible = staged(sketched.filter((F.col("sites") >= sites - margin) | (F.col("long") & (F.col("times") > 1))), "lines")
    near = possible.filter((F.col("sites") <= sites + margin) | F.col("long")).select("a", "b")
    exact = held.join(near, ["a", "b"]).groupBy("a", "b").agg(F.countDistinct("site").alias("exact"), F.countDistinct("id").alias("docs"))
    decided = possible.join(exact, ["a", "b"], "left").withColumn("sites", F.coalesce("exact", "sites")).drop("exact")
    long = F.col("long") & ((F.col("sites") >= LONG_SITES) | (F.col("docs") >= sites))
    spread = staged(decided.filter((F.col("sites") >= sites) | long).select("a", "b", "sites", "first"), "spread")
    return held.select("id", "a", "b").join(spread, ["a", "b"]).filter(F.col("id") > F.col("first")).select("id", "a", "b"), spread


def clean(docs: DataFrame, sites: int = SITES) -> DataFrame:
    """The documents without other documents' boilerplate lines, and with `_ld_lines` and `_ld_removed`."""
    hits, _ = boilerplate(docs, sites)
    own = "_ld_"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    by_doc = hits.groupBy(F.col("id").alias(own + "id")).agg(F.collect_set(F.struct("a", "b")).alias(own + "hits"))
    joined = docs.join(by_doc, docs["doc_id"] == by_doc[own + "id"], "left")
    lines = F.split("text", "\n")
    keyed = F.arrays_zip(lines.alias("line"), line_keys(F.col("text")).alias("key"))
    kept = F.filter(keyed, lambda x: x["key"].isNull() | ~F.array_contains(own + "hits", x["key"]))
    kept = F.when(F.col(own + "hits").isNull(), lines).otherwise(F.transform(kept, lambda x: x["line"]))
    out = joined.withColumns({own + "kept": kept, own + "lines": F.size(F.coalesce(lines, F.array()))})
    text = F.when(F.col("text").isNotNull(), F.concat_ws("\n", own + "kept")).alias("text")
    return out.select(
        *[text if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in ("_ld_lines", "_ld_removed")],
        F.col(own + "lines").alias("_ld_lines"),
        (F.col(own + "lines") - F.size(F.coalesce(own + "kept", F.array()))).alias("_ld_removed"),
    )
