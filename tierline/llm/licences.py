"""Licence scan: headers and licence files by sparse TF-IDF cosine to templates, all other files by the nearest directory above that has a licence file.

A unit, a line (header) or a whole text (file), is the set of its words (runs of letters and digits in lower case), each weighing its inverse
document frequency over all documents, ln((N + 1) / (df + 1)), but no more than that of a word of one document in RARE. Words that no template has weigh as
if no document had them. So a line has the same similarity in tables of any size from RARE documents on, in which its words are as frequent. Templates
are notices, to which lines and whole texts are compared, and full licence texts, to which whole texts are; either kind has its own words. A unit has
the licence of the template of greatest cosine, if that is HEADER or more for a line, FILE or more for a whole text. A file's own licence is that of
its whole text, else that of its best line. A file whose whole text is a licence is the licence file of its directory; of several in a directory the
one with the greatest cosine counts, then the first path. Files without a licence of their own take that of the nearest directory on their path.

Plan: one pass counts documents for the templates' words only (as many rows as templates have words). One pass weighs units
within their row: the share of template words in a unit's weight bounds its cosine, so that all but a few units are ruled out exactly before they are
compared. Whole texts that a bound on the number of words does not rule out are compared with full texts through one row for each word
that these have. Inheritance joins distinct directories with their ancestors, then files with directories; a directory may hold any share of the files.

Null or empty texts have no licence of their own, but inherit. A null path is a file in no directory. Repeated rows are treated alike. Empty tables
give no rows. Ties between templates go to the first name. Other columns pass unchanged, whatever their names, except those named like a column of the
result, which takes their place.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import staged

HEADER, FILE, RARE = 0.6, 0.5, 1_000
RESULT = ("licence", "kind", "similarity", "licence_dir")
#: Names and statements that headers and notices use.
TEMPLATES = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license. Redistribution and use in source and binary forms are permitted.",
    "CC-BY-4.0": "Licensed under CC BY 4.0. Creative Commons Attribution.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0. Creative Commons Attribution ShareAlike.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
    "Proprietary": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
#: Full texts, by the licence's name. Those of AGPL-3.0 and CC-BY-NC-4.0 are put together from GPL-3.0 and CC-BY-4.0 and the clauses that differ.
TEXTS = {p.stem: p.read_text(encoding="utf-8") for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
_APART = r"[^\p{L}\p{N}]+"


def _template_words(text: str) -> list[str]:
    return sorted(set("".join(c if c.isalnum() else " " for c in text.lower()).split()))


def words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), _APART), lambda w: w != ""))


def _weights(files: DataFrame, vocabulary: list[str]) -> tuple[dict[str, float], float]:
    """Squared weights of the templates' words and of all others, from counts over all files."""
    rows = files.select(F.explode(F.array_append(F.filter(words(F.coalesce("text", F.lit(""))), lambda w: w.isin(vocabulary)), F.lit(""))).alias("w"))
    counts = {r[0]: r[1] for r in rows.groupBy("w").count().collect()}  # a row for each word, and one for all files
    n = counts.get("", 0)
    weight = lambda df: min(math.log((n + 1) / (df + 1)), math.log(RARE)) ** 2
    return {w: weight(counts.get(w, 0)) for w in vocabulary}, weight(0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def _full_texts(files: DataFrame, sets: dict[str, list[str]], weight: dict[str, float], other: float, file: float) -> DataFrame:
    """(path, kind, similarity, licence) of whole texts and the full texts they are close to."""
    names = list(sets)
    norms = [sum(weight[w] for w in sets[n]) for n in names]
    vocabulary = sorted(set().union(*sets.values()))
    held = [set(ws) for ws in sets.values()]
    holders = {w: sum(1 << k for k, ws in enumerate(held) if w in ws) for w in vocabulary}
    lines = F.split(F.lit("\n".join(f"{w} {weight[w]!r} {holders[w]}" for w in vocabulary)), "\n")
    table = files.sparkSession.range(1).select(F.explode(lines).alias("line")).select(F.split("line", " ").alias("p"))
    table = table.select(F.col("p")[0].alias("w"), F.col("p")[1].cast("double").alias("weight"), F.col("p")[2].cast("long").alias("holders"))
    units = files.filter("text IS NOT NULL").select("path", words(F.col("text")).alias("ws"))
    units = units.select("path", F.size("ws").alias("n"), F.filter("ws", lambda w: w.isin(vocabulary)).alias("known"))
    units = units.withColumn("others", F.col("n") - F.size("known"))
    # no known word weighs more than `other`, and what a unit shares with a template weighs file ** 2 of either at least
    units = units.filter((F.size("known") * (1 - file**2) >= F.col("others") * file**2) & (F.size("known") * F.lit(other) >= file**2 * min(norms) * (1 - 1e-9)))
    units = units.withColumn("uid", F.monotonically_increasing_id())
    entries = units.select("path", "uid", "others", F.explode("known").alias("w")).join(table, "w")
    dots = [F.sum(F.when(F.col("holders").bitwiseAND(F.lit(1 << k)) != 0, F.col("weight")).otherwise(0.0)).alias(f"dot{k}") for k in range(len(names))]
    sums = entries.groupBy("path", "uid", "others").agg(F.sum("weight").alias("inside"), *dots)
    choices = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(norms[k]).alias("norm"), F.col(f"dot{k}").alias("dot")) for k, n in enumerate(names)])
    compared = sums.select("path", (F.col("inside") + F.col("others") * F.lit(other)).alias("all"), F.explode(choices).alias("t"))
    cosine = F.when((F.col("all") > 0) & (F.col("t.norm") > 0), F.round(F.col("t.dot") / F.sqrt(F.col("all") * F.col("t.norm")), 6))
    return compared.select("path", F.lit("file").alias("kind"), cosine.alias("similarity"), F.col("t.name").alias("licence")).filter(F.col("similarity") >= file)


def own_licences(
    files: DataFrame, templates: dict[str, str], header: float = HEADER, file: float = FILE, texts: dict[str, str] | None = None
) -> DataFrame:
    """(path, licence, kind, similarity) of the files of (path, text) that state a licence themselves; kind is `file` or `header`."""
    sets, full = ({name: _template_words(t) for name, t in sorted(x.items())} for x in (templates, texts or {}))
    vocabulary = sorted(set().union(*sets.values()))
    weight, other = _weights(files, sorted(set(vocabulary).union(*full.values())))
    table = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, weight[w])])
    weighed = lambda ws: _sum(F.transform(ws, lambda w: F.element_at(table, w)))

    def unit(ws: Column) -> Column:
        known = F.filter(ws, lambda w: w.isin(vocabulary))
        return F.struct(known.alias("known"), (F.size(ws) - F.size(known)).alias("others"))

    lines = F.transform(F.split("text", "\n"), lambda line: unit(words(line)).withField("least", F.lit(header)))
    whole = unit(words(F.col("text"))).withField("least", F.lit(file))
    # no known word weighs more than `other`, so counts alone rule out most lines before any word is weighed
    enough = lambda u: F.size(u["known"]) >= header**2 * (1 - 1e-9) * (F.size(u["known"]) + u["others"])
    units = files.filter("text IS NOT NULL").select("path", F.posexplode(F.array_append(F.filter(lines, lambda u: (F.size(u["known"]) > 0) & enough(u)), whole)).alias("at", "unit"))
    units = units.select("path", "at", "unit.*").filter(F.size("known") > 0).withColumn("inside", weighed(F.col("known")))
    units = units.withColumn("all", F.col("inside") + F.col("others") * F.lit(other))
    units = units.filter(F.col("inside") >= F.col("least") * F.col("least") * F.col("all") * (1 - 1e-9))
    choices = F.array(
        *[F.struct(F.lit(n).alias("name"), F.array(*map(F.lit, ws)).alias("words"), F.lit(sum(weight[w] for w in ws)).alias("norm")) for n, ws in sets.items()]
    )
    compared = units.select("path", "at", "known", "least", "all", F.explode(choices).alias("t"))
    cosine = F.round(weighed(F.array_intersect("known", "t.words")) / F.sqrt(F.col("all") * F.col("t.norm")), 6)
    hits = compared.withColumn("similarity", F.when((F.col("all") > 0) & (F.col("t.norm") > 0), cosine)).filter("similarity >= least")
    kind = F.when(F.col("least") == file, "file").otherwise("header") if header != file else F.lit("header")
    ranked = hits.select("path", kind.alias("kind"), "similarity", F.col("t.name").alias("licence"))
    if full:
        ranked = ranked.unionByName(_full_texts(files, full, weight, other, file))
    best = F.min(F.struct("kind", (-F.col("similarity")).alias("less"), "licence")).alias("b")
    return ranked.groupBy("path").agg(best).select("path", "b.licence", "b.kind", (-F.col("b.less")).alias("similarity"))


def directory(path: Column) -> Column:
    """What stands before the last slash; the empty text for a file at the top."""
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(F.lit(""))


def scan(files: DataFrame, templates: dict[str, str] = TEMPLATES, texts: dict[str, str] = TEXTS) -> DataFrame:
    """The files of (path, text, ...) with licence, kind (file, header, inherited or null), similarity and licence_dir."""
    paths = files.select("path", "text")
    own = staged(own_licences(paths, templates, texts=texts), "own_licences")
    stated = own.filter("kind = 'file' AND path IS NOT NULL").groupBy(directory(F.col("path")).alias("above"))
    stated = stated.agg(F.min(F.struct((-F.col("similarity")).alias("less"), "path", "licence")).alias("s")).select("above", "s.licence")
    folders = paths.select(directory(F.col("path")).alias("dir")).filter("dir IS NOT NULL").distinct()
    parts = F.split("dir", "/")
    depths = F.when(F.col("dir") == "", F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.size(parts)))
    ancestors = folders.select("dir", F.explode(depths).alias("depth")).withColumn("above", F.array_join(F.slice(F.split("dir", "/"), F.lit(1), F.col("depth")), "/"))
    nearest = ancestors.join(stated, "above").groupBy("dir").agg(F.max(F.struct("depth", "above", "licence")).alias("n"))
    nearest = staged(nearest.select(F.col("dir").alias("_dir"), F.col("n.above").alias("_above"), F.col("n.licence").alias("_inherited")), "directories")
    own = own.select(F.col("path").alias("_path"), F.col("licence").alias("_licence"), F.col("kind").alias("_kind"), F.col("similarity").alias("_similarity"))
    kept = [c for c in files.columns if c != "text" and c.lower() not in RESULT]
    joined = files.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col("path").alias("_file"), directory(F.col("path")).alias("_at"))
    joined = joined.join(own, F.col("_file") == F.col("_path"), "left").join(nearest, F.col("_at") == F.col("_dir"), "left")
    inherits = F.col("_licence").isNull() & F.col("_inherited").isNotNull()
    return joined.select(
        *[F.col(f"_row.`{c}`") for c in kept],
        F.coalesce("_licence", "_inherited").alias("licence"),
        F.when(inherits, "inherited").otherwise(F.col("_kind")).alias("kind"),
        F.col("_similarity").alias("similarity"),
        F.when(inherits, F.col("_above")).alias("licence_dir"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source, language and blocks of a thousand ids are their directories."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in ("source", "lang")]
    block, name = (F.coalesce(c.cast("string"), F.lit("_")) for c in (F.floor(F.col("doc_id") / 1000), F.col("doc_id")))
    return docs.select("doc_id", F.concat_ws("/", *parts, block, name).alias("path"), "text")
