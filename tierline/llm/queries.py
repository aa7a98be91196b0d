"""The registered queries over the operators of this package, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import decontamination, html_extraction, kd_sharding, language_id, licences, line_dedup, packing, periodic_runs, quality, simhash_dedup, source_divergence, spot_signatures, sql, toxicity
from tierline.llm.common import held_out
from tierline.llm.tables import table


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document, linked at up to two differing bits."""
    groups = simhash_dedup.near_groups(simhash_dedup.fingerprints(table(spark, sf_dir, "documents")), reach=2)
    return groups.select(
        groups["id"].alias("doc_id"),
        simhash_dedup.hexadecimal("fingerprint").alias("fingerprint"),
        groups["component"].alias("component_id"),
    )


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    docs = table(spark, sf_dir, "documents")
    shards = kd_sharding.shard_by_tree(kd_sharding.sizes(docs, kd_sharding.metadata(docs)), 8)
    return shards.select(
        shards["id"].alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of at most 4096 tokens, packed into sequences."""
    packed = packing.pack(packing.pieces(table(spark, sf_dir, "documents")))
    return packed.select(packed["id"].alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on five sites or more, long ones on two or in five documents, but for their first holder."""
    cleaned = line_dedup.clean(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", F.col("_ld_lines").alias("lines"), F.col("_ld_removed").alias("lines_removed"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels whose id has remainder 0 of 5 are held out."""
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~out)
    scored = docs.select("doc_id", out.alias("held_out"), toxicity.score(model).alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or that of the nearest directory above."""
    return licences.scan(licences.document_paths(table(spark, sf_dir, "documents")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; languages of ids with remainder 1 of 3 are held out."""
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 3, 1)
    predicted = docs.select("doc_id", out.alias("held_out"), language_id.prediction(language_id.fit(docs, ~out)).alias("p"))
    return predicted.select("doc_id", "held_out", F.col("p.language").alias("lang_pred"), "p.score")


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are; the same for the next document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = spot_signatures.with_signatures(docs, "text", "own")
    edited = spot_signatures.edited(spot_signatures.with_next(own, ["text", "own"]))
    both = spot_signatures.with_signatures(edited, "edited", "other")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        spot_signatures.as_text(F.col("own")).alias("fingerprint"),
        spot_signatures.as_text(F.col("other")).alias("edited_fingerprint"),
        spot_signatures.likeness(F.col("own"), F.col("other")).alias("near_edited"),
        spot_signatures.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of ids with remainder 2 of 4 are held out."""
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 4, 2)
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~out)
    scored = docs.select("doc_id", out.alias("held_out"), quality.score(model).alias("score"))
    return scored.select("*", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a passage of a benchmark item, with its best window for each item."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extraction.main_text(table(spark, sf_dir, "pages"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source lies from every other one of its language, and the ten terms that tell it from the language."""
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of the words of every document, a tenth of them with a periodic end."""
    found = periodic_runs.digest(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), rewrite=True))
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_kd_sharding": op2_kd_sharding,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_licence_scan": op6_licence_scan,
    "op7_language_id": op7_language_id,
    "op8_spot_signatures": op8_spot_signatures,
    "op9_quality": op9_quality,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_html_extraction": op11_html_extraction,
    "op12_source_divergence": op12_source_divergence,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL: dict[str, str] = {"op4_line_dedup": sql.LINE_DEDUP, "op6_licence_scan": sql.licence_scan(), "op12_source_divergence": sql.SOURCE_DIVERGENCE}
