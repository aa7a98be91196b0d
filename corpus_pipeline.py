"""The training-data pipeline: stages over `documents`, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.llm import decontamination, line_dedup, packing, simhash_dedup, toxicity
from tierline.llm.common import staged
from tierline.llm.tables import table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more for toxicity go. All labels may be learned from here; nothing is held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return docs.filter(toxicity.score(model) < 0.5)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sites, long ones on two, stay with their first holder only; n_chars follows the text. No document goes."""
    cleaned = line_dedup.clean(docs)
    counted = F.when(F.col("_ld_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", counted).select([f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id: fingerprints of three-word shingles linked at two or fewer differing bits."""
    return simhash_dedup.keep_one(docs, reach=2, width=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and place, for all documents that are left."""
    packed = packing.pack(packing.pieces(docs))
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
