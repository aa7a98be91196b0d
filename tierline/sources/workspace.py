"""Where written tables go."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Hashes and surrogate keys are hex text: an entropy coder halves them, snappy leaves them as they are.
CODEC = "zstd"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below spark.checkpoint.dir, the folder all executors share; where that is unset, below the warehouse, which they share as well."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tierline"
    return f"{shared.rstrip('/')}/tierline-{purpose}-{uuid.uuid4().hex}"


def keeper(spark: SparkSession, purpose: str) -> Callable[[str, DataFrame], DataFrame]:
    """Writes rows that are read several times once, by name, below one new folder, and hands back what is written."""
    folder, kept = new_folder(spark, purpose), {}

    def keep(name: str, rows: DataFrame) -> DataFrame:
        if name not in kept:
            with tidy(spark):
                rows.write.mode("overwrite").parquet(f"{folder}/{name}", compression=CODEC)
            kept[name] = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
        return kept[name]

    return keep


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Every query run inside removes its shuffle files when it ends, so that a load of many steps holds those of one.

    Only for queries whose frames are not run again afterwards: what is needed later is read from the files they write.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
