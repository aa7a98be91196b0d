"""Reading the nine source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierline.catalog import fixed_values as fv
from tierline.catalog.entities import Entity


def read_parquet(spark: SparkSession, root: str, entity: Entity) -> DataFrame:
    """Source table stored as Parquet under root/<source object>."""
    return spark.read.schema(entity.source_schema).parquet(f"{root}/{entity.source_object}")


def read_jdbc(
    spark: SparkSession, url: str, entity: Entity, properties: dict[str, str], predicates: list[str]
) -> DataFrame:
    """Source table over JDBC; each predicate is read by its own task, so there has to be at least one.

    The driver jar has to be on the class path.
    """
    if not predicates:
        raise ValueError(f"{entity.name}: predicates part the table among tasks; one task would read all of it")
    table = f"{fv.SOURCE_SCHEMA}.{entity.source_object}"
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
