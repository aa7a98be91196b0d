from __future__ import annotations

import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrame, SparkSession

from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import SPARK_TYPE


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tierline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tierline-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


class Rows:
    """Source frames of the nine entities from short tuples."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __call__(self, entity: str, *rows: tuple) -> DataFrame:
        e = ENTITIES[entity]
        schema = ", ".join(f"`{c}` {SPARK_TYPE[k]}" for c, k in e.columns)
        return self.spark.createDataFrame([tuple(r) for r in rows], schema)


@pytest.fixture
def rows(spark) -> Rows:
    return Rows(spark)


HOUR = timedelta(hours=1)


def names(en: str | None, ru: str | None = None) -> str:
    parts = [f'"{k}":"{v}"' for k, v in (("en", en), ("ru", ru if ru is not None else en)) if v is not None]
    return "{" + ",".join(parts) + "}"
