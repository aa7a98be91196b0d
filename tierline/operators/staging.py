"""STAGE: cut one batch out of the journal, clean it and mark invalid rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.catalog.entities import Entity
from tierline.functions.expr import quoted

TECHNICAL = ["source_system", "record_source", "batch_id", "operation_type"]


def latest_batch_id(journal: DataFrame) -> int:
    """Highest batch of a journal; an empty journal is an error."""
    batch_id = journal.agg(F.max("batch_id")).first()[0]
    if batch_id is None:
        raise ValueError("no batch_id found in the journal")
    return batch_id


def clean(journal: DataFrame, entity: Entity, batch_id: int, staged_at: str) -> DataFrame:
    if batch_id is None:
        raise ValueError(f"batch_id is required to stage {entity.name}")
    return journal.where(f"batch_id = {batch_id}").selectExpr(
        *[c.sql() for c in entity.stage], "load_date as raw_load_date", f"{staged_at} as stg_load_date", *TECHNICAL
    )


def validate(cleaned: DataFrame, entity: Entity) -> DataFrame:
    """Adds validation_error (all broken rules, '; '-joined, NULL if none) and is_valid."""
    messages = ", ".join(f"case when {rule.broken} then {quoted(rule.message)} end" for rule in entity.rules)
    return cleaned.selectExpr("*", f"nullif(concat_ws('; ', {messages}), '') as validation_error").selectExpr(
        "*", "validation_error is null as is_valid"
    )


def stage(journal: DataFrame, entity: Entity, staged_at: str, batch_id: int | None = None) -> DataFrame:
    """Cleaned and validated rows of one batch, by default the latest."""
    if batch_id is None:
        batch_id = latest_batch_id(journal)
    return validate(clean(journal, entity, batch_id, staged_at), entity)


def counts(staged: DataFrame) -> DataFrame:
    """Rows and invalid rows per batch."""
    return staged.groupBy("batch_id").agg(F.expr("count(*) as rows"), F.expr("count_if(not is_valid) as invalid_rows"))
