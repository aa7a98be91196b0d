"""Change capture by comparing a hashed source with the last seen snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.catalog import fixed_values as fv
from tierline.catalog.entities import Entity
from tierline.functions.expr import quoted, row_hash


def hashed(source: DataFrame, entity: Entity) -> DataFrame:
    """Business columns plus raw_row_hash."""
    return source.selectExpr(*entity.column_names, f"{row_hash(entity.hash_columns)} as raw_row_hash")


def snapshot(source: DataFrame, entity: Entity, seen_at: str) -> DataFrame:
    """Snapshot rows for the current source state."""
    return hashed(source, entity).selectExpr("*", f"{seen_at} as last_seen_at")


def journal_rows(rows: DataFrame, entity: Entity, batch_id: int, loaded_at: str, operation: str) -> DataFrame:
    """RAW journal rows: business columns followed by the technical block."""
    return rows.selectExpr(
        *entity.column_names,
        f"{loaded_at} as load_date",
        f"{quoted(entity.record_source)} as record_source",
        f"{quoted(fv.SOURCE_SYSTEM)} as source_system",
        f"cast({batch_id} as bigint) as batch_id",
        f"{operation} as operation_type",
        "raw_row_hash",
    )


def initial(source: DataFrame, entity: Entity, batch_id: int, loaded_at: str) -> DataFrame:
    """Full load: every source row is an insert."""
    return journal_rows(hashed(source, entity), entity, batch_id, loaded_at, "'I'")


def changes(current: DataFrame, previous: DataFrame, entity: Entity) -> DataFrame:
    """Inserted, updated and deleted rows between two hashed states, in one full outer join.

    Inserts and updates carry the new row, deletes the old one. Keys are unique on both sides (they are primary keys),
    so no key can hold more than one row per side, and the join needs at most one shuffle per side; none for a side that is
    stored bucketed by the key.
    """
    keys = list(entity.keys)
    rest = [c for c in entity.column_names if c not in keys] + ["raw_row_hash"]
    new = current.selectExpr(*keys, *[f"`{c}` as `new_{c}`" for c in rest], "true as in_new")
    old = previous.selectExpr(*keys, *[f"`{c}` as `old_{c}`" for c in rest], "true as in_old")
    operation = "case when in_old is null then 'I' when in_new is null then 'D' when new_raw_row_hash <> old_raw_row_hash then 'U' end"
    return (
        new.join(old, keys, "full_outer")
        .selectExpr("*", f"{operation} as operation_type")
        .where("operation_type is not null")
        .selectExpr(
            *[c if c in keys else f"if(in_new, `new_{c}`, `old_{c}`) as `{c}`" for c in [*entity.column_names, "raw_row_hash"]], "operation_type"
        )
    )


def delta(current: DataFrame, previous: DataFrame, entity: Entity, batch_id: int, loaded_at: str) -> DataFrame:
    """Journal rows of one batch."""
    return journal_rows(changes(current, previous, entity), entity, batch_id, loaded_at, "operation_type")


def digests(rows: DataFrame, bucket: str) -> DataFrame:
    """(bucket, rows, digest) of each bucket: a sum of row hashes, so it does not depend on the order of rows, and counts every copy."""
    whole = ", ".join(f"`{c}`" for c in rows.columns)
    hashed_rows = rows.selectExpr(f"cast({bucket} as int) as bucket", f"cast(xxhash64({whole}) as decimal(38,0)) as h")
    return hashed_rows.groupBy("bucket").agg(F.expr("count(*) as rows"), F.expr("cast(sum(h) as string) as digest"))


def inserts(current: DataFrame, previous: DataFrame, entity: Entity) -> DataFrame:
    """Rows whose key is new; on its own this is an anti join on the keys."""
    return current.join(previous.select(*entity.keys), list(entity.keys), "left_anti")


def updates(current: DataFrame, previous: DataFrame, entity: Entity) -> DataFrame:
    """New rows whose key is known and whose hash moved."""
    old = previous.selectExpr(*entity.keys, "raw_row_hash as old_hash")
    return current.join(old, list(entity.keys)).where("raw_row_hash <> old_hash").drop("old_hash")


def deletes(current: DataFrame, previous: DataFrame, entity: Entity) -> DataFrame:
    """Old rows whose key is gone."""
    return previous.join(current.select(*entity.keys), list(entity.keys), "left_anti")
