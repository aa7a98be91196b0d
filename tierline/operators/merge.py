"""Keyed merges: upsert with a guard, ODS apply with soft delete, latest row per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.catalog.entities import Entity
from tierline.functions.expr import struct_of


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest `order` per key.

    An aggregate, not a window: each map task already reduces a hot key to one row before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.expr(f"max_by({struct_of(rest)}, {struct_of(order)}) as row"))
    return best.selectExpr(*[c if c in keys else f"row.`{c}`" for c in df.columns])


def _second(what: str, keys: list[str], broken: str) -> str:
    """A filter that lets every row pass and raises on one for which `broken` holds."""
    message = f"concat('{what}: second row for key ', to_json({struct_of(keys)}))"
    return f"case when {broken} then cast(raise_error({message}) as boolean) else true end"


def fail_on_second(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Raises when a key occurs twice. Shuffle and sort order are the ones the following merge needs anyway."""
    key = ", ".join(keys)
    numbered = df.selectExpr("*", f"row_number() over (partition by {key} order by {key}) as nth")
    return numbered.where(_second(what, keys, "nth > 1")).drop("nth")


def upsert(
    target: DataFrame | None,
    delta: DataFrame,
    keys: list[str],
    keep: Iterable[str] = (),
    guard: str = "true",
    checked: bool = False,
) -> DataFrame:
    """Insert new keys, replace known ones.

    keep:    columns an existing row holds on to.
    guard:   condition over t (target row) and d (delta row) under which an existing row is replaced, e.g.
             "t.batch_id < d.batch_id".
    checked: the delta is known to hold each key once; otherwise a key that occurs twice fails the query.
    A key with a NULL part fails the query: nothing could ever find such a row again.
    A target stored bucketed by `keys` is not shuffled. Columns stay columns through the join, so those that nobody asks for cross no shuffle.
    """
    missing = " or ".join(f"`{k}` is null" for k in keys)
    message = f"concat('upsert: key with a NULL part ', to_json({struct_of(keys)}))"
    delta = delta.where(f"case when {missing} then cast(raise_error({message}) as boolean) else true end")
    if not checked:
        delta = fail_on_second(delta, keys, "upsert")
    if target is None:
        return delta
    columns, keep = delta.columns, set(keep)
    t = target.selectExpr(*[f"`{c}`" for c in columns], "true as _known").alias("t")
    d = delta.selectExpr(*[f"`{c}`" for c in columns], "true as _given").alias("d")
    merged = t.join(d, F.expr(" and ".join(f"t.`{k}` = d.`{k}`" for k in keys)), "full_outer")
    replaced = f"t._known is null or (d._given is not null and ({guard}))"
    return merged.selectExpr(
        *[f"if({'t._known is null' if c in keep else replaced}, d.`{c}`, t.`{c}`) as `{c}`" for c in columns]
    )


def apply_stage(ods: DataFrame | None, staged: DataFrame, entity: Entity, changed_at: str) -> DataFrame:
    """ODS after one batch: valid inserts and updates first, then soft deletes, in one pass over the table.

    A deleted key comes back to life on a later insert; created_batch_id never moves; deletes of unknown keys are ignored.
    """
    keys = list(entity.keys)
    key = ", ".join(keys)
    rest = [c for c in entity.stage_names if c not in keys] + ["source_system", "record_source"]
    # Cleansing may fold two source keys into one: a delete may then meet an upsert (both apply), but two upserts fail.
    # Upserts sort first, so the first row of a key sees in the next one what else there is. The check sits on that
    # first row: on the second it could be skipped, because only first rows are kept.
    over = f"over (partition by {key} order by operation_type = 'D')"
    batch = (
        staged.where("is_valid and operation_type in ('I', 'U', 'D')")
        .selectExpr("*", "case when operation_type = 'D' then batch_id end as deleted_in")
        .selectExpr(
            "*",
            f"row_number() {over} as nth",
            f"lead(deleted_in) {over} as deleted_next",
            f"lead(deleted_in is null) {over} as upsert_next",
        )
        .where("nth = 1 and " + _second(f"ods {entity.name}", keys, "upsert_next"))
        .selectExpr(
            *keys,
            *[f"`{c}` as `u_{c}`" for c in [*rest, "batch_id", "operation_type"]],
            "deleted_in is null as upserted",
            "coalesce(deleted_in, deleted_next) as deleted_in",
        )
    )
    if ods is None:
        # Nothing to merge with; the rows stay distributed by key.
        return batch.where("upserted").selectExpr(
            *[c if c in keys else f"`u_{c}` as `{c}`" for c in [*entity.stage_names, "source_system", "record_source"]],
            "u_batch_id as created_batch_id",
            "coalesce(deleted_in, u_batch_id) as updated_batch_id",
            f"{changed_at} as last_changed_at",
            "deleted_in is not null as is_deleted",
            "if(deleted_in is null, u_operation_type, 'D') as last_operation_type",
        )
    technical = ["created_batch_id", "updated_batch_id", "last_changed_at", "is_deleted", "last_operation_type"]
    known = ods.selectExpr(*keys, *[f"`{c}` as `t_{c}`" for c in [*rest, *technical]], "true as known")
    both = known.join(batch, keys, "full_outer").where("known or upserted")
    new_batch, untouched = "if(upserted, u_batch_id, null)", "upserted is not true and deleted_in is null"
    return both.selectExpr(
        *[
            c if c in keys else f"if(upserted, `u_{c}`, `t_{c}`) as `{c}`"
            for c in [*entity.stage_names, "source_system", "record_source"]
        ],
        f"coalesce(t_created_batch_id, {new_batch}) as created_batch_id",
        f"coalesce(deleted_in, {new_batch}, t_updated_batch_id) as updated_batch_id",
        f"if({untouched}, t_last_changed_at, {changed_at}) as last_changed_at",
        f"if({untouched}, t_is_deleted, deleted_in is not null) as is_deleted",
        "if(deleted_in is null, coalesce(if(upserted, u_operation_type, null), t_last_operation_type), 'D') as last_operation_type",
    )


def replace_groups(target: DataFrame | None, groups: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """The target with the rows of `groups` taken out and `fresh` put in. Groups without fresh rows are gone."""
    if target is None:
        return fresh
    same = [target[k].eqNullSafe(groups[k]) for k in keys]
    return target.join(groups, same, "left_anti").unionByName(fresh)


def active_counts(df: DataFrame) -> DataFrame:
    """Total, active and deleted rows of a table with soft deletes."""
    return df.agg(
        F.expr("count(*) as rows"),
        F.expr("count_if(not is_deleted) as active_rows"),
        F.expr("count_if(is_deleted) as deleted_rows"),
    )
