"""Dimensions with history: close changed versions, open new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.catalog import fixed_values as fv
from tierline.functions.expr import struct_of, surrogate_key, ts, version_stamp


def _differs(column: str, kind: str) -> str:
    """NULL compares like '' for text and -1 for numbers, as the dimension loader defines it."""
    old, new = f"d.`{column}`", f"n.`{column}`"
    if kind in ("text", "int"):
        blank = "''" if kind == "text" else "-1"
        return f"coalesce({old}, {blank}) <> coalesce({new}, {blank})"
    return f"not ({old} <=> {new})"


def scd2_merge(
    dim: DataFrame | None, ods: DataFrame, key: str, sk: str, tracked: list[tuple[str, str]], effective_at: str
) -> DataFrame:
    """Versioned dimension after one load.

    A current version closes at `effective_at` when its ODS row is deleted or any tracked (column, kind) differs; an
    active ODS row without a current version opens one. Both come out of one full outer join on the key of the current
    versions. Versions already closed pass through untouched. Closing at or before the version's own start fails.
    """
    names = [c for c, _ in tracked]
    opened = ods.selectExpr(
        f"{surrogate_key(key, version_stamp(effective_at))} as {sk}",
        key,
        *names,
        "source_system",
        "record_source",
        f"{effective_at} as valid_from",
        f"{ts(fv.OPEN_END)} as valid_to",
        "true as is_current",
        "updated_batch_id as batch_id",
        "is_deleted",
    )
    columns = opened.columns[:-1]
    if dim is None:
        return opened.where("not is_deleted").select(*columns)
    n = opened.selectExpr(f"{key} as k", f"{struct_of(columns)} as n", "is_deleted")
    d = dim.where("is_current").selectExpr(f"{key} as k", f"{struct_of(columns)} as d")
    changed = " or ".join(_differs(c, kind) for c, kind in tracked)
    closes = f"d is not null and n is not null and (is_deleted or {changed})"
    message = f"concat('{sk}: version starts at or after the new effective time, key ', k)"
    end = f"if(d.valid_from < {effective_at}, {effective_at}, cast(raise_error({message}) as timestamp))"
    closed = {"valid_to": end, "is_current": "false", "batch_id": "n.batch_id"}
    closed_version = ", ".join(f"'{c}', {closed.get(c, f'd.`{c}`')}" for c in columns)
    versions = (
        d.join(n, "k", "full_outer")
        .selectExpr("k", "d", "n", "is_deleted", f"{closes} as closes")
        .selectExpr(
            f"if(closes, named_struct({closed_version}), d) as old_version",
            "case when n is not null and not is_deleted and (d is null or closes) then n end as new_version",
        )
        .selectExpr("explode(array(old_version, new_version)) as v")
        .where("v is not null")
        .selectExpr("v.*")
    )
    return dim.where("not is_current").select(*columns).unionByName(versions)


def version_counts(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.expr("count(*) as rows"),
        F.expr("count_if(is_current) as current_rows"),
        F.expr("count_if(not is_current) as historical_rows"),
    )
