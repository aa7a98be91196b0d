"""Constraint checks as queries: keys, foreign keys, row rules, ranges that must not overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.sources.workspace import new_folder

# Conditions between a period and the end of the one before it.
OVERLAPS = "{before} > start"
GAPS = "{before} < start"


def _null_part(keys: list[str]) -> str:
    return "(" + " or ".join(f"`{k}` is null" for k in keys) + ")"


def duplicate_keys(df: DataFrame, keys: list[str], nulls_are_bad: bool = True) -> DataFrame:
    """Keys that occur twice, and keys with a NULL part unless nulls are allowed (as in a UNIQUE constraint)."""
    per_key = df.groupBy(*keys).agg(F.expr("count(*) as rows"))
    null_part = _null_part(keys)
    return per_key.where(f"rows > 1 or {null_part}" if nulls_are_bad else f"rows > 1 and not {null_part}")


def orphans(child: DataFrame, child_columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """Foreign key values without a parent, with their row counts.

    Child rows are counted per value first, so a hot value crosses the shuffle as one row per map task.
    """
    names = [f"fk_{i}" for i in range(len(child_columns))]
    values = (
        child.selectExpr(*[f"`{c}` as {n}" for c, n in zip(child_columns, names)])
        .where(f"not {_null_part(names)}")
        .groupBy(*names)
        .agg(F.expr("count(*) as rows"))
    )
    parents = parent.selectExpr(*[f"`{c}` as {n}" for c, n in zip(parent_columns, names)])
    return values.join(parents, names, "left_anti")


def broken_rules(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule with the number of rows that break it; NULL does not break a rule. One scan for all rules."""
    counted = df.agg(*[F.expr(f"count_if(not ({rule})) as r{i}") for i, rule in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    return counted.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)")


def neighbours(df: DataFrame, key: str, start: str, end: str, broken: str, chunks: int | None = None) -> DataFrame:
    """One row with the number of adjacent periods per key for which `broken` (OVERLAPS or GAPS) holds."""
    found = per_key_periods(df, key, start, end, {"violations": broken}, chunks=chunks)
    return found.agg(F.expr("cast(coalesce(sum(violations), 0) as bigint) as violations"))


def per_key_periods(
    df: DataFrame, key: str, start: str, end: str, broken: dict[str, str], counted: dict[str, str] | None = None, chunks: int | None = None
) -> DataFrame:
    """(key, one column per name): how many adjacent periods of the key break a condition, and how many of its rows meet one of `counted`.

    Conditions of `broken` are OVERLAPS or GAPS; a period comes after another of its key in (start, end) order. All measures come
    out of one range partitioning. One key may own a third of all periods, and a third of all rows may be copies of one period. So
    copies are folded and counted first, and the rest is range-partitioned by (key, start, end): a hot key spreads over many
    chunks. Pairs inside a chunk are counted there; each chunk hands on only its first start and last end per key, and the seams
    between chunks are counted over those.
    """
    counted = counted or {}
    rows = df.selectExpr(f"{key} as key", f"{start} as start", f"{end} as end", *[f"{c} as `{n}`" for n, c in counted.items()])
    met = [F.expr(f"count_if(`{n}`) as `{n}`") for n in counted]
    ranged = rows.groupBy("key", "start", "end").agg(F.expr("count(*) - 1 as copies"), *met).repartitionByRange(
        *([chunks] if chunks else []), "key", "start", "end"
    )
    after_previous = {n: f"if({c.format(before='prev_end')}, 1, 0)" for n, c in broken.items()}
    after_copy = {n: f"copies * if({c.format(before='end')}, 1, 0)" for n, c in broken.items()}
    per_chunk = (
        ranged.selectExpr("*", "spark_partition_id() as chunk")
        .selectExpr("*", "lag(end) over (partition by chunk, key order by start, end) as prev_end")
        .groupBy("chunk", "key")
        .agg(
            *[F.expr(f"sum({after_previous[n]} + {after_copy[n]}) as `{n}`") for n in broken],
            *[F.expr(f"sum(`{n}`) as `{n}`") for n in counted],
            F.expr("min(start) as start"),
            F.expr("max(struct(start, end)).end as end"),
        )
    )
    return (
        per_chunk.selectExpr("*", "lag(end) over (partition by key order by chunk) as prev_end")
        .groupBy("key")
        .agg(*[F.expr(f"sum(`{n}` + {after_previous[n]}) as `{n}`") for n in broken], *[F.expr(f"sum(`{n}`) as `{n}`") for n in counted])
    )


def overlapping(df: DataFrame, key: str, start: str, end: str, chunks: int | None = None) -> DataFrame:
    """One row with the number of periods that overlap any earlier one of their key, in (start, end) order.

    Spread over chunks as in neighbours(), so one key may own any share of the rows. Each chunk hands on its latest end
    per key; a period is compared with the latest end before it, inside its chunk or in chunks before. The chunks are
    written to the shared folder, because both steps have to see the same ones.
    """
    periods = df.selectExpr(f"{key} as key", f"{start} as start", f"{end} as end").groupBy("key", "start", "end")
    ranged = periods.agg(F.expr("count(*) - 1 as copies")).repartitionByRange(*([chunks] if chunks else []), "key", "start", "end")
    dealt, folder = ranged.selectExpr("*", "spark_partition_id() as chunk"), new_folder(df.sparkSession, "periods")
    dealt.write.parquet(folder)
    dealt = df.sparkSession.read.schema(dealt.schema).parquet(folder)
    latest = dealt.groupBy("key", "chunk").agg(F.expr("max(end) as end"))
    earlier = "over (partition by key order by chunk rows between unbounded preceding and 1 preceding)"
    before = latest.selectExpr("key as k", "chunk as c", f"max(end) {earlier} as until_chunk")
    inside = "over (partition by chunk, key order by start, end rows between unbounded preceding and 1 preceding)"
    joined = dealt.selectExpr("*", f"max(end) {inside} as until").join(before, F.expr("key <=> k and chunk = c"))
    overlaps = "if(greatest(until, until_chunk) > start, 1, 0) + copies * if(end > start, 1, 0)"
    return joined.agg(F.expr(f"cast(coalesce(sum({overlaps}), 0) as bigint) as violations"))
