"""The fifteen reconciliation checks and the report over their results."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.catalog import fixed_values as fv
from tierline.functions.expr import quoted
from tierline.operators.integrity import GAPS, OVERLAPS, per_key_periods

AMOUNT = "decimal(38,2)"
ABOUT = {c[0]: c for c in fv.CHECKS}
KEYS = {"dim_airplanes": ["airplane_code"], "dim_seats": ["airplane_code", "seat_no"], "fact_bookings": ["book_ref"]}
ENTITY = {"dim_airplanes": "airplanes", "dim_seats": "seats", "fact_bookings": "bookings"}


# --- Measures: one row per layer and object, one scan for all of its measures ----------------------------------------


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys; a composite key counts as a row value, so one with a NULL part still counts."""
    value = keys[0] if len(keys) == 1 else f"struct({', '.join(keys)})"
    return df.agg(F.expr(f"count(distinct {value}) as keys"))


def _counts(keys: list[str]) -> str:
    """Whether a group of a key counts as a distinct key."""
    return f"{keys[0]} is not null" if len(keys) == 1 else "true"


def journal_measures(journal: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys whose last event is not a delete. An aggregate per key: hot keys shrink before the shuffle."""
    last = journal.groupBy(*keys).agg(F.expr("max_by(operation_type, struct(batch_id, load_date)) as op"))
    return last.agg(F.expr(f"count_if(op <> 'D' and {_counts(keys)}) as keys"))


def live_measures(df: DataFrame, keys: list[str], live: str) -> DataFrame:
    """Of the rows that are live: distinct keys, duplicate or NULL keys, keys that occur twice, and the sum of amounts where there are any."""
    amounts = "total_amount" in df.columns
    sums = ["sum(total_amount) as total"] if amounts else []
    per_key = df.where(live).groupBy(*keys).agg(F.expr("count(*) as rows"), *[F.expr(e) for e in sums])
    null_part = " or ".join(f"{k} is null" for k in keys)
    measures = [
        f"count_if({_counts(keys)}) as keys",
        f"count_if(rows > 1 or {null_part}) as duplicates",
        "count_if(rows > 1) as twice",
        *(["coalesce(sum(total), 0) as total"] if amounts else []),
    ]
    return per_key.agg(*[F.expr(m) for m in measures])


def history_measures(dim: DataFrame, key: str) -> DataFrame:
    """Of a dimension with history, without stubs: distinct keys with a current version, keys with two, overlaps and gaps."""
    per_key = per_key_periods(dim, key, "valid_from", "valid_to", {"overlaps": OVERLAPS, "gaps": GAPS}, {"live": "is_current"})
    return per_key.agg(
        F.expr("count_if(live > 0 and key is not null) as keys"),
        F.expr("count_if(live > 1) as twice"),
        F.expr("coalesce(sum(overlaps), 0) as overlaps"),
        F.expr("coalesce(sum(gaps), 0) as gaps"),
    )


def without_stub(keys: list[str]) -> str:
    return "not (" + " and ".join(f"coalesce({k}, '') = '{fv.STUB_KEY}'" for k in keys) + ")"


def measures_of(layer: str, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row of measures of an object in a layer. Tables are named source.<entity>, raw.<entity>, ods.<entity> and dds.<object>."""
    keys, entity = KEYS[name], ENTITY[name]
    if layer == "source":
        return distinct_keys(tables[f"source.{entity}"], keys)
    if layer == "raw":
        return journal_measures(tables[f"raw.{entity}"], keys)
    if layer == "ods":
        return live_measures(tables[f"ods.{entity}"], keys, "not is_deleted")
    if name == "dim_airplanes":
        return history_measures(tables[f"dds.{name}"].where(without_stub(keys)), keys[0])
    return live_measures(tables[f"dds.{name}"], keys, f"not is_deleted and {without_stub(keys)}")


#: Measure of a check that compares with zero.
BROKEN = {"DUP-01": "duplicates", "DUP-02": "duplicates", "SCD2-01": "twice", "SCD2-02": "overlaps", "SCD2-03": "gaps"}


def sides(check_id: str) -> tuple[tuple[str, str, str] | None, tuple[str, str, str]]:
    """(layer, object, measure) of the expected value, None for zero, and of the value that is checked."""
    _, check_type, layer_from, layer_to, name, _ = ABOUT[check_id]
    if check_id in BROKEN:
        return None, ("dds", name, BROKEN[check_id])
    measure = "total" if check_type == "aggregate" else "keys"
    return (layer_from, name, measure), (layer_to, name, measure)


# --- Results --------------------------------------------------------------------------------------------------------


def results(check_ids: list[str], tables: Mapping[str, DataFrame], run_id: int, checked_at: str) -> DataFrame:
    """One result row per check, in the order given.

    Each table is read once, for all measures that the checks need of it. The one-row measures meet in a union and a tiny aggregate, so
    no join of any kind is planned.
    """
    needed: dict[tuple[str, str], list[str]] = {}
    for side in (side for i in check_ids for side in sides(i) if side):
        of_table = needed.setdefault(side[:2], [])
        of_table += [] if side[2] in of_table else [side[2]]
    tagged = []
    for (layer, name), measures in needed.items():
        pairs = ", ".join(f"'{layer}.{name}.{m}', cast({m} as {AMOUNT})" for m in measures)
        tagged.append(measures_of(layer, name, tables).selectExpr(f"stack({len(measures)}, {pairs}) as (m, v)"))
    values = reduce(DataFrame.unionByName, tagged).agg(F.expr("map_from_entries(collect_list(struct(m, v))) as v"))
    rows = ", ".join(_result(i, f"v['{'.'.join(src)}']" if src else f"cast(0 as {AMOUNT})", f"v['{'.'.join(dwh)}']") for i in check_ids for src, dwh in [sides(i)])
    about = "check_id, check_type, layer_from, layer_to, object_name, description, src_value, dwh_value"
    return values.selectExpr(f"inline(array({rows}))").selectExpr(
        *about.split(", "),
        f"cast(src_value - dwh_value as {AMOUNT}) as diff",
        "if(src_value = dwh_value, 'PASS', bad) as status",
        f"cast({run_id} as bigint) as run_id",
        f"{checked_at} as checked_at",
    )


def _result(check_id: str, src: str, dwh: str) -> str:
    texts = zip(("check_id", "check_type", "layer_from", "layer_to", "object_name", "description"), ABOUT[check_id])
    named = ", ".join(f"{quoted(t)} as {n}" for n, t in texts)
    bad = "WARN" if check_id == "SCD2-03" else "FAIL"
    return f"struct({named}, {src} as src_value, {dwh} as dwh_value, '{bad}' as bad)"


def check(check_id: str, tables: Mapping[str, DataFrame], run_id: int, checked_at: str) -> DataFrame:
    """One check."""
    return results([check_id], tables, run_id, checked_at)


def checks_of(object_name: str, tables: Mapping[str, DataFrame], run_id: int, checked_at: str) -> DataFrame:
    """All checks of one object."""
    return results([c[0] for c in fv.CHECKS if c[4] == object_name], tables, run_id, checked_at)


def all_checks(tables: Mapping[str, DataFrame], run_id: int, checked_at: str) -> DataFrame:
    return results([c[0] for c in fv.CHECKS], tables, run_id, checked_at)


# --- Report ---------------------------------------------------------------------------------------------------------

SEAM = "concat(layer_from, ' → ', layer_to)"
BY_STATUS = [f"count_if(status = '{s}') as {s.lower()}" for s in fv.CHECK_STATUSES]


def last_run(results: DataFrame) -> DataFrame:
    newest = results.agg(F.max("run_id"))
    return results.where(F.col("run_id") == newest.scalar())


def run_totals(results: DataFrame) -> DataFrame:
    """Checks, passes, failures and warnings per run."""
    return results.groupBy("run_id").agg(F.expr("count(*) as checks"), *[F.expr(e) for e in BY_STATUS])


def status_summary(results: DataFrame) -> DataFrame:
    counted = last_run(results).agg(F.expr("count(*) as total"), *[F.expr(e) for e in BY_STATUS])
    return counted.selectExpr("*", "cast(round(pass * 100 / nullif(total, 0), 0) as int) as pass_percent")


def coverage(results: DataFrame, by: str) -> DataFrame:
    """Checks per object_name or check_type, fewest first."""
    return last_run(results).groupBy(by).agg(F.expr("count(*) as checks")).orderBy("checks", by)


def seam_coverage(results: DataFrame) -> DataFrame:
    """Checks per layer seam, in layer order; seams without checks are left out."""
    known = ", ".join(quoted(s) for s in fv.SEAM_ORDER)
    return (
        last_run(results)
        .groupBy(F.expr(f"{SEAM} as seam"))
        .agg(F.expr("count(*) as checks"))
        .selectExpr("seam", "checks", f"array_position(array({known}), seam) as position")
        .where("position > 0")
        .orderBy("position")
    )


def details(results: DataFrame) -> DataFrame:
    """The detail table with values as grouped text."""
    return (
        last_run(results)
        .selectExpr(
            "check_id",
            "object_name",
            f"{SEAM} as seam",
            "check_type",
            "format_number(src_value, 0) as src_value",
            "format_number(dwh_value, 0) as dwh_value",
            "format_number(diff, 2) as diff",
            "status",
        )
        .orderBy("check_id")
    )
