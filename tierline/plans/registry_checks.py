"""The source dictionary, constraint and index registries as frames, and their evaluation on real source frames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.catalog import fixed_values as fv
from tierline.operators.integrity import broken_rules, duplicate_keys, orphans, overlapping
from tierline.functions.expr import literal_frame, packed_key, ts

FAR_PAST = "0001-01-01 00:00:00"


def _frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    full = [(fv.SOURCE_SYSTEM, fv.SOURCE_SCHEMA, *row) for row in rows]
    return literal_frame(spark, full, "source_system string, source_schema string, " + schema)


def source_dictionary(spark: SparkSession) -> DataFrame:
    rows = [(obj, "table", column, kind, nullable, text) for obj, column, kind, nullable, text in fv.DICTIONARY]
    return _frame(
        spark,
        rows,
        "object_name string, object_type string, column_name string, data_type string, is_nullable string, description string",
    )


def source_constraints(spark: SparkSession) -> DataFrame:
    return _frame(
        spark,
        fv.CONSTRAINTS,
        "table_name string, constraint_name string, constraint_type string, columns string, referenced_table string,"
        " referenced_columns string, rule_expression string, description string",
    )


def source_indexes(spark: SparkSession) -> DataFrame:
    return _frame(
        spark,
        fv.INDEXES,
        "table_name string, index_name string, index_type string, columns string, is_unique boolean, description string",
    )


def _split(columns: str) -> list[str]:
    return [c.strip() for c in columns.split(",")]


def null_profile(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Per dictionary column: rows, NULLs, and whether its NOT NULL rule holds. One scan per source table."""
    parts = []
    for name, df in sources.items():
        declared = {col: null for obj, col, _, null, _ in fv.DICTIONARY if obj == name and col is not None}
        counted = df.agg(
            F.expr("count(*) as n"), *[F.expr(f"count_if(`{c}` is null) as `null_{c}`") for c in declared]
        )
        cells = ", ".join(f"'{c}', {'true' if null else 'false'}, `null_{c}`" for c, null in declared.items())
        parts.append(
            counted.selectExpr(
                f"'{name}' as object_name",
                "n as rows",
                f"stack({len(declared)}, {cells}) as (column_name, not_null, null_rows)",
            )
        )
    profile = reduce(DataFrame.unionByName, parts)
    return profile.selectExpr("*", "not not_null or null_rows = 0 as holds")


def _rule_sql(rule: str) -> str:
    """Value sets in the source registry are written without quotes: status in (On Time, ...)."""
    if " in (" not in rule or "'" in rule:
        return rule
    column, values = rule.rstrip(")").split(" in (")
    return f"{column} in ({', '.join(repr(v) for v in _split(values))})"


def _narrow(*sides: tuple[DataFrame, list[str]]) -> list[DataFrame]:
    """The columns alone of one frame, or of two whose columns are compared in this order. Surrogate keys are packed on all sides: equal where the
    texts are, in less than half the bytes for whoever only counts them."""
    types = [dict(df.dtypes) for df, _ in sides]
    packed = [all(c.endswith("_sk") and t[c] == "string" for t, c in zip(types, place)) for place in zip(*[columns for _, columns in sides])]
    return [
        df.selectExpr(*[f"{packed_key(f'`{c}`')} as `{c}`" if p else f"`{c}`" for c, p in zip(columns, packed)]) for df, columns in sides
    ]


def constraint_violations(tables: Mapping[str, DataFrame], constraints: list[tuple] = fv.CONSTRAINTS) -> DataFrame:
    """Violations of every listed constraint, by default those of the source tables; frames are keyed by table name.

    A rule on a UNIQUE constraint limits it to the rows the rule holds for.
    """
    parts = []
    checks: dict[str, dict[str, str]] = {}
    for table, name, kind, columns, parent, parent_columns, rule, _ in constraints:
        df, cols = tables[table], _split(columns)
        if kind == "CHECK":
            checks.setdefault(table, {})[name] = _rule_sql(rule)
            continue
        if kind in ("PRIMARY KEY", "UNIQUE"):
            limited = df.where(rule) if rule else df
            twice = duplicate_keys(*_narrow((limited, cols)), cols, nulls_are_bad=kind == "PRIMARY KEY")
            found = twice.agg(F.expr("count(*) as violations"))
        elif kind == "FOREIGN KEY":
            parent_cols = _split(parent_columns)
            children, parents = _narrow((df, cols), (tables[parent], parent_cols))
            bad = orphans(children, cols, parents, parent_cols)
            found = bad.agg(F.expr("coalesce(sum(rows), 0) as violations"))
        else:
            key, period = cols
            low = f"coalesce({period}.lower, {ts(FAR_PAST)})"
            high = f"coalesce({period}.upper, {ts(fv.OPEN_END)})"
            found = overlapping(df, key, low, high)
        parts.append(
            found.selectExpr(
                f"'{table}' as table_name", f"'{name}' as constraint_name", f"'{kind}' as constraint_type", "violations"
            )
        )
    for table, rules in checks.items():
        counted = broken_rules(tables[table], rules)
        parts.append(
            counted.selectExpr(
                f"'{table}' as table_name", "rule as constraint_name", "'CHECK' as constraint_type", "violations"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def unique_btree_columns(table: str) -> list[list[str]]:
    """The columns of each unique btree index of a table."""
    return [_split(columns) for of_table, _, kind, columns, unique, _ in fv.INDEXES if of_table == table and unique and kind == "btree"]


def unique_index_violations(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that occur twice under each registered unique btree index."""
    parts = []
    for table, name, kind, columns, unique, _ in fv.INDEXES:
        if not unique or kind != "btree":
            continue
        twice = duplicate_keys(sources[table], _split(columns), nulls_are_bad=False)
        counted = twice.agg(F.expr("count(*) as violations"))
        parts.append(counted.selectExpr(f"'{table}' as table_name", f"'{name}' as index_name", "violations"))
    return reduce(DataFrame.unionByName, parts)
