"""SQL expressions shared by all layers: canonical text, row hash, surrogate keys, range tests.

Expressions are SQL text for selectExpr and expr: one call to the JVM per expression, whatever its size, where a tree of
Column calls makes dozens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column kind -> Spark type. Kinds carry the source meaning (json, point, range) that a Spark type alone does not.
SPARK_TYPE = {
    "text": "string",
    "int": "int",
    "decimal": "decimal(10,2)",
    "bool": "boolean",
    "timestamp": "timestamp",
    "time": "string",
    "json": "string",
    "interval": "interval day to second",
    "range": "struct<lower:timestamp,upper:timestamp>",
    "int_array": "array<int>",
    "point": "struct<lon:double,lat:double>",
}


def quoted(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ts(value: str | datetime) -> str:
    """A timestamp literal; text is read in the session zone (UTC)."""
    if isinstance(value, datetime):
        value = value.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return f"timestamp'{value}'"


def struct_of(columns: Iterable[str], prefix: str = "") -> str:
    return "struct(" + ", ".join(f"{prefix}`{c}`" for c in columns) + ")"


def canonical_text(c: str, kind: str) -> str:
    """Text form of a value, fixed per kind so that hashes do not depend on engine or session settings (zone: UTC)."""
    if kind == "timestamp":
        return f"concat(cast({c} as string), '+00')"
    if kind == "range":
        low, high = (canonical_text(f"{c}.{b}", "timestamp") for b in ("lower", "upper"))
        # An open bound is written as nothing, a closed one in quotes.
        return (
            f"case when {c} is not null then concat(coalesce(concat('[\"', {low}, '\"'), '('), ',',"
            f" coalesce(concat('\"', {high}, '\"'), ''), ')') end"
        )
    if kind == "interval":
        seconds = f"extract(second from {c})"
        return (
            f"case when {c} is not null then concat(format_string('%02d:%02d:%02d',"
            f" cast(extract(day from {c}) * 24 + extract(hour from {c}) as int),"
            f" cast(extract(minute from {c}) as int), cast({seconds} as int)),"
            f" regexp_replace(cast({seconds} as string), '^[0-9]+|[.]?0+$', '')) end"
        )
    if kind == "json":
        # Key order and blanks of the source text must not change the hash; types, arrays and nesting must. Text that is
        # no JSON stands for itself.
        return f"coalesce(to_json(try_parse_json({c})), {c})"
    if kind == "int_array":
        return f"concat('{{', array_join(cast({c} as array<string>), ',', 'NULL'), '}}')"
    if kind == "point":
        return f"concat('(', cast({c}.lon as string), ',', cast({c}.lat as string), ')')"
    return f"cast({c} as string)"


def row_hash(columns: Iterable[tuple[str, str]]) -> str:
    """md5 over the '|'-joined canonical texts of (column, kind) pairs; NULL and '' hash alike."""
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({canonical_text(c, k)}, '')" for c, k in columns) + "))"


def surrogate_key(*parts: str) -> str:
    """Deterministic key: md5 of the '|'-joined parts in 8-4-4-4-12 form. Any NULL part gives NULL."""
    digest = "md5(concat(" + ", '|', ".join(f"cast({p} as string)" for p in parts) + "))"
    return _hyphened(lambda first, n: f"substr({digest}, {first}, {n})")


def _hyphened(letters: Callable[[int, int], str]) -> str:
    """Groups of letters in 8-4-4-4-12 form, each given as (first, number); NULL stays NULL. Cheaper than to put the hyphens in one by one."""
    return "concat(" + ", '-', ".join(letters(*group) for group in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")"


_OTHER = "00" * 17


def packed_key(key: str) -> str:
    """A surrogate key in the 16 bytes it stands for instead of 36, for joins that only compare it.

    Any other text keeps its bytes behind 17 zeros, so no two keys are packed alike; NULL stays NULL.
    """
    plain = f"{key} rlike '^[0-9a-f]{{8}}-([0-9a-f]{{4}}-){{3}}[0-9a-f]{{12}}\\\\z'"
    return f"if({plain}, unhex(replace({key}, '-', '')), concat(unhex('{_OTHER}'), cast({key} as binary)))"


def unpacked_key(packed: str) -> str:
    """The text of a packed key."""
    digest = _hyphened(lambda first, n: f"hex(substr({packed}, {(first + 1) // 2}, {n // 2}))")
    return f"if(length({packed}) = 16, lower({digest}), cast(substr({packed}, 18) as string))"


def version_stamp(effective_at: str) -> str:
    """UTC text of a version start with microseconds, the second part of a history key."""
    return f"date_format({effective_at}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"


def in_range(at: str, rng: str) -> str:
    """`at` lies in the half-open range [lower, upper); a NULL bound is open."""
    return (
        f"({rng} is not null and ({rng}.lower is null or {at} >= {rng}.lower)"
        f" and ({rng}.upper is null or {at} < {rng}.upper))"
    )


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows as literals in the plan: no Python worker is started to produce them."""
    fields = T.StructType.fromDDL(schema).fields

    def cell(value, f: T.StructField) -> Column:
        c = F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)
        return c.cast(f.dataType).alias(f.name)

    structs = [F.struct(*[cell(v, f) for v, f in zip(row, fields)]) for row in rows]
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*structs)))
