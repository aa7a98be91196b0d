"""Plain-typed copies of result frames, so that two engines can be compared value by value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierline.functions.expr import canonical_text


def _timestamp(c: str) -> str:
    # Text, because an open validity end (year 9999) does not fit the nanosecond clock of pandas.
    return f"date_format({c}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"


def _plain(name: str, dtype: T.DataType) -> list[str]:
    c = f"`{name}`"
    if isinstance(dtype, T.StructType):
        fields = [(f"{c}.{f.name}", f"{name}_{f.name}", f.dataType) for f in dtype.fields]
        return [f"{_timestamp(x) if isinstance(t, T.TimestampType) else x} as {alias}" for x, alias, t in fields]
    if isinstance(dtype, T.DecimalType):
        return [f"cast({c} as double) as {c}"]
    if isinstance(dtype, T.TimestampType):
        return [f"{_timestamp(c)} as {c}"]
    if isinstance(dtype, T.DateType):
        return [f"cast({c} as string) as {c}"]
    if isinstance(dtype, T.DayTimeIntervalType):
        parts = (("day", 86400), ("hour", 3600), ("minute", 60), ("second", 1))
        seconds = " + ".join(f"cast(extract({p} from {c}) as bigint) * {n}" for p, n in parts)
        return [f"{seconds} as {name}_seconds"]
    if isinstance(dtype, T.ArrayType):
        return [f"{canonical_text(c, 'int_array')} as {c}"]
    return [c]


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, timestamps, dates and arrays as text, intervals as seconds, structs flat."""
    return df.selectExpr(*[e for f in df.schema.fields for e in _plain(f.name, f.dataType)])
