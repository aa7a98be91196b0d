"""Joins in time: each row with the version of its key that is valid at a moment of the row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.expr import in_range, struct_of
from tierline.sources.workspace import new_folder

#: With no more versions of any key than this, a join on the key that compares each row with all of them is the cheaper plan.
FEW = 64
_OPEN = "timestamp_micros(9223372036854775807)"


def valid_at(
    rows: DataFrame, key: str, at: str, versions: DataFrame, version_key: str, period: str, how: str = "inner", few: int = FEW, chunks: int | None = None
) -> DataFrame:
    """Rows with the columns of each version whose half-open `period` holds their `at`; with how="left_anti", rows that no version holds.

    `version_key` and the other columns of versions must be named unlike those of rows. A NULL key, moment or period matches nothing; NULL bounds
    are open. Versions of a key are counted first. Where all keys have few, rows are joined with all versions of their key. Beyond that rows and
    starts of versions are sorted together, see _carried().
    """
    on = F.expr(f"{key} = {version_key} and {in_range(at, period)}")
    most = versions.groupBy(version_key).agg(F.expr("count(*) as n")).agg(F.max("n")).first()[0] or 0
    if most <= few:
        return rows.join(versions, on, how)
    met = _carried(rows, key, at, versions, version_key, period, chunks)
    # Where versions overlap, an earlier one may hold the moment as well: these rows alone meet all versions of their key.
    several = met.where("several").selectExpr("row.*").join(versions, on, how)
    if how == "left_anti":
        lost = rows.where(f"{key} is null or {at} is null")
        return several.unionByName(met.where("not several and version is null").selectExpr("row.*")).unionByName(lost)
    return several.unionByName(met.where("not several and version is not null").selectExpr("row.*", "version.*"))


def _carried(rows: DataFrame, key: str, at: str, versions: DataFrame, version_key: str, period: str, chunks: int | None) -> DataFrame:
    """(row, version, several): the version that started last before the moment, if it is still open then; and whether one that started earlier is.

    Rows and starts of versions are range-partitioned together by (key, moment), so that one key may own any share of them, and the version that
    started last is carried forward inside a chunk. What chunks hand on to later ones concerns only the first key of a chunk: no more rows
    than there are chunks, so they are broadcast. Each row is compared with one version, however many its key has. The chunks are written to the
    shared folder while the plan is built, because both steps have to see the same ones.
    """
    r, v = (struct_of(df.columns) for df in (rows, versions))
    until, started = f"coalesce({period}.upper, {_OPEN})", f"({period}.lower is null or {period}.upper is null or {period}.lower < {period}.upper)"
    starts = versions.where(f"{version_key} is not null and {period} is not null and {started}").selectExpr(
        f"{version_key} as key", f"{period}.lower as at", "0 as kind", f"xxhash64({v}) as salt", f"{until} as until", f"{v} as version"
    )
    moments = rows.where(f"{key} is not null and {at} is not null")
    moments = moments.selectExpr(f"{key} as key", f"{at} as at", "1 as kind", f"xxhash64({r}) as salt", f"{r} as row")
    order = ["key", "at", "kind", "salt"]
    dealt = starts.unionByName(moments, allowMissingColumns=True).repartitionByRange(*([chunks] if chunks else []), *order)
    dealt, folder = dealt.selectExpr("*", "spark_partition_id() as chunk"), new_folder(rows.sparkSession, "moments")
    dealt.write.parquet(folder)
    inside = "partition by chunk, key order by at, kind, salt rows between unbounded preceding and"
    dealt = rows.sparkSession.read.schema(dealt.schema).parquet(folder)
    dealt = dealt.selectExpr("*", f"max(until) over ({inside} 1 preceding) as reach")
    dealt = dealt.selectExpr("*", "if(kind = 0, struct(until, reach, version), null) as opened")
    ends = dealt.groupBy("key", "chunk").agg(
        F.expr("max(until) as most"), F.expr("max_by(opened, if(kind = 0, struct(at, salt), null)) as opened")
    )
    earlier = "over (partition by key order by chunk rows between unbounded preceding and 1 preceding)"
    seams = ends.selectExpr("*", f"max(most) {earlier} as before").selectExpr(
        "key", "chunk", "before", "if(opened is null, null, struct(opened.until, greatest(opened.reach, before) as reach, opened.version)) as opened"
    )
    seams = seams.selectExpr("key as k", "chunk as c", "before", f"last(opened, true) {earlier} as carried").where("before is not null")
    met = dealt.selectExpr("*", f"last(opened, true) over ({inside} current row) as here").where("kind = 1")
    met = met.join(F.broadcast(seams), F.expr("key = k and chunk = c"), "left")
    met = met.selectExpr("row", "at", "coalesce(here, carried) as open", "if(here is null, carried.reach, greatest(here.reach, before)) as reach")
    return met.selectExpr("row", "if(open.until > at, open.version, null) as version", "coalesce(reach > at, false) as several")
