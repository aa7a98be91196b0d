"""What several operators share: tables in the shared folder, connected components, positions within groups, fixed hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.sources.workspace import new_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table written to the shared folder: lineage ends there, so that a lost executor costs a reread and no recomputation."""
    path = new_folder(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like `staged`, in one bucket file for each shuffle partition, sorted by the key: reads that group or join by it need no shuffle."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, f"llm-{name}")
    buckets, table = int(spark.conf.get("spark.sql.shuffle.partitions")), path.rsplit("/", 1)[-1].replace("-", "_")
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder. A null id is never held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))


def numbered(df: DataFrame, group: str, position: str) -> DataFrame:
    """Adds a position within each group, gapless from 0. `df` must be a staged table with the column `uid` from monotonically_increasing_id().

    A group may hold any share of the rows: rows are counted by (written part, group), the counts are summed up over the parts,
    and only rows of one part and group are sorted together.
    """
    df = df.withColumn("_part", F.shiftright("uid", 33))
    counts = df.groupBy("_part", group).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_part", group).orderBy("uid")) - 1
    ranked = df.withColumn("_rank", rank)
    same = [ranked[c].eqNullSafe(starts[c]) for c in ("_part", group)]
    joined = ranked.join(starts, same[0] & same[1])
    return joined.select(*[ranked[c] for c in df.columns if c != "_part"], (starts["_start"] + ranked["_rank"]).cast("long").alias(position))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable. Nodes are longs; loops and repeats are allowed.

    Alternating large and small stars: each round is two aggregates and two joins on links alone, written to the shared folder.
    A star's hub may hold any share of the links: its minimum is reduced on the map side and the join may be split by adaptive execution.
    The loop ends when a round changes nothing; the number of rounds grows with the logarithm of the longest chain.
    """
    links = staged(_down(edges, "a", "b"), "links")
    state = _state(links)
    while state[0]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _down(both.filter("v > u").join(least, "u").select("v", "m"), "v", "m")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = _down(joined.select("b", "m").union(joined.select("a", "m")), "b", "m")
        links = staged(small, "links")
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())


def _down(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.filter(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()


def _state(links: DataFrame) -> tuple:
    """Count and hash sum of distinct links: equal for equal sets."""
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
