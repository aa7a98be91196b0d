"""Tables of the warehouse: Parquet versions, bucketed by key, published through an append-only commit log.

Plain Parquet has no MERGE. A merge therefore reads the published version, joins, writes a new version next to it and
publishes that with one appended log row. A job that dies half-way leaves files nobody reads, and running it again
overwrites them.

A bucketed table has one folder a bucket and version, and a merge reads and writes only the buckets that its batch
touches: the log row names them, and the others stay where an earlier version has put them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions.expr import literal_frame
from tierline.sources.workspace import CODEC

# base: the version that last replaced the whole table. parts: buckets with rows in this version. gone: touched buckets that have none any more.
LOG_SCHEMA = (
    "seq bigint, table string, version bigint, path string, schema string, keys array<string>, buckets int, rows bigint,"
    " base bigint, parts array<int>, gone array<int>"
)
BUCKET = "_bucket"
EVENT_SCHEMA = "seq bigint, batch_id bigint, process_name string, status string, at timestamp, error_message string"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


@dataclass(frozen=True)
class Written:
    """Files that are written but not yet published."""

    table: str
    version: int
    path: str
    schema: str
    keys: tuple[str, ...]
    buckets: int
    metrics: dict[str, int]
    base: int = 0
    parts: tuple[int, ...] = ()
    gone: tuple[int, ...] = ()


class TableStore:
    """One writer per root; `new` starts an empty one.

    `buckets` should not be below spark.sql.shuffle.partitions, or joins shuffle again.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, new: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._name = "tl_" + hashlib.md5(self.root.encode()).hexdigest()[:10]
        self._published: dict[str, Written] = {}
        #: Of each bucketed table, the version that holds each of its buckets.
        self._live: dict[str, dict[int, int]] = {}
        self._declared: dict[str, set[str]] = {}
        #: Last version of forgotten tables: numbers are never used again.
        self._forgotten: dict[str, int] = {}
        self._batches: dict[str, set[int]] = {}
        self._seq = 0
        self._event_seq = 0
        if not new:
            self._load_log()
            self._event_seq = self._events().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]

    # --- Commit log -------------------------------------------------------------------------------------------------

    def _load_log(self) -> None:
        """The latest commit of each table, the version of each of its buckets and the batch numbers of each journal: the only state the driver keeps."""
        log = self.spark.read.schema(LOG_SCHEMA).json(f"{self.root}/_log")
        latest = "max_by(struct(version, path, schema, keys, buckets, rows, base), seq) as last"
        batches = "collect_set(version) filter (where `table` like 'journal.%') as batches"
        for r in log.groupBy("table").agg(F.expr(latest), F.expr(batches), F.max("seq").alias("seq")).collect():
            w = r["last"]
            w = Written(r["table"], w["version"], w["path"], w["schema"], tuple(w["keys"]), w["buckets"], {"rows": w["rows"]}, w["base"])
            self._seq = max(self._seq, r["seq"])
            if w.buckets < 0:
                self._forgotten[w.table] = w.version
                continue
            self._published[w.table] = w
            if w.table.startswith("journal."):
                self._batches[w.table] = set(r["batches"])
        moved = log.where("buckets > 0").selectExpr("seq", "table", "version", "inline(transform(concat(parts, gone), x -> struct(x as part, array_contains(parts, x) as filled)))")
        for r in moved.groupBy("table", "part").agg(F.expr("max_by(struct(version, filled), seq) as last")).collect():
            w = self._published.get(r["table"])
            if w and r["last"]["filled"] and r["last"]["version"] >= w.base:
                self._live.setdefault(r["table"], {})[r["part"]] = r["last"]["version"]

    def _remember(self, w: Written) -> None:
        if w.table.startswith("journal."):
            self._batches.setdefault(w.table, set()).add(w.version)
        if w.buckets < 0:
            self._published.pop(w.table, None)
            self._live.pop(w.table, None)
            self._forgotten[w.table] = w.version
            return
        if w.buckets:
            live = self._live.get(w.table, {}) if w.base != w.version else {}
            kept = {part: version for part, version in live.items() if part not in w.gone}
            self._live[w.table] = kept | dict.fromkeys(w.parts, w.version)
        self._published[w.table] = w

    def publish(self, *written: Written) -> None:
        """Makes a set of tables visible together: they share one appended file."""
        self._seq += 1
        rows = [
            (self._seq, w.table, w.version, w.path, w.schema, list(w.keys), w.buckets, w.metrics["rows"], w.base, list(w.parts), list(w.gone))
            for w in written
        ]
        literal_frame(self.spark, rows, LOG_SCHEMA).write.mode("append").json(f"{self.root}/_log")
        for w in written:
            self._remember(w)
            for name in self._declared.pop(w.table, ()):
                self.spark.sql(f"drop table if exists {name}")

    # --- Writing ----------------------------------------------------------------------------------------------------

    def _observed(self, df: DataFrame, metrics: Mapping[str, str]) -> tuple[DataFrame, Observation]:
        seen = Observation()
        counts = {"rows": "count(*)", **metrics}
        return df.observe(seen, *[F.expr(f"{m} as `{n}`") for n, m in counts.items()]), seen

    def bucket_of(self, keys: list[str]) -> str:
        """The bucket of a row, as Spark's bucketed files count it."""
        return f"pmod(hash({', '.join(keys)}), {self.buckets})"

    def touched(self, table: str, rows: DataFrame, keys: list[str]) -> list[int] | None:
        """The buckets of the table that rows fall into: no more numbers than there are buckets. None, for all of them, where the table
        does not exist, has no buckets or another number of them."""
        if not keys or not self.has_buckets(table):
            return None
        return sorted(r[0] for r in rows.selectExpr(f"{self.bucket_of(keys)} as b").distinct().collect())

    def write(
        self, table: str, df: DataFrame, keys: list[str] = (), metrics: Mapping[str, str] = {}, touched: list[int] | None = None
    ) -> Written:
        """Writes the next version. With keys it is bucketed and sorted by them.

        `df` must then already be distributed by the keys (a merge on them, or shuffled()), so that each bucket is
        one file. With `touched`, df holds all rows of these buckets and no others, and the rest of the table stays as it is.
        Counts are taken while writing, so they count what is written.
        """
        previous = self._published.get(table)
        version = (previous.version if previous else self._forgotten.get(table, 0)) + 1
        # Rows of one step are no version of a table.
        path = f"{self.root}/{table.replace('.', '/')}/{'step' if table.startswith('_staged.') else 'v'}={version}"
        seen_df, seen = self._observed(df, metrics)
        if not keys:
            seen_df.write.mode("overwrite").parquet(path, compression=CODEC)
            return Written(table, version, path, _ddl(df), (), 0, dict(seen.get), version)
        whole = touched is None or previous is None
        name = f"{self._name}_{table.replace('.', '_')}_write"
        self.spark.sql(f"drop table if exists {name}")
        placed = seen_df.selectExpr("*", f"{self.bucket_of(keys)} as {BUCKET}")
        writer = placed.write.format("parquet").mode("overwrite").partitionBy(BUCKET).bucketBy(self.buckets, *keys).sortBy(*keys)
        writer.option("path", path).option("compression", CODEC).saveAsTable(name)
        parts = tuple(sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"show partitions {name}").collect()))
        self.spark.sql(f"drop table {name}")
        gone = () if whole else tuple(sorted(set(touched) - set(parts)))
        return Written(table, version, path, _ddl(df), tuple(keys), self.buckets, dict(seen.get), version if whole else previous.base, parts, gone)

    def staged(self, name: str, df: DataFrame, metrics: Mapping[str, str] = {}) -> tuple[DataFrame, dict[str, int]]:
        """Rows of one step that are read several times, written once to a folder that the next such step overwrites; and counts of them."""
        path = f"{self.root}/_staged/{name.replace('.', '/')}"
        seen_df, seen = self._observed(df, metrics)
        seen_df.write.mode("overwrite").parquet(path, compression=CODEC)
        return self.spark.read.schema(_ddl(df)).parquet(path), dict(seen.get)

    def staged_by_key(self, name: str, df: DataFrame, keys: list[str], metrics: Mapping[str, str] = {}) -> tuple[DataFrame, Written]:
        """Rows of one step, written once as the next version of a bucketed table is, and read without a shuffle by a merge on its key.

        `df` must be distributed by the keys. The buckets that hold rows are known then without another pass over them.
        """
        table = f"_staged.{name}"
        for old in self._declared.pop(table, ()):
            self.spark.sql(f"drop table if exists {old}")
        written = self.write(table, df, keys, metrics)
        return self.read_bucketed(table, written), written

    def shuffled(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """Distributed the way a bucketed write needs it; keys are columns or expressions."""
        return df.repartition(self.buckets, *[F.expr(k) for k in keys])

    def write_batch(self, journal: str, df: DataFrame, batch_id: int, metrics: Mapping[str, str] = {}) -> Written:
        """Writes one batch of an append-only journal; a batch written again replaces its own files only."""
        table = f"journal.{journal}"
        path = f"{self.root}/journal/{journal}/batch_id={batch_id}"
        rows = df.drop("batch_id")
        seen_df, seen = self._observed(rows, metrics)
        seen_df.write.mode("overwrite").parquet(path, compression=CODEC)
        return Written(table, batch_id, path, _ddl(rows), (), 0, dict(seen.get))

    # --- Reading ----------------------------------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        return table in self._published

    def has_buckets(self, table: str) -> bool:
        """Whether the table can be merged bucket by bucket: it exists, with the number of buckets the store has."""
        return self.exists(table) and self._published[table].buckets == self.buckets

    def forget(self, *tables: str) -> None:
        """Published tables and marks that are to be as if they had never been; their next version is written whole."""
        self.publish(*[Written(t, self.version(t), "", "", (), -1, {"rows": 0}) for t in tables if self.exists(t)])

    def version(self, table: str) -> int:
        return self._published[table].version if table in self._published else 0

    def rows(self, table: str) -> int:
        return self._published[table].metrics["rows"] if table in self._published else 0

    def mark(self, name: str, version: int) -> Written:
        """A log entry without files, to publish how far a step has come."""
        return Written(name, max(version, self.version(name)), "", "", (), 0, {"rows": 0})

    def _places(self, table: str, written: Written | None, buckets: Iterable[int] | None) -> dict[int, int]:
        """The version that holds each bucket, of all or of some."""
        live = self._live.get(table, {})
        if written is not None:  # as it will be when published
            live = {b: v for b, v in live.items() if written.base != written.version and b not in written.gone}
            live |= dict.fromkeys(written.parts, written.version)
        return live if buckets is None else {b: live[b] for b in buckets if b in live}

    def changed_since(self, table: str, version: int) -> list[int]:
        """Buckets that later versions have written."""
        return sorted(b for b, v in self._live.get(table, {}).items() if v > version)

    def read(self, table: str, written: Written | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Published version, or some of its buckets, read as plain files: joins on other columns shuffle it and may split hot keys."""
        w = written or self._published[table]
        reader = self.spark.read.schema(w.schema)
        if not w.buckets:
            return reader.parquet(w.path)
        places, base = self._places(table, written, buckets), w.path.rsplit("/", 1)[0]
        versions = set(places.values())
        if versions == {w.version} and w.base == w.version and buckets is None:
            paths = [w.path]
        else:
            paths = [f"{base}/v={v}/{BUCKET}={b}" for b, v in sorted(places.items())]
        if not paths:
            return self.spark.createDataFrame([], w.schema)
        columns = [f"`{f.name}`" for f in T.StructType.fromDDL(w.schema).fields]
        return reader.option("basePath", base).parquet(*paths).selectExpr(*columns)

    def read_bucketed(self, table: str, written: Written | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Published version, or some of its buckets, with its bucketing declared, for merges on its key: this side is not shuffled."""
        w = written or self._published[table]
        if not w.buckets:
            return self.read(table, w)
        places = sorted(self._places(table, written, buckets).items())
        digest = hashlib.md5(repr(places).encode()).hexdigest()[:10]
        name = f"{self._name}_{table.replace('.', '_')}_v{w.version}_{digest}"
        if not self.spark.catalog.tableExists(name):
            keys, base, versions = ", ".join(f"`{k}`" for k in w.keys), w.path.rsplit("/", 1)[0], w.path.rsplit("=", 1)[0]
            self.spark.sql(
                f"create table {name} ({w.schema}, {BUCKET} int) using parquet partitioned by ({BUCKET})"
                f" clustered by ({keys}) sorted by ({keys}) into {w.buckets} buckets location '{base}/none'"
            )
            self._declared.setdefault(table, set()).add(name)
            for at in range(0, len(places), 500):
                found = " ".join(f"partition ({BUCKET} = {b}) location '{versions}={v}/{BUCKET}={b}'" for b, v in places[at : at + 500])
                self.spark.sql(f"alter table {name} add {found}")
        return self.spark.table(name).drop(BUCKET)

    def read_or_none(self, table: str, buckets: Iterable[int] | None = None) -> DataFrame | None:
        return self.read_bucketed(table, buckets=buckets) if self.exists(table) else None

    def batches(self, journal: str) -> list[int]:
        return sorted(self._batches.get(f"journal.{journal}", ()))

    def read_journal(self, journal: str, batch_id: int | None = None) -> DataFrame:
        """Published batches of a journal, read as one partitioned table, or one of them: then only its folder is listed."""
        w = self._published[f"journal.{journal}"]
        base = f"{self.root}/journal/{journal}"
        reader = self.spark.read.schema(w.schema + ", batch_id bigint").option("basePath", base)
        if batch_id is not None:
            return reader.parquet(f"{base}/batch_id={batch_id}")
        return reader.parquet(base).where(F.col("batch_id").isin(self.batches(journal)))

    # --- Retention --------------------------------------------------------------------------------------------------

    def remove_replaced(self) -> int:
        """Deletes the folders that no published version needs; returns how many.

        These are versions that were replaced or forgotten, replaced buckets of versions that are still needed, and rows staged for one step.
        Journals, logs, and versions that are written but not yet published stay, so a load that stopped half-way can be carried on.
        To be called between loads: frames that were read before a table was replaced find their files no more.
        """
        removed = 0
        for table in self._published.keys() | self._forgotten.keys():
            w = self._published.get(table)
            if w is not None and (not w.path or table.startswith("journal.")):
                continue
            live = self._live.get(table, {}) if w is not None else {}
            needed = {w.version, *live.values()} if w is not None else set()
            base = f"{self.root}/{table.replace('.', '/')}"
            for version in self._numbers(base, "v="):
                if version > self._last_version(table):
                    continue
                if version not in needed:
                    removed += self._delete(f"{base}/v={version}")
                    continue
                for part in self._numbers(f"{base}/v={version}", f"{BUCKET}=") if w.buckets else ():
                    if live.get(part) != version:
                        removed += self._delete(f"{base}/v={version}/{BUCKET}={part}")
        return removed + self._delete(f"{self.root}/_staged")

    def _last_version(self, table: str) -> int:
        return self.version(table) or self._forgotten.get(table, 0)

    def _place(self, folder: str):
        """A folder and the file system it is on, which may be any that Spark writes to."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        path, files = self._place(folder)
        names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
        return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())

    def _delete(self, folder: str) -> int:
        path, files = self._place(folder)
        return int(files.exists(path) and files.delete(path, True))

    # --- Batch log --------------------------------------------------------------------------------------------------

    def log_event(self, batch_id: int, process_name: str, status: str, at, error_message: str | None = None) -> None:
        """Appends one event of a batch. Events are never changed; the latest one is the state of the batch."""
        self._event_seq += 1
        row = [(self._event_seq, batch_id, process_name, status, at, error_message)]
        literal_frame(self.spark, row, EVENT_SCHEMA).write.mode("append").json(f"{self.root}/_batches")

    def _events(self) -> DataFrame:
        return self.spark.read.schema(EVENT_SCHEMA).json(f"{self.root}/_batches")

    def last_batch_id(self) -> int:
        return self._events().agg(F.max("batch_id")).first()[0] if self._event_seq else 0

    def load_batch(self) -> DataFrame:
        """One row per batch: process, status, start, end, error."""
        return (
            self._events()
            .groupBy("batch_id")
            .agg(
                F.expr("max_by(process_name, seq) as process_name"),
                F.expr("max_by(status, seq) as status"),
                F.expr("min(at) as started_at"),
                F.expr("max(at) filter (where status <> 'RUNNING') as finished_at"),
                F.expr("max_by(error_message, seq) as error_message"),
            )
        )
