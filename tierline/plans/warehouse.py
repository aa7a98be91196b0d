"""The stored warehouse: batches, loads per entity, the main load, and the check run."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.catalog import fixed_values as fv
from tierline.catalog.entities import ENTITIES, Entity
from tierline.functions.expr import ts
from tierline.operators import cdc, merge, staging
from tierline.plans import checks, dims, facts, marts
from tierline.sources.store import TableStore, Written
from tierline.sources.workspace import tidy

# Bucketing keys of the stored tables: the keys their merges join on. Routes are keyed by a range struct and small
# (one row per route and season), so they stay unbucketed.
DDS_KEYS = {
    "dim_airplanes": [],
    "dim_airports": [],
    "dim_routes": [],
    "dim_seats": ["airplane_code", "seat_no"],
    "dim_passenger": ["passenger_id"],
    "fact_flights": ["flight_id"],
    "fact_bookings": ["book_ref"],
    "fact_tickets": ["ticket_no"],
    "fact_segments": ["ticket_sk", "flight_sk"],
    "fact_boarding_passes": ["ticket_sk", "flight_sk"],
}
DDS_OF = {
    "airplanes": ["dim_airplanes"],
    "airports": ["dim_airports"],
    "routes": ["dim_routes"],
    "seats": ["dim_seats"],
    "flights": ["fact_flights"],
    "bookings": ["fact_bookings"],
    "tickets": ["dim_passenger", "fact_tickets"],
    "segments": ["fact_segments"],
    "boarding_passes": ["fact_boarding_passes"],
}
# Lookups that may leave a row out: (column of the ODS row, parent, its column, whether only current versions count).
LOOKUPS = {
    "dim_routes": [
        ("departure_airport", "dim_airports", "airport_code", True),
        ("arrival_airport", "dim_airports", "airport_code", True),
        ("airplane_code", "dim_airplanes", "airplane_code", True),
    ],
    "dim_seats": [("airplane_code", "dim_airplanes", "airplane_code", True)],
    "fact_flights": [("route_no", "dim_routes", "validity", False)],
    "fact_tickets": [("book_ref", "fact_bookings", "book_ref", False), ("passenger_id", "dim_passenger", "passenger_id", False)],
    "fact_segments": [("ticket_no", "fact_tickets", "ticket_no", False), ("flight_id", "fact_flights", "flight_id", False)],
    "fact_boarding_passes": [("ticket_no", "fact_tickets", "ticket_no", False), ("flight_id", "fact_flights", "flight_id", False)],
}
#: Tables whose lookups go by keys that the merge of the parent keeps unique, so that no row is found twice.
UNIQUE_PARENTS = ("fact_tickets", "fact_segments", "fact_boarding_passes")

SALES = "dm.flight_sales_mart"
MARTS = {SALES: marts.SALES_KEYS, "dm.flight_revenue_mart": ["flight_id"], "dm.airport_traffic_daily": marts.TRAFFIC_KEYS}
# The segments' parents, and theirs, are all that the sales mart looks up; the other marts are counted from it.
SALES_FACT = "fact_segments"


def built_from(tables: Iterable[str]) -> tuple[list[str], list[str]]:
    """Entities and marts, in load order, that the given ODS and DDS tables and marts are built from, themselves included."""
    tables = list(tables)
    found = {t for t in MARTS if t in tables}
    found |= {SALES} if found else set()
    entities, todo = set(), [SALES_FACT] if found else []
    todo += [t.removeprefix("dds.") if t.startswith("dds.") else DDS_OF[t.removeprefix("ods.")][-1] for t in tables if t not in MARTS]
    while todo:
        table = todo.pop()
        entity = next(e for e, of_entity in DDS_OF.items() if table in of_entity)
        if entity not in entities:
            entities.add(entity)
            todo += [parent for t in DDS_OF[entity] for _, parent, _, _ in LOOKUPS.get(t, ())]
    return [e for e in ENTITIES if e in entities], [t for t in MARTS if t in found]


def _bucket_keys(entity: Entity) -> list[str]:
    return [] if entity.name == "routes" else list(entity.keys)


@dataclass
class LoadReport:
    """Counts taken while writing, and seconds, by step. Of a batch that was staged: `staged` and `invalid` rows."""

    batch_id: int
    steps: dict[str, dict[str, int]] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def timed(self, step: str) -> Iterator[None]:
        started = time.perf_counter()
        yield
        self.seconds[step] = self.seconds.get(step, 0.0) + time.perf_counter() - started


class Warehouse:
    """`source` gives the current frame of an entity; `clock` the time of a load. `tables` limits the main load to these tables and marts and
    all that they are built from; a stored warehouse keeps the set it was begun with."""

    def __init__(
        self,
        spark: SparkSession,
        store: TableStore,
        source: Callable[[str], DataFrame],
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
        tables: Iterable[str] | None = None,
    ):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.store = store
        self.source = source
        self.clock = clock
        self.entities, self.marts = (list(ENTITIES), list(MARTS)) if tables is None else built_from(tables)
        self._batch_id = store.last_batch_id()

    def _now(self) -> str:
        return ts(self.clock())

    # --- Batches ----------------------------------------------------------------------------------------------------

    @contextmanager
    def batch(self, process_name: str) -> Iterator[int]:
        """RUNNING, then SUCCESS or FAILED. The failure is logged outside the failed work, so it stays on record."""
        self._batch_id += 1
        batch_id = self._batch_id
        self.store.log_event(batch_id, process_name, "RUNNING", self.clock())
        try:
            yield batch_id
        except Exception as e:
            self.store.log_event(batch_id, process_name, "FAILED", self.clock(), str(e))
            raise
        self.store.log_event(batch_id, process_name, "SUCCESS", self.clock())

    # --- RAW --------------------------------------------------------------------------------------------------------

    def _write_snapshot(self, entity: Entity, rows: DataFrame, touched: list[int] | None = None) -> list[Written]:
        """Source rows with their hashes, all or those of the touched buckets, and the digests of their buckets. Source keys are primary
        keys: a second row for one fails the batch here, before the comparison could multiply it. Rows are hashed behind the shuffle."""
        keys, table = _bucket_keys(entity), f"snapshot.{entity.name}"
        rows = cdc.hashed(self.store.shuffled(rows, keys) if keys else rows, entity).selectExpr("*", f"{self._now()} as last_seen_at")
        rows = merge.fail_on_second(rows, list(entity.keys), f"source {entity.name}")
        snap = self.store.write(table, rows, keys, touched=touched)
        if not keys:
            return [snap]
        # Of what was written, not of what was compared: the source may have moved in between.
        now = self.store.read(table, snap, buckets=None if touched is None else touched)
        fresh = cdc.digests(now.drop("last_seen_at"), self.store.bucket_of(keys))
        if touched is not None:
            known = self.store.read(f"digest.{entity.name}")
            fresh = known.where(~F.col("bucket").isin(touched)).unionByName(fresh)
        return [snap, self.store.write(f"digest.{entity.name}", fresh.coalesce(1))]

    def _touched_by_source(self, entity: Entity, source: DataFrame) -> list[int] | None:
        """Buckets in which the source differs from the last snapshot; None where there is none to compare bucket by bucket."""
        keys, table = _bucket_keys(entity), f"snapshot.{entity.name}"
        if not (keys and self.store.exists(table) and self.store.has_buckets(table)):
            return None
        now, known = (
            {r["bucket"]: (r["rows"], r["digest"]) for r in df.collect()}
            for df in (cdc.digests(source, self.store.bucket_of(keys)), self.store.read(f"digest.{entity.name}"))
        )
        return sorted(b for b in now.keys() | known.keys() if now.get(b) != known.get(b))

    def raw_initial(self, name: str) -> LoadReport:
        """Every source row as an insert; seeds the snapshot when there is none."""
        entity = ENTITIES[name]
        with self.batch(f"raw.load_{entity.source_object}_initial") as batch_id:
            snap, *digest = self._write_snapshot(entity, self.source(name))
            rows = self.store.read(snap.table, snap)
            inserted = cdc.journal_rows(rows, entity, batch_id, self._now(), "'I'")
            batch = self.store.write_batch(name, inserted, batch_id)
            seeded = [] if self.store.exists(snap.table) else [snap, *digest]
            self.store.publish(batch, *seeded)
        return LoadReport(batch_id, {"raw": {"rows": batch.metrics["rows"], "I": batch.metrics["rows"]}})

    def raw_delta(self, name: str) -> LoadReport:
        """Journals what changed since the last snapshot.

        Order-independent digests of the source's buckets are compared with those of the snapshot. Only buckets that differ are read
        again, written to the next snapshot version and compared row by row, without a shuffle, as both versions are bucketed
        alike; journal batch and new snapshot become visible together. An unchanged source writes no snapshot.
        """
        entity = ENTITIES[name]
        with self.batch(f"raw.load_{entity.source_object}_delta") as batch_id:
            source, table, keys = self.source(name), f"snapshot.{name}", _bucket_keys(entity)
            touched = self._touched_by_source(entity, cdc.hashed(source, entity))
            if touched is not None:
                source = source.where(F.expr(self.store.bucket_of(keys)).isin(touched)) if touched else source.limit(0)
            snap = [] if touched == [] else self._write_snapshot(entity, source, touched)
            current = self.store.read_bucketed(table, snap[0], buckets=touched) if snap else cdc.hashed(source, entity)
            if snap and self.store.exists(table):
                rows = cdc.delta(current, self.store.read_bucketed(table, buckets=touched), entity, batch_id, self._now())
            else:
                rows = cdc.journal_rows(current, entity, batch_id, self._now(), "'I'")
            by_operation = {op: f"count_if(operation_type = '{op}')" for op in fv.OPERATIONS}
            batch = self.store.write_batch(name, rows, batch_id, by_operation)
            self.store.publish(batch, *snap)
        return LoadReport(batch_id, {"raw": batch.metrics})

    # --- STAGE, ODS, DDS --------------------------------------------------------------------------------------------

    def staged(self, name: str, batch_id: int | None = None) -> DataFrame:
        """STAGE rows of one batch, by default the latest; cut from the journal, not stored."""
        if batch_id is None:
            batch_id = max(self.store.batches(name), default=None)
            if batch_id is None:
                raise ValueError(f"no batch_id found in the journal of {name}")
        return staging.stage(self.store.read_journal(name, batch_id), ENTITIES[name], self._now(), batch_id)

    def apply_to_ods(self, name: str, batch_id: int | None = None) -> dict[str, int]:
        entity, table = ENTITIES[name], f"ods.{name}"
        if batch_id is None:
            batch_id = max(self.store.batches(name), default=None)
        keys, staged, known = _bucket_keys(entity), self.staged(name, batch_id), self.store.has_buckets(table)
        bucket = self.store.bucket_of(keys) if known else "0"
        # One pass over the batch: its counts, and the buckets of the table that it touches.
        counts = staged.agg(
            F.expr("count(*) as staged"),
            F.expr("count_if(not is_valid) as invalid"),
            F.expr(f"collect_set({bucket}) filter (where is_valid) as touched"),
        ).first().asDict()
        touched = counts.pop("touched")
        applied = self.store.mark(f"applied.ods.{name}", batch_id)
        if self.store.exists(table) and not touched:
            self.store.publish(applied)
            return {"rows": 0, "deleted": 0} | counts
        touched = sorted(touched) if known else None
        # The one shuffle that the checks, the merge and the bucketed write need.
        staged = self.store.shuffled(staged, keys) if keys else staged
        rows = merge.apply_stage(self.store.read_or_none(table, touched), staged, entity, self._now())
        written = self.store.write(table, rows, keys, {"deleted": "count_if(is_deleted)"}, touched)
        self.store.publish(written, applied)
        return written.metrics | counts

    def waiting(self, table: str) -> DataFrame | None:
        """Keys of ODS rows that a load left out because a parent was missing; the next load tries them again."""
        return self.store.read(f"waiting.{table}") if self.store.exists(f"waiting.{table}") else None

    def _new_rows(self, table: str) -> DataFrame:
        """ODS rows that the table has not seen: read from the buckets that ODS has written since, and those of rows that wait."""
        name = next(e for e, tables in DDS_OF.items() if table in tables)
        ods, late = f"ods.{name}", self.waiting(table)
        if not self.store.exists(f"dds.{table}"):
            return dims.above_watermark(self.store.read(ods), None)
        buckets = None
        if self.store.has_buckets(ods):
            buckets = set(self.store.changed_since(ods, self.store.version(f"seen.{table}")))
            if self.store.rows(f"waiting.{table}"):
                buckets |= set(self.store.touched(ods, late, list(ENTITIES[name].keys)))
        return dims.above_watermark(self.store.read(ods, buckets=buckets), None, late, self.store.version(f"newest.{table}"))

    def _without_parent(self, table: str, found: int) -> DataFrame:
        """What load_dds is about to leave out: the rows it looks at, without a parent. Facts that look parents up by a key which merges
        keep unique leave none out where as many rows were found as are looked at."""
        entity = ENTITIES[next(e for e, tables in DDS_OF.items() if table in tables)]
        if table in UNIQUE_PARENTS and self._new_rows(table).count() == found:
            return self._new_rows(table).select(*entity.keys).limit(0)
        parents = []
        for column, parent, known, only_current in LOOKUPS[table]:
            frame = self.store.read(f"dds.{parent}")
            parents.append((column, frame.where("is_current") if only_current else frame, known))
        return facts.without_parent(self._new_rows(table), list(entity.keys), parents)

    def _batch_rows(self, table: str, now: str) -> DataFrame:
        """New ODS rows with the keys of their parents, dealt out by the key of the table; parents are read plain for the lookups."""
        rows, keys = self._new_rows(table), DDS_KEYS[table]

        def placed(found: DataFrame) -> DataFrame:
            return self.store.shuffled(found, keys)

        def placed_by_pair(found: DataFrame) -> DataFrame:
            return self.store.shuffled(found.drop(*keys), facts.BY_PAIR)

        def dds(name: str) -> DataFrame:
            return self.store.read(f"dds.{name}")

        build = {
            "dim_routes": lambda: dims.routes_batch(rows, dds("dim_airports"), dds("dim_airplanes"), now),
            "dim_seats": lambda: placed(dims.seats_batch(rows, dds("dim_airplanes"), now)),
            "dim_passenger": lambda: placed(dims.passengers_batch(rows, now)),
            "fact_flights": lambda: facts.flights_batch(rows, dds("dim_routes"), now, placed),
            "fact_bookings": lambda: facts.bookings_batch(rows, now, placed),
            "fact_tickets": lambda: facts.tickets_batch(rows, dds("fact_bookings"), dds("dim_passenger"), now, placed),
            "fact_segments": lambda: facts.segments_batch(rows, dds("fact_tickets"), dds("fact_flights"), now, placed_by_pair),
            "fact_boarding_passes": lambda: facts.boarding_passes_batch(rows, dds("fact_tickets"), dds("fact_flights"), now, placed_by_pair),
        }
        return build[table]()

    def _load_history(self, table: str, now: str) -> list[Written]:
        ods, load = {"dim_airplanes": ("airplanes", dims.dim_airplanes), "dim_airports": ("airports", dims.dim_airports)}[table]
        rows = load(self.store.read_or_none(f"dds.{table}"), self.store.read(f"ods.{ods}"), now)
        return [self.store.write(f"dds.{table}", rows, DDS_KEYS[table], {"current": "count_if(is_current)"})]

    def _load_merged(self, table: str, now: str) -> list[Written]:
        """The batch merged into the buckets it touches; how far ODS is read then, and what waits for a parent.

        The batch is dealt out by its keys once. A first load is written as it is then; later ones are staged, bucketed as the target is, because
        a merge has to know their buckets before it reads those of the target.
        """
        keys, target, how = DDS_KEYS[table], f"dds.{table}", (dims.MERGE | facts.MERGE)[table]
        name = next(e for e, tables in DDS_OF.items() if table in tables)
        first, batch = not self.store.exists(target), self._batch_rows(table, now)
        metrics = {"newest": "coalesce(max(batch_id), 0)"}
        if "is_deleted" in batch.columns:
            metrics["deleted"] = "count_if(is_deleted)"
        if first:
            rows = merge.upsert(None, batch, **how)
            written = [self.store.write(target, rows, keys, metrics)]
            newest, found = written[0].metrics["newest"], written[0].metrics["rows"]
        else:
            if keys:
                batch, staged = self.store.staged_by_key(f"batch.{table}", batch, keys, metrics)
                counts, touched = staged.metrics, list(staged.parts) if self.store.has_buckets(target) else None
            else:
                batch, counts = self.store.staged(f"batch.{table}", batch, metrics)
                touched = None
            newest, found, written = counts["newest"], counts["rows"], [replace(self.store.mark(f"empty.{table}", 0), metrics=counts)]
            if counts["rows"]:
                rows = merge.upsert(self.store.read_or_none(target, touched), batch, **how)
                written = [self.store.write(target, rows, keys, metrics, touched)]
        for w in written:
            w.metrics.pop("newest", None)
        if table in LOOKUPS:
            written.append(self.store.write(f"waiting.{table}", self._without_parent(table, found)))
            written[0].metrics["waiting"] = written[1].metrics["rows"]
        seen = self.store.mark(f"seen.{table}", self.store.version(f"ods.{name}"))
        return [*written, self.store.mark(f"newest.{table}", newest), seen]

    def load_dds(self, table: str, *marks: Written) -> dict[str, int]:
        load = self._load_history if table in ("dim_airplanes", "dim_airports") else self._load_merged
        written = load(table, self._now())
        self.store.publish(*written, *marks)
        return written[0].metrics

    def load_entity(self, name: str) -> LoadReport:
        """RAW delta, STAGE, ODS, DDS. Without changes it stops after RAW, unless rows wait for a parent.

        Batches an earlier, interrupted run journaled but did not carry on are applied first, in order; so is a DDS load
        it did not finish.
        """
        started = time.perf_counter()
        report = self.raw_delta(name)
        report.seconds["raw"] = time.perf_counter() - started
        waiting = [b for b in self.store.batches(name) if b > self.store.version(f"applied.ods.{name}")]
        unfinished = self.store.version(f"applied.dds.{name}") < self.store.version(f"applied.ods.{name}")
        done = self.store.mark(f"applied.dds.{name}", report.batch_id)
        late = any(self.store.rows(f"waiting.{t}") for t in DDS_OF[name])
        if report.steps["raw"]["rows"] == 0 and waiting == [report.batch_id] and not unfinished and not late:
            self.store.publish(self.store.mark(f"applied.ods.{name}", report.batch_id), done)
            return report
        for batch_id in waiting:
            with report.timed("ods"):
                counts = self.apply_to_ods(name, batch_id)
            found = report.steps.get("ods", {})
            report.steps["ods"] = counts | {c: found.get(c, 0) + counts[c] for c in ("staged", "invalid")}
        *others, last = DDS_OF[name]
        for table in others:
            with report.timed(table):
                report.steps[table] = self.load_dds(table)
        with report.timed(last):
            report.steps[last] = self.load_dds(last, done)
        return report

    # --- Marts, main load, checks -----------------------------------------------------------------------------------

    def load_marts(self) -> dict[str, dict[str, int]]:
        """Sales of changed segments merged into the sales mart; flights and airport days that they concern counted anew in the other two.

        Rows of deleted facts stay in the sales mart, as the model has it; `load_marts` after `forget_marts` builds all three from scratch.
        """
        dds = {t: self.store.read(f"dds.{t}") for t in DDS_KEYS if self.store.exists(f"dds.{t}")}
        sales, newest, keys = SALES, self.store.version("newest.sales"), marts.SALES_KEYS
        parents = [dds[t] for t in ("fact_tickets", "dim_passenger", "fact_bookings", "fact_flights", "dim_routes", "dim_airports", "dim_airplanes")]
        tickets, passengers, bookings, flights, *others = parents
        segments, first = dds[SALES_FACT].select(*marts.SEGMENT_COLUMNS), not self.store.exists(sales)
        done = self.store.mark("applied.marts", self._dds_state())
        if not first:
            segments, counts = self.store.staged("marts.segments", marts.changed_segments(segments, tickets, bookings, flights, *others, newest))
            if not counts["rows"]:
                self.store.publish(done)
                return {t: {"rows": 0} for t in self.marts}
            tickets = marts.only_parents_of(segments, tickets, "ticket_sk", counts["rows"], tickets.count())
            flights = marts.only_parents_of(segments, flights, "flight_sk", counts["rows"], flights.count())
        rows = marts.sales_rows(segments, tickets, passengers, bookings, flights, *others, self._now())
        rows = rows.where(f"source_max_batch_id > {newest}")
        metrics = {"newest": "coalesce(max(source_max_batch_id), 0)"}
        if first:
            written = [self.store.write(sales, self.store.shuffled(merge.upsert(None, rows, keys, checked=True), keys), keys, metrics)]
            whole = self.store.read(sales, written[0])
            groups = dict.fromkeys(t for t in self.marts if t != sales)
        else:
            batch, staged = self.store.staged_by_key("marts.sales", self.store.shuffled(rows, keys), keys)
            touched = list(staged.parts) if self.store.has_buckets(sales) else None
            before = self.store.read_or_none(sales, touched)
            written = [self.store.write(sales, merge.upsert(before, batch, keys, checked=True), keys, metrics, touched)]
            whole = self.store.read(sales, written[0])
            replaced = before.join(batch.select(*keys), keys, "left_semi").select(*batch.columns)
            groups = {
                "dm.flight_revenue_mart": lambda: batch.select("flight_id").distinct(),
                "dm.airport_traffic_daily": lambda: marts.days_of(batch.unionByName(replaced)),
            }
            groups = {t: of_table() for t, of_table in groups.items() if t in self.marts}
        for table, of_table in groups.items():
            if of_table is not None:
                of_table, _ = self.store.staged(f"groups.{table}", of_table)
            written.append(self._count_anew(table, whole, of_table))
        mark = self.store.mark("newest.sales", max(newest, written[0].metrics.pop("newest")))
        self.store.publish(*written, mark, done)
        return {w.table: w.metrics for w in written}

    def _count_anew(self, table: str, sales: DataFrame, groups: DataFrame | None) -> Written:
        """An aggregate mart from all sales, or with the rows of some groups counted anew from the sales of those."""
        keys = MARTS[table]
        if table == "dm.airport_traffic_daily":
            fresh = marts.airport_traffic(sales, groups)
        else:
            fresh = marts.flight_revenue(sales if groups is None else sales.join(groups, keys, "left_semi"))
        touched = None if groups is None else self.store.touched(table, groups, keys)
        if groups is not None:
            fresh = merge.replace_groups(self.store.read(table, buckets=touched), groups, fresh, keys)
        return self.store.write(table, self.store.shuffled(fresh, keys), keys, touched=touched)

    def forget_marts(self) -> None:
        """The next load of the marts builds them from scratch: sales of facts deleted since are not in them any more."""
        self.store.forget(*MARTS, "newest.sales", "applied.marts")

    def remove_replaced(self) -> int:
        """Deletes files of replaced versions, see TableStore.remove_replaced(); between loads only."""
        return self.store.remove_replaced()

    def _dds_state(self) -> int:
        """Grows with every version of a DDS table, so the marts know whether they have seen the latest."""
        return sum(self.store.version(f"dds.{t}") for t in DDS_KEYS)

    def load_all(self) -> dict[str, LoadReport]:
        """All entities in key order, then the marts, unless no DDS table has changed since they were loaded. An entity that is left out keeps
        its batch number, so rows carry the numbers of a whole load."""
        with tidy(self.spark):
            reports = {}
            for name in ENTITIES:
                if name in self.entities:
                    reports[name] = self.load_entity(name)
                else:
                    self._batch_id += 1
            marts_report = LoadReport(self._batch_id)
            if self.marts and self.store.version("applied.marts") < self._dds_state():
                with marts_report.timed("marts"):
                    marts_report.steps = self.load_marts()
        return reports | {"marts": marts_report}

    def run_checks(self, object_name: str | None = None) -> DataFrame:
        """One run of the fifteen checks, or of those of one object, appended to the results; returns the rows of this run."""
        run_id = max(self.store.batches("pmi_results"), default=0) + 1
        tables = {}
        for name in checks.ENTITY.values():
            tables[f"source.{name}"] = self.source(name)
            tables[f"raw.{name}"] = self.store.read_journal(name)
            tables[f"ods.{name}"] = self.store.read(f"ods.{name}")
        for name in checks.KEYS:
            tables[f"dds.{name}"] = self.store.read(f"dds.{name}")
        run = (run_id, self._now())
        rows = checks.checks_of(object_name, tables, *run) if object_name else checks.all_checks(tables, *run)
        self.store.publish(self.store.write_batch("pmi_results", rows.withColumnRenamed("run_id", "batch_id"), run_id))
        return self.check_results().where(f"run_id = {run_id}")

    def check_results(self) -> DataFrame:
        return self.store.read_journal("pmi_results").withColumnRenamed("batch_id", "run_id")
