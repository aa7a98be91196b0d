"""Lazy warehouse layers over the sample sources, for the registered queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import ts
from tierline.operators import cdc, merge, staging
from tierline.plans import checks, dims, facts, marts
from tierline.sources.sample import SampleSources
from tierline.sources.workspace import keeper

FIRST_LOAD = "2024-01-01 00:00:00"
SECOND_LOAD = "2024-02-01 00:00:00"
BATCH = {name: i + 1 for i, name in enumerate(ENTITIES)}
SECOND_BATCH = 100


class Frames(Mapping):
    """Frames by name, each built when it is asked for: who needs two tables does not wait for the others."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders

    def __getitem__(self, name: str) -> DataFrame:
        return self._builders[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class _Stored:
    """Tables written once to the shared folder, as a load leaves them behind; cuts the plans of their readers."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sources = SampleSources(spark, sf_dir)
        self.keep = keeper(spark, "layers")
        self._stored: dict[str, DataFrame] = {}

    def build(self, table: str) -> DataFrame:
        raise NotImplementedError

    def stored(self, table: str) -> DataFrame:
        if table not in self._stored:
            self._stored[table] = self.keep(table, self.build(table))
        return self._stored[table]


class FirstLoad(_Stored):
    """One full load of every entity, batch ids in load order."""

    at = property(lambda self: ts(FIRST_LOAD))

    def journal(self, name: str) -> DataFrame:
        return cdc.initial(self.sources.source(name), ENTITIES[name], BATCH[name], self.at)

    def staged(self, name: str) -> DataFrame:
        return staging.stage(self.journal(name), ENTITIES[name], self.at, BATCH[name])

    def ods(self, name: str) -> DataFrame:
        return merge.apply_stage(None, self.staged(name), ENTITIES[name], self.at)

    def build(self, table: str) -> DataFrame:
        """One DDS table out of ODS and the stored parents it looks keys up in, or the sales mart."""
        at, ods, dds = self.at, self.ods, self.stored
        plans = {
            "dim_airplanes": lambda: dims.dim_airplanes(None, ods("airplanes"), at),
            "dim_airports": lambda: dims.dim_airports(None, ods("airports"), at),
            "dim_routes": lambda: dims.dim_routes(None, ods("routes"), dds("dim_airports"), dds("dim_airplanes"), at),
            "dim_seats": lambda: dims.dim_seats(None, ods("seats"), dds("dim_airplanes"), at),
            "dim_passenger": lambda: dims.dim_passenger(None, ods("tickets"), at),
            "fact_flights": lambda: facts.fact_flights(None, ods("flights"), dds("dim_routes"), at),
            "fact_bookings": lambda: facts.fact_bookings(None, ods("bookings"), at),
            "fact_tickets": lambda: facts.fact_tickets(
                None, ods("tickets"), dds("fact_bookings"), dds("dim_passenger"), at
            ),
            "fact_segments": lambda: facts.fact_segments(
                None, ods("segments"), dds("fact_tickets"), dds("fact_flights"), at
            ),
            "fact_boarding_passes": lambda: facts.fact_boarding_passes(
                None, ods("boarding_passes"), dds("fact_tickets"), dds("fact_flights"), at
            ),
            "flight_sales_rows": self._sales_rows,
            "flight_sales_mart": lambda: marts.flight_sales(None, self.sales_rows()),
        }
        return plans[table]()

    def _sales_rows(self) -> DataFrame:
        parents = ("fact_tickets", "dim_passenger", "fact_bookings", "fact_flights", "dim_routes", "dim_airports")
        return marts.sales_rows(
            self.stored("fact_segments"), *[self.stored(t) for t in parents], self.stored("dim_airplanes"), self.at
        )

    def sales_rows(self) -> DataFrame:
        """Sales as a mart load takes them: joined anew, or as `keep_sales_rows` has written them."""
        return self._stored["flight_sales_rows"] if "flight_sales_rows" in self._stored else self._sales_rows()

    def keep_sales_rows(self) -> None:
        """For readers of two mart loads: the joins of all segments run once. The first mart is then cut from what is written, not written again."""
        if "flight_sales_mart" not in self._stored:
            self._stored["flight_sales_mart"] = marts.flight_sales(None, self.stored("flight_sales_rows"))

    def keep_line_items(self) -> None:
        """For readers of several tables that are aggregates of the line items: these are written once."""
        self.sources.keep = self.keep

    def sales(self) -> DataFrame:
        """The sales mart."""
        return self.stored("flight_sales_mart")


class TwoLoads(_Stored):
    """The earlier snapshot loaded as one batch, the later one as a delta on top of the first load.

    What one reader needs once is not stored, so that columns nobody asks for are never read. Rows are hashed behind the shuffle of the comparison.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.sources = SampleSources(spark, sf_dir, self.keep)

    first = property(lambda self: ts(FIRST_LOAD))
    second = property(lambda self: ts(SECOND_LOAD))

    def first_journal(self, name: str) -> DataFrame:
        return cdc.initial(self.sources.source(name, "before"), ENTITIES[name], BATCH[name], self.first)

    def second_journal(self, name: str) -> DataFrame:
        e = ENTITIES[name]
        before, after = (cdc.hashed(self.sources.source(name, s).repartition(*e.keys), e) for s in ("before", "after"))
        return cdc.delta(after, before, e, SECOND_BATCH, self.second)

    def journal(self, name: str) -> DataFrame:
        return self.first_journal(name).unionByName(self.stored(f"delta.{name}"))

    def first_ods(self, name: str) -> DataFrame:
        e = ENTITIES[name]
        return merge.apply_stage(None, staging.stage(self.first_journal(name), e, self.first, BATCH[name]), e, self.first)

    def ods(self, name: str) -> DataFrame:
        e, delta = ENTITIES[name], f"delta.{name}"
        journal = self._stored[delta] if delta in self._stored else self.second_journal(name)
        return merge.apply_stage(self.first_ods(name), staging.stage(journal, e, self.second, SECOND_BATCH), e, self.second)

    def first_dim_airplanes(self) -> DataFrame:
        return dims.dim_airplanes(None, self.first_ods("airplanes"), self.first)

    def dim_airplanes(self) -> DataFrame:
        return dims.dim_airplanes(self.stored("dds.first_dim_airplanes"), self.stored("ods.airplanes"), self.second)

    def dim_airports(self) -> DataFrame:
        first = dims.dim_airports(None, self.first_ods("airports"), self.first)
        return dims.dim_airports(first, self.stored("ods.airports"), self.second)

    def first_dim_seats(self) -> DataFrame:
        airplanes = self.stored("dds.first_dim_airplanes")
        return dims.dim_seats(None, self.first_ods("seats"), airplanes, self.first)

    def dim_seats(self) -> DataFrame:
        first, airplanes = self.stored("dds.first_dim_seats"), self.stored("dds.dim_airplanes")
        return dims.dim_seats(first, self.stored("ods.seats"), airplanes, self.second)

    def first_fact_bookings(self) -> DataFrame:
        return facts.fact_bookings(None, self.first_ods("bookings"), self.first)

    def fact_bookings(self) -> DataFrame:
        return facts.fact_bookings(self.stored("dds.first_fact_bookings"), self.stored("ods.bookings"), self.second)

    def build(self, table: str) -> DataFrame:
        layer, name = table.split(".")
        if layer in ("all", "after"):
            return self.sources.source(name, layer)
        if layer == "raw":
            return self.journal(name)
        if layer == "first_ods":
            return self.first_ods(name)
        if layer == "delta":
            return self.second_journal(name)
        if layer == "ods":
            return self.ods(name)
        if layer == "dq":
            return checks.all_checks(self.tables(), 1, self.second)
        return getattr(self, name)()

    def tables(self) -> Frames:
        """What the reconciliation checks read. Stored are the deltas, that journal and ODS share, and ODS, which checks and loads read; the others are read once."""
        found = {}
        for name in checks.ENTITY.values():
            found[f"source.{name}"] = lambda n=name: self.sources.source(n, "after")
            found[f"raw.{name}"] = lambda n=name: self.journal(n)
            found[f"ods.{name}"] = lambda n=name: self.stored(f"ods.{n}")
        for name in checks.KEYS:
            found[f"dds.{name}"] = getattr(self, name)
        return Frames(found)


_LOADS: dict[tuple, _Stored] = {}


def load_of(kind: type, spark: SparkSession, sf_dir: str):
    """One load per application and data folder: later queries read the tables the first one has written."""
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADS:
        _LOADS[key] = kind(spark, sf_dir)
    return _LOADS[key]
