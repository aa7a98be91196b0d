"""What a query does not return is not loaded, stored or shuffled for it."""

from __future__ import annotations

import re

import pytest

from tests.test_warehouse import Source
from tierline.operators import merge
from tierline.plans.warehouse import MARTS, Warehouse, built_from
from tierline.registry import queries
from tierline.registry.layers import Frames, TwoLoads
from tierline.sources.store import TableStore


def test_entities_and_marts_that_a_table_is_built_from():
    flights = ["airplanes", "airports", "routes", "flights"]
    assert built_from(["dds.fact_flights"]) == (flights, [])
    assert built_from(["dds.fact_bookings"]) == (["bookings"], [])
    assert set(built_from(["dds.fact_tickets"])[0]) == {"bookings", "tickets"}
    assert set(built_from(["dds.fact_boarding_passes"])[0]) == {*flights, "bookings", "tickets", "boarding_passes"}
    entities, marts = built_from(["dm.airport_traffic_daily"])
    assert set(entities) == {*flights, "bookings", "tickets", "segments"}
    assert marts == ["dm.flight_sales_mart", "dm.airport_traffic_daily"]
    assert built_from(MARTS)[1] == list(MARTS)


@pytest.mark.parametrize("table", ["dds.fact_tickets", "dm.airport_traffic_daily"])
def test_a_warehouse_of_one_table_has_the_rows_of_the_whole_one(spark, rows, tmp_path, table):
    source, found = Source(rows), []
    for name, tables in (("whole", None), ("one", [table])):
        w = Warehouse(spark, TableStore(spark, f"{tmp_path}/{name}", buckets=2, new=True), source, tables=tables)
        w.load_all()
        frame = w.store.read(table)
        found.append(sorted(map(str, frame.drop("last_changed_at", "mart_load_date").collect())))
        assert w.store.exists("dds.fact_boarding_passes") == w.store.exists("dds.dim_seats") == (tables is None)
    assert found[0] == found[1] and found[0]


def test_frames_are_built_when_asked_for():
    asked = []
    frames = Frames({n: lambda n=n: asked.append(n) or n for n in "abc"})
    assert frames["b"] == "b" and asked == ["b"] and len(frames) == 3


@pytest.fixture
def stored(monkeypatch):
    """Names of what TwoLoads writes, in a load of its own."""
    names, loads = [], {}

    def keep_noted(self, spark, sf_dir, init=TwoLoads.__init__):
        init(self, spark, sf_dir)
        write = self.keep
        self.keep = self.sources.keep = lambda name, rows: (name in names or names.append(name)) and False or write(name, rows)

    monkeypatch.setattr(TwoLoads, "__init__", keep_noted)
    monkeypatch.setattr(queries, "two", lambda s, d: loads.setdefault(d, TwoLoads(s, d)))
    return names


def test_a_check_of_bookings_stores_bookings_alone(spark, stored):
    assert queries.QUERIES["dq_agg_01"](spark, "/root/testdata/sf0.001").count() == 1
    assert set(stored) == {"ods.bookings", "dds.first_fact_bookings"}


def test_a_check_of_seats_reads_the_line_items_once(spark, stored):
    assert queries.QUERIES["dq_rc_06"](spark, "/root/testdata/sf0.001").count() == 1
    assert "seat_numbers" in stored and not [n for n in stored if "bookings" in n]


def test_counts_store_no_layer(spark, stored):
    assert queries.QUERIES["ods_counts"](spark, "/root/testdata/sf0.001").count() == 9
    assert set(stored) == {"seat_numbers", "order_parts"}


def test_a_merge_shuffles_no_column_that_nobody_reads(spark):
    frame = spark.range(9).selectExpr("cast(id as string) as k", "concat('wide', id) as wide", "id as batch_id")
    merged = merge.upsert(frame, frame.where("batch_id > 3"), ["k"], guard="t.batch_id < d.batch_id", checked=True)
    text = merged.select("k")._jdf.queryExecution().optimizedPlan().toString()
    assert "wide" not in text and sorted(r.k for r in merged.collect()) == [str(i) for i in range(9)]


def test_indexed_tables_hold_the_columns_of_their_indexes(spark):
    frames = queries.indexed_tables(spark, "/root/testdata/sf0.001")
    assert frames["segments"].columns == ["ticket_no", "flight_id"]
    assert frames["boarding_passes"].columns == ["ticket_no", "flight_id", "boarding_no", "seat_no"]
    assert not re.search("passenger_name", " ".join(frames["tickets"].columns))
