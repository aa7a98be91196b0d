"""Dimensions and facts on hand-made ODS rows."""

from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import SPARK_TYPE, ts
from tierline.plans import dims, facts

NOW, THEN = ts("2024-01-01"), ts("2024-02-01")
JAN, FEB, MAR = at("2024-01-01"), at("2024-02-01"), at("2024-03-01")
HOUR = timedelta(hours=1)


@pytest.fixture
def ods(spark):
    def build(entity, *rows, batch=1, deleted=()):
        """ODS rows; `deleted` lists first-column values of soft-deleted rows."""
        e = ENTITIES[entity]
        schema = ", ".join(f"`{c.name}` {SPARK_TYPE[c.kind]}" for c in e.stage)
        df = spark.createDataFrame([tuple(r) for r in rows], schema)
        gone = F.col(e.stage_names[0]).isin(*deleted) if deleted else F.lit(False)
        return df.selectExpr(
            "*", "'sys' as source_system", "'src' as record_source", f"cast({batch} as bigint) as updated_batch_id"
        ).withColumn("is_deleted", gone)

    return build


@pytest.fixture
def airplanes(ods):
    return dims.dim_airplanes(None, ods("airplanes", ("P1", "a", "b", 1, 1), ("P2", "a", "b", 1, 1)), NOW)


@pytest.fixture
def airports(ods):
    spot = (1.0, 2.0)
    rows = [(c, *"abcdef", spot, "UTC") for c in ("AAA", "BBB")]
    return dims.dim_airports(None, ods("airports", *rows), NOW)


def route(no, lower, upper, dep="AAA", arr="BBB", plane="P1"):
    return (no, (lower, upper), dep, arr, plane, [1], "11:00:00", HOUR)


@pytest.fixture
def routes(ods, airports, airplanes):
    return dims.dim_routes(None, ods("routes", route("R1", JAN, FEB), route("R1", FEB, MAR)), airports, airplanes, NOW)


def flight(n, departure, no="R1"):
    return (n, no, "Scheduled", departure, departure + HOUR, None, None)


def test_routes_need_current_parents(ods, airports, airplanes):
    rows = [route("R1", JAN, FEB), route("R2", JAN, FEB, arr="ZZZ"), route("R3", JAN, FEB, plane="P9")]
    got = dims.dim_routes(None, ods("routes", *rows), airports, airplanes, NOW).collect()
    assert [r.route_no for r in got] == ["R1"]
    closed = airplanes.withColumn("is_current", F.lit(False))
    assert dims.dim_routes(None, ods("routes", rows[0]), airports, closed, NOW).count() == 0


def test_route_without_a_bound_fails(ods, airports, airplanes):
    with pytest.raises(Exception, match="route key needs both range bounds"):
        dims.dim_routes(None, ods("routes", route("R1", JAN, None)), airports, airplanes, NOW).collect()


def test_routes_are_updated_above_the_watermark(ods, airports, airplanes, routes):
    old = dims.dim_routes(routes, ods("routes", route("R1", JAN, FEB, plane="P2")), airports, airplanes, THEN)
    assert old.select("airplane_sk").distinct().count() == 1
    new = ods("routes", route("R1", JAN, FEB, plane="P2"), batch=2, deleted=["R1"])
    got = {r.validity.lower.month: r for r in dims.dim_routes(routes, new, airports, airplanes, THEN).collect()}
    assert (got[1].batch_id, got[1].is_deleted, got[1].last_changed_at.month) == (2, True, 2)
    assert (got[2].batch_id, got[2].is_deleted, got[2].last_changed_at.month) == (1, False, 1)
    first = {r.validity.lower.month: r.route_sk for r in routes.collect()}
    assert {m: r.route_sk for m, r in got.items()} == first


def test_old_keys_stay_when_only_the_dimension_changes(ods, airplanes):
    seats = dims.dim_seats(None, ods("seats", ("P1", "1A", "Economy")), airplanes, NOW)
    newer = dims.dim_airplanes(airplanes, ods("airplanes", ("P1", "new", "b", 1, 1), batch=2), THEN)
    again = dims.dim_seats(seats, ods("seats", ("P1", "1A", "Economy")), newer, THEN)
    assert again.first().airplane_sk == seats.first().airplane_sk
    touched = dims.dim_seats(seats, ods("seats", ("P1", "1A", "Comfort"), batch=3), newer, THEN).first()
    assert touched.airplane_sk != seats.first().airplane_sk
    assert (touched.seat_sk, touched.fare_conditions) == (seats.first().seat_sk, "Comfort")


def test_latest_ticket_names_the_passenger(ods):
    tickets = ods("tickets", ("T1", "B", "P", "Old", True), ("T3", "B", "P", "Tie", True), ("T2", "B", None, "?", True))
    tickets = tickets.unionByName(ods("tickets", ("T0", "B", "Q", "Q0", True), batch=1, deleted=["T0"]))
    first = dims.dim_passenger(None, tickets, NOW)
    assert {r.passenger_id: r.passenger_name for r in first.collect()} == {"P": "Tie", "Q": "Q0"}
    later = tickets.unionByName(ods("tickets", ("T4", "B", "P", "New", True), batch=2))
    got = {r.passenger_id: (r.passenger_name, r.batch_id) for r in dims.dim_passenger(first, later, THEN).collect()}
    assert got == {"P": ("New", 2), "Q": ("Q0", 1)}


def test_flight_takes_the_route_version_at_departure(ods, routes):
    month = {r.route_sk: r.validity.lower.month for r in routes.collect()}
    rows = [flight(1, JAN), flight(2, FEB - HOUR), flight(3, FEB), flight(4, MAR), flight(5, JAN, "R9")]
    got = {r.flight_id: month[r.route_sk] for r in facts.fact_flights(None, ods("flights", *rows), routes, NOW).collect()}
    assert got == {1: 1, 2: 1, 3: 2}


def test_deleted_routes_still_match_and_open_ranges_hold(spark, ods, routes):
    gone = routes.withColumn("is_deleted", F.lit(True))
    assert facts.fact_flights(None, ods("flights", flight(1, JAN)), gone, NOW).count() == 1
    endless = spark.createDataFrame(
        [("sk", "R1", (JAN, None))], "route_sk string, route_no string, validity struct<lower:timestamp,upper:timestamp>"
    )
    assert facts.route_at_departure(ods("flights", flight(1, at("2090-01-01"))), endless).count() == 1


def test_overlapping_routes_fail(ods, airports, airplanes):
    both = dims.dim_routes(None, ods("routes", route("R1", JAN, MAR), route("R1", FEB, MAR)), airports, airplanes, NOW)
    with pytest.raises(Exception, match="second row for key"):
        facts.fact_flights(None, ods("flights", flight(1, FEB)), both, NOW).collect()


@pytest.fixture
def parents(ods, routes):
    bookings = facts.fact_bookings(None, ods("bookings", ("B1", JAN, Decimal(5))), NOW)
    tickets_ods = ods("tickets", ("T1", "B1", "P1", "N", True), ("T2", "B9", "P1", "N", True))
    passengers = dims.dim_passenger(None, tickets_ods, NOW)
    tickets = facts.fact_tickets(None, tickets_ods, bookings, passengers, NOW)
    return tickets, facts.fact_flights(None, ods("flights", flight(1, JAN)), routes, NOW)


def test_rows_without_a_parent_are_dropped(ods, parents):
    tickets, flights = parents
    assert [r.ticket_no for r in tickets.collect()] == ["T1"]
    rows = [("T1", 1, "Economy", Decimal(1)), ("T2", 1, "Economy", Decimal(1)), ("T1", 2, "Economy", Decimal(1))]
    assert facts.fact_segments(None, ods("segments", *rows), tickets, flights, NOW).count() == 1
    passes = [("T1", 1, "1A", 1, JAN), ("T9", 1, "1A", 1, JAN)]
    assert facts.fact_boarding_passes(None, ods("boarding_passes", *passes), tickets, flights, NOW).count() == 1


def test_segments_move_on_later_batches_only(ods, parents):
    tickets, flights = parents
    first = facts.fact_segments(None, ods("segments", ("T1", 1, "Economy", Decimal(1)), batch=5), tickets, flights, NOW)
    for batch, price in ((4, 1), (5, 1), (6, 9)):
        delta = ods("segments", ("T1", 1, "Comfort", Decimal(9)), batch=batch, deleted=["T1"] if batch == 6 else ())
        row = facts.fact_segments(first, delta, tickets, flights, THEN).first()
        assert (int(row.price), row.is_deleted) == (price, batch == 6)
        assert row.segment_sk == first.first().segment_sk
