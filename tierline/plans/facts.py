"""DDS facts: keys swapped in by joins, rows above the watermark merged by key.

Lookups are inner joins, so rows without a partner are left out; the stored warehouse keeps their keys and passes them on
as `waiting`, so that they are tried again. Hot foreign keys (one flight, one booking) are left to
adaptive skew joins: parents are read unbucketed here, so both sides shuffle and Spark may split a heavy partition.

ODS holds each key once and parents are looked up by their unique keys, so only flights, whose route ranges could
overlap, need the check for a key that occurs twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.expr import packed_key, surrogate_key, unpacked_key
from tierline.operators.merge import upsert
from tierline.operators.temporal import valid_at
from tierline.plans.dims import above_watermark

LATER_BATCH = "t.batch_id < d.batch_id"

#: Deals rows of a batch out by the key of their table. It comes before their own key is made, which no other column tells and which
#: would cross the shuffle as 36 letters that no codec makes shorter.
Placed = Callable[[DataFrame], DataFrame]


def _technical(changed_at: str) -> list[str]:
    return [
        "source_system",
        "record_source",
        "updated_batch_id as batch_id",
        f"{changed_at} as last_changed_at",
        "is_deleted",
    ]


def route_at_departure(flights: DataFrame, routes: DataFrame) -> DataFrame:
    """Each flight with the route version valid at its scheduled departure (half-open range)."""
    r = routes.selectExpr("route_no as r_route_no", "validity", "route_sk")
    return valid_at(flights, "route_no", "scheduled_departure", r, "r_route_no", "validity").drop("r_route_no", "validity")


def _as_found(rows: DataFrame) -> DataFrame:
    return rows


def flights_batch(rows: DataFrame, routes: DataFrame, changed_at: str, placed: Placed = _as_found) -> DataFrame:
    return placed(route_at_departure(rows, routes)).selectExpr(
        f"{surrogate_key('flight_id', 'source_system')} as flight_sk",
        "route_sk",
        "flight_id",
        "status",
        "scheduled_departure",
        "scheduled_arrival",
        "actual_departure",
        "actual_arrival",
        *_technical(changed_at),
    )


def fact_flights(
    fact: DataFrame | None, ods: DataFrame, routes: DataFrame, changed_at: str, waiting: DataFrame | None = None
) -> DataFrame:
    return upsert(fact, flights_batch(above_watermark(ods, fact, waiting), routes, changed_at), **MERGE["fact_flights"])


def without_parent(rows: DataFrame, keys: list[str], parents: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Keys of the rows for which a lookup finds nothing. Parents are (column of the row, parent, its column); a parent
    column `validity` means the route version at departure."""
    missing = None
    for column, parent, known in parents:
        if known == "validity":
            r = parent.selectExpr("route_no as r_route_no", "validity")
            lone = valid_at(rows, "route_no", "scheduled_departure", r, "r_route_no", "validity", "left_anti")
        else:
            lone = rows.join(parent.selectExpr(f"{known} as parent_key"), F.expr(f"{column} = parent_key"), "left_anti")
        lone = lone.select(*keys)
        missing = lone if missing is None else missing.unionByName(lone)
    return missing.distinct()


def bookings_batch(rows: DataFrame, changed_at: str, placed: Placed = _as_found) -> DataFrame:
    return placed(rows).selectExpr(
        f"{surrogate_key('book_ref', 'source_system')} as bookings_sk",
        "book_ref",
        "book_date",
        "total_amount",
        *_technical(changed_at),
    )


def fact_bookings(fact: DataFrame | None, ods: DataFrame, changed_at: str) -> DataFrame:
    return upsert(fact, bookings_batch(above_watermark(ods, fact), changed_at), **MERGE["fact_bookings"])


def tickets_batch(rows: DataFrame, bookings: DataFrame, passengers: DataFrame, changed_at: str, placed: Placed = _as_found) -> DataFrame:
    found = (
        rows.where("ticket_no is not null")
        .join(bookings.selectExpr("book_ref", f"{packed_key('bookings_sk')} as bookings_key"), "book_ref")
        .join(passengers.selectExpr("passenger_id", f"{packed_key('passenger_sk')} as passenger_key"), "passenger_id")
    )
    return placed(found).selectExpr(
        f"{surrogate_key('ticket_no', 'source_system')} as ticket_sk",
        f"{unpacked_key('bookings_key')} as bookings_sk",
        f"{unpacked_key('passenger_key')} as passenger_sk",
        "ticket_no",
        "outbound",
        *_technical(changed_at),
    )


def fact_tickets(
    fact: DataFrame | None,
    ods: DataFrame,
    bookings: DataFrame,
    passengers: DataFrame,
    changed_at: str,
    waiting: DataFrame | None = None,
) -> DataFrame:
    batch = tickets_batch(above_watermark(ods, fact, waiting), bookings, passengers, changed_at)
    return upsert(fact, batch, **MERGE["fact_tickets"])


def by_ticket_and_flight(
    rows: DataFrame,
    tickets: DataFrame,
    flights: DataFrame,
    sk: str,
    measures: list[str],
    changed_at: str,
    placed: Placed = _as_found,
) -> DataFrame:
    """Keys of tickets and flights cross the shuffles packed; the rows' own key is made behind the last one, `placed` included, which
    gets each key both as text and packed and need hand on the packed ones alone."""
    keys = ("ticket", "flight")
    found = (
        rows.where("ticket_no is not null and flight_id is not null")
        .join(tickets.selectExpr("ticket_no", f"{packed_key('ticket_sk')} as ticket_key"), "ticket_no")
        .join(flights.selectExpr("flight_id", f"{packed_key('flight_sk')} as flight_key"), "flight_id")
        .selectExpr("*", *[f"{unpacked_key(f'{k}_key')} as {k}_sk" for k in keys])
    )
    return placed(found).selectExpr(
        f"{surrogate_key('ticket_no', 'flight_id', 'source_system')} as {sk}",
        *[f"{unpacked_key(f'{k}_key')} as {k}_sk" for k in keys],
        *measures,
        *_technical(changed_at),
    )


def segments_batch(
    rows: DataFrame, tickets: DataFrame, flights: DataFrame, changed_at: str, placed: Placed = _as_found
) -> DataFrame:
    return by_ticket_and_flight(rows, tickets, flights, "segment_sk", ["fare_conditions", "price"], changed_at, placed)


def boarding_passes_batch(
    rows: DataFrame, tickets: DataFrame, flights: DataFrame, changed_at: str, placed: Placed = _as_found
) -> DataFrame:
    measures = ["seat_no", "boarding_no", "boarding_time"]
    return by_ticket_and_flight(rows, tickets, flights, "boarding_pass_sk", measures, changed_at, placed)


def fact_segments(
    fact: DataFrame | None,
    ods: DataFrame,
    tickets: DataFrame,
    flights: DataFrame,
    changed_at: str,
    waiting: DataFrame | None = None,
) -> DataFrame:
    batch = segments_batch(above_watermark(ods, fact, waiting), tickets, flights, changed_at)
    return upsert(fact, batch, **MERGE["fact_segments"])


def fact_boarding_passes(
    fact: DataFrame | None,
    ods: DataFrame,
    tickets: DataFrame,
    flights: DataFrame,
    changed_at: str,
    waiting: DataFrame | None = None,
) -> DataFrame:
    batch = boarding_passes_batch(above_watermark(ods, fact, waiting), tickets, flights, changed_at)
    return upsert(fact, batch, **MERGE["fact_boarding_passes"])


#: The keys of the two facts by ticket and flight, out of their packed forms.
BY_PAIR = [unpacked_key("ticket_key"), unpacked_key("flight_key")]

#: How a batch of each fact is merged.
MERGE = {
    "fact_flights": {"keys": ["flight_id"], "keep": ["flight_sk"]},
    "fact_bookings": {"keys": ["book_ref"], "keep": ["bookings_sk"], "checked": True},
    "fact_tickets": {"keys": ["ticket_no"], "keep": ["ticket_sk"], "guard": LATER_BATCH, "checked": True},
    "fact_segments": {"keys": ["ticket_sk", "flight_sk"], "keep": ["segment_sk"], "guard": LATER_BATCH, "checked": True},
    "fact_boarding_passes": {"keys": ["ticket_sk", "flight_sk"], "keep": ["boarding_pass_sk"], "guard": LATER_BATCH, "checked": True},
}
