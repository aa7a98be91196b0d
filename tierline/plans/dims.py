"""DDS dimensions: airplanes and airports with history, routes, seats and passengers without."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.expr import canonical_text, surrogate_key
from tierline.operators.history import scd2_merge
from tierline.operators.merge import latest_per_key, upsert

AIRPLANE_TRACKED = [("model_en", "text"), ("model_ru", "text"), ("range", "int"), ("speed", "int")]
AIRPORT_TRACKED = [
    ("airport_name_en", "text"),
    ("airport_name_ru", "text"),
    ("city_en", "text"),
    ("city_ru", "text"),
    ("country_en", "text"),
    ("country_ru", "text"),
    ("coordinates", "point"),
    ("timezone", "text"),
]


def above_watermark(
    ods: DataFrame, target: DataFrame | None, waiting: DataFrame | None = None, newest: int | None = None
) -> DataFrame:
    """ODS rows touched by batches later than the newest one in the target, and those that wait for a parent.

    `waiting` holds the keys of rows that an earlier load had to leave out. `newest` is given where it is on record; otherwise
    the target is asked for it.
    """
    if target is None and newest is None:
        return ods.where("updated_batch_id > 0")
    known = F.lit(newest) if newest is not None else target.agg(F.expr("coalesce(max(batch_id), 0)")).scalar()
    newer = ods.where(F.col("updated_batch_id") > known)
    if waiting is None:
        return newer
    same = [ods[c].eqNullSafe(waiting[c]) for c in waiting.columns]
    return newer.unionByName(ods.where(F.col("updated_batch_id") <= known).join(waiting, same, "left_semi"))


def dim_airplanes(dim: DataFrame | None, ods: DataFrame, effective_at: str) -> DataFrame:
    return scd2_merge(dim, ods, "airplane_code", "airplane_sk", AIRPLANE_TRACKED, effective_at)


def dim_airports(dim: DataFrame | None, ods: DataFrame, effective_at: str) -> DataFrame:
    return scd2_merge(dim, ods, "airport_code", "airport_sk", AIRPORT_TRACKED, effective_at)


def _current(dim: DataFrame, key: str, sk: str, key_as: str, sk_as: str) -> DataFrame:
    return dim.where("is_current").selectExpr(f"{key} as {key_as}", f"{sk} as {sk_as}")


def route_key(route_no: str, validity: str) -> str:
    """Key of a route; an open bound has no text, so the key would be NULL, and that is an error."""
    bounds = [canonical_text(f"{validity}.{b}", "timestamp") for b in ("lower", "upper")]
    message = f"concat('route key needs both range bounds, route ', {route_no})"
    return f"coalesce({surrogate_key(route_no, *bounds)}, cast(raise_error({message}) as string))"


def routes_batch(rows: DataFrame, airports: DataFrame, airplanes: DataFrame, changed_at: str) -> DataFrame:
    """Routes with the keys of the current airport and airplane versions; routes without them are left out."""
    departures = _current(airports, "airport_code", "airport_sk", "departure_airport", "departure_airport_sk")
    arrivals = _current(airports, "airport_code", "airport_sk", "arrival_airport", "arrival_airport_sk")
    models = _current(airplanes, "airplane_code", "airplane_sk", "airplane_code", "airplane_sk")
    found = (
        rows.join(departures, "departure_airport")
        .join(arrivals, "arrival_airport")
        .join(models, "airplane_code")
        .selectExpr(
            "route_no",
            "validity",
            "departure_airport_sk",
            "arrival_airport_sk",
            "airplane_sk",
            "days_of_week",
            "scheduled_time",
            "duration",
            "source_system",
            "record_source",
            "updated_batch_id as batch_id",
            f"{changed_at} as last_changed_at",
            "is_deleted",
        )
    )
    latest = latest_per_key(found, ["route_no", "validity"], ["batch_id", "airplane_sk"])
    return latest.selectExpr(f"{route_key('route_no', 'validity')} as route_sk", "*")


def dim_routes(
    dim: DataFrame | None,
    ods: DataFrame,
    airports: DataFrame,
    airplanes: DataFrame,
    changed_at: str,
    waiting: DataFrame | None = None,
) -> DataFrame:
    batch = routes_batch(above_watermark(ods, dim, waiting), airports, airplanes, changed_at)
    return upsert(dim, batch, **MERGE["dim_routes"])


def seats_batch(rows: DataFrame, airplanes: DataFrame, changed_at: str) -> DataFrame:
    models = _current(airplanes, "airplane_code", "airplane_sk", "airplane_code", "airplane_sk")
    return rows.join(models, "airplane_code").selectExpr(
        f"{surrogate_key('airplane_code', 'seat_no')} as seat_sk",
        "airplane_code",
        "seat_no",
        "airplane_sk",
        "fare_conditions",
        "source_system",
        "record_source",
        "updated_batch_id as batch_id",
        f"{changed_at} as last_changed_at",
        "is_deleted",
    )


def dim_seats(
    dim: DataFrame | None, ods: DataFrame, airplanes: DataFrame, changed_at: str, waiting: DataFrame | None = None
) -> DataFrame:
    return upsert(dim, seats_batch(above_watermark(ods, dim, waiting), airplanes, changed_at), **MERGE["dim_seats"])


def passengers_batch(rows: DataFrame, changed_at: str) -> DataFrame:
    """One row per passenger from the latest ticket, deleted tickets included; ticket_no breaks ties."""
    latest = latest_per_key(
        rows.where("passenger_id is not null").selectExpr(
            "passenger_id",
            "passenger_name",
            "source_system",
            "record_source",
            "updated_batch_id as batch_id",
            "ticket_no",
        ),
        ["passenger_id"],
        ["batch_id", "ticket_no"],
    )
    return latest.drop("ticket_no").selectExpr(
        f"{surrogate_key('passenger_id')} as passenger_sk", "*", f"{changed_at} as last_changed_at"
    )


def dim_passenger(dim: DataFrame | None, tickets: DataFrame, changed_at: str) -> DataFrame:
    return upsert(dim, passengers_batch(above_watermark(tickets, dim), changed_at), **MERGE["dim_passenger"])


#: How a batch of each dimension without history is merged.
MERGE = {
    "dim_routes": {"keys": ["route_no", "validity"], "keep": ["route_sk"], "checked": True},
    "dim_seats": {"keys": ["airplane_code", "seat_no"], "keep": ["seat_sk"], "guard": "t.batch_id <> d.batch_id"},
    "dim_passenger": {"keys": ["passenger_id"], "keep": ["passenger_sk"], "checked": True},
}
