from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import at, names
from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import ts
from tierline.operators import cdc, staging

NOW = ts("2024-03-01")
T = at("2024-01-01 10:00:00")
LATER = at("2024-01-01 12:00:00")
SEASON = (at("2024-01-01"), at("2024-02-01"))
N = names("a", "b")

GOOD = {
    "airplanes": ("320", N, 100, 200),
    "airports": ("SVO", N, N, N, (1.0, 2.0), "UTC"),
    "routes": ("R1", SEASON, "AAA", "BBB", "320", [1], "11:00:00", timedelta(hours=1)),
    "seats": ("320", "1A", "Economy"),
    "flights": (1, "R1", "Scheduled", T, LATER, T, LATER),
    "bookings": ("B1", T, Decimal("1.00")),
    "tickets": ("T1", "B1", "P1", "Name", True),
    "segments": ("T1", 1, "Comfort", Decimal("0.00")),
    "boarding_passes": ("T1", 1, "1A", None, None),
}
# (entity, changed columns, expected validation_error)
BAD = [
    ("airplanes", {"airplane_code": None}, "airplane_code is empty"),
    ("airplanes", {"airplane_code": "  "}, "airplane_code is empty"),
    ("airplanes", {"model": names(None, "b")}, "model_en is null"),
    ("airplanes", {"model": names("a", " ")}, "model_ru is null"),
    ("airplanes", {"range": 0}, "range must be greater than 0"),
    ("airplanes", {"speed": None}, "speed must be greater than 0"),
    ("airplanes", {"airplane_code": "", "speed": -1}, "airplane_code is empty; speed must be greater than 0"),
    ("airports", {"airport_code": " "}, "airport_code is empty"),
    ("airports", {"airport_name": None}, "airport_name_en is null; airport_name_ru is null"),
    ("airports", {"city": names(" ", "b")}, "city_en is null"),
    ("airports", {"country": names("a", " ")}, "country_ru is null"),
    ("airports", {"coordinates": None}, "coordinates is null"),
    ("airports", {"timezone": "  "}, "timezone is empty"),
    ("routes", {"route_no": " "}, "route_no is empty"),
    ("routes", {"validity": None}, "validity is null"),
    ("routes", {"departure_airport": " "}, "departure_airport is empty"),
    ("routes", {"arrival_airport": None}, "arrival_airport is empty"),
    ("routes", {"arrival_airport": " aaa "}, "departure_airport equals arrival_airport"),
    ("routes", {"airplane_code": ""}, "airplane_code is empty"),
    ("routes", {"days_of_week": None}, "days_of_week is null"),
    ("routes", {"scheduled_time": None}, "scheduled_time is null"),
    ("routes", {"duration": None}, "duration is null"),
    ("routes", {"duration": timedelta(0)}, "duration must be greater than 0"),
    ("seats", {"airplane_code": " "}, "airplane_code is empty"),
    ("seats", {"seat_no": ""}, "seat_no is empty"),
    ("seats", {"fare_conditions": " "}, "fare_conditions is empty"),
    ("seats", {"fare_conditions": "First"}, "fare_conditions is invalid"),
    ("flights", {"flight_id": None}, "flight_id is null"),
    ("flights", {"route_no": " "}, "route_no is empty"),
    ("flights", {"status": None}, "status is empty"),
    ("flights", {"status": "Lost"}, "status is invalid"),
    ("flights", {"scheduled_departure": None}, "scheduled_departure is null"),
    ("flights", {"scheduled_arrival": None}, "scheduled_arrival is null"),
    ("flights", {"scheduled_arrival": T}, "scheduled_arrival must be greater than scheduled_departure"),
    ("flights", {"actual_departure": None}, "actual_departure is null while actual_arrival is not null"),
    ("flights", {"actual_arrival": T}, "actual_arrival must be greater than actual_departure"),
    ("bookings", {"book_ref": " "}, "book_ref is empty"),
    ("bookings", {"book_date": None}, "book_date is null"),
    ("bookings", {"total_amount": None}, "total_amount is null"),
    ("bookings", {"total_amount": Decimal("-0.01")}, "total_amount must be greater than or equal to 0"),
    ("tickets", {"ticket_no": " "}, "ticket_no is empty"),
    ("tickets", {"book_ref": None}, "book_ref is empty"),
    ("tickets", {"passenger_id": ""}, "passenger_id is empty"),
    ("tickets", {"passenger_name": " "}, "passenger_name is empty"),
    ("tickets", {"outbound": None}, "outbound is null"),
    ("segments", {"ticket_no": None}, "ticket_no is empty"),
    ("segments", {"flight_id": None}, "flight_id is null"),
    ("segments", {"fare_conditions": None}, "fare_conditions is empty"),
    ("segments", {"fare_conditions": "economy"}, "fare_conditions is invalid"),
    ("segments", {"price": None}, "price is null"),
    ("segments", {"price": Decimal("-1")}, "price must be greater than or equal to 0"),
    ("boarding_passes", {"ticket_no": ""}, "ticket_no is empty"),
    ("boarding_passes", {"flight_id": None}, "flight_id is null"),
    ("boarding_passes", {"seat_no": " "}, "seat_no is empty"),
    ("boarding_passes", {"boarding_no": 0}, "boarding_no must be greater than 0"),
]


@pytest.mark.parametrize("entity", list(ENTITIES))
def test_rules(rows, entity):
    """All bad rows of an entity in one frame, plus a good one and the operation rule."""
    e = ENTITIES[entity]
    cases = [(changed, error) for name, changed, error in BAD if name == entity]
    values = [dict(zip(e.column_names, GOOD[entity])) | changed for changed, _ in cases]
    frames = [rows(entity, GOOD[entity]), *[rows(entity, tuple(v.values())) for v in values]]
    want = [None, *[error for _, error in cases]]
    staged = None
    for n, frame in enumerate(frames):
        journal = cdc.initial(frame, e, 5, NOW).withColumn("record_source", F.lit(str(n)))
        staged = journal if staged is None else staged.unionByName(journal)
    unknown = cdc.initial(frames[0], e, 5, NOW).withColumns({"operation_type": F.lit("X"), "record_source": F.lit("x")})
    nothing = cdc.initial(frames[0], e, 5, NOW).withColumns(
        {"operation_type": F.lit(None).cast("string"), "record_source": F.lit("none")}
    )
    all_rows = staged.unionByName(unknown).unionByName(nothing)
    got = {r.record_source: r for r in staging.stage(all_rows, e, NOW, 5).collect()}
    assert [got[str(n)].validation_error for n in range(len(want))] == want
    assert got["x"].validation_error == "operation_type is invalid"
    # A missing operation is not "outside the list": the rule is three-valued.
    assert got["none"].validation_error is None
    assert all(r.is_valid == (r.validation_error is None) for r in got.values())


def test_cleansing(rows):
    e = ENTITIES["routes"]
    journal = cdc.initial(rows("routes", (" R1 ", SEASON, " aa ", "bb", " p", [1], "1", timedelta(1))), e, 1, NOW)
    row = staging.stage(journal, e, NOW, 1).first()
    assert (row.route_no, row.departure_airport, row.arrival_airport, row.airplane_code) == ("R1", "AA", "BB", "P")
    e = ENTITIES["airplanes"]
    journal = cdc.initial(rows("airplanes", (" 32n ", names(" x ", "y"), 1, 1)), e, 1, NOW)
    row = staging.stage(journal, e, NOW, 1).first()
    assert (row.airplane_code, row.model_en, row.model_ru) == ("32N", "x", "y")


def test_batch_selection(rows):
    e = ENTITIES["seats"]
    journal = cdc.initial(rows("seats", GOOD["seats"]), e, 3, NOW).unionByName(
        cdc.initial(rows("seats", ("X", "2", "Economy"), ("Y", "2", "Oops")), e, 4, NOW)
    )
    assert {r.airplane_code for r in staging.stage(journal, e, NOW).collect()} == {"X", "Y"}
    assert {r.airplane_code for r in staging.stage(journal, e, NOW, 3).collect()} == {"320"}
    count = staging.counts(staging.stage(journal, e, NOW)).first()
    assert (count.batch_id, count.rows, count.invalid_rows) == (4, 2, 1)
    with pytest.raises(ValueError, match="no batch_id"):
        staging.stage(journal.where("false"), e, NOW)
    with pytest.raises(ValueError, match="required"):
        staging.clean(journal, e, None, NOW)
