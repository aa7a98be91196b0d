"""Registries, source readers, and declared constraints that do not hold."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import at
from tests.test_staging import GOOD
from tierline.catalog import fixed_values as fv
from tierline.catalog.entities import ENTITIES
from tierline.plans import registry_checks
from tierline.sources.tables import read_parquet


def test_registry_sizes(spark):
    dictionary = registry_checks.source_dictionary(spark)
    assert dictionary.count() == 54
    assert registry_checks.source_constraints(spark).count() == 29
    assert registry_checks.source_indexes(spark).where("is_unique").count() == 13
    assert registry_checks.source_indexes(spark).count() == 15
    listed = {(r.object_name, r.column_name) for r in dictionary.where("column_name is not null").collect()}
    assert listed == {(e.source_object, c) for e in ENTITIES.values() for c in e.column_names}


@pytest.mark.parametrize("entity", list(ENTITIES))
def test_source_tables_round_trip_through_parquet(spark, rows, tmp_path, entity):
    e = ENTITIES[entity]
    frame = rows(entity, GOOD[entity])
    frame.write.parquet(f"{tmp_path}/{e.source_object}")
    assert read_parquet(spark, str(tmp_path), e).collect() == frame.collect()


@pytest.fixture
def sources(rows):
    def build(**extra):
        frames = {}
        for name, e in ENTITIES.items():
            frames[e.source_object] = rows(name, GOOD[name], *extra.get(name, []))
        return frames

    return build


GOOD_PARENTS = dict(
    airports=[("AAA", *GOOD["airports"][1:]), ("BBB", *GOOD["airports"][1:])],
)


def violations(frames):
    found = registry_checks.constraint_violations(frames).collect()
    assert len(found) == len(fv.CONSTRAINTS)
    return {r.constraint_name: r.violations for r in found if r.violations}


def test_constraints_of_clean_sources_hold(sources):
    assert violations(sources(**GOOD_PARENTS)) == {}


def test_broken_constraints_are_counted(sources):
    day = at("2024-01-15"), at("2024-03-01")
    extra = GOOD_PARENTS | dict(
        airplanes=[("X", None, 0, None)],
        bookings=[("B1", None, Decimal(1))],
        routes=[("R1", day, "AAA", "ZZZ", "320", [1], "1", GOOD["routes"][-1])],
        segments=[("T9", 1, "First", Decimal(-1))],
        flights=[(2, "R1", "On Time", at("2024-01-02"), at("2024-01-01"), None, None)],
    )
    assert violations(sources(**extra)) == {
        "airplanes_data_range_check": 1,
        "bookings_pkey": 1,
        "routes_temporal_exclude": 1,
        "routes_arrival_airport_fkey": 1,
        "segments_ticket_no_fkey": 1,
        "segments_price_check": 1,
        "segments_fare_conditions_check": 1,
        "flights_scheduled_arrival_check": 1,
    }


def test_null_profile(sources):
    frames = sources(airplanes=[("X", None, 0, None)], boarding_passes=[("T2", 1, "2A", None, None)])
    got = {(r.object_name, r.column_name): (r.null_rows, r.holds) for r in registry_checks.null_profile(frames).collect()}
    assert got[("airplanes_data", "model")] == (1, False)
    assert got[("boarding_passes", "boarding_no")] == (2, True)
    assert got[("seats", "seat_no")] == (0, True)


def test_unique_indexes(sources):
    frames = sources(tickets=[("T2", "B1", "P1", "Other", True)])
    got = {r.index_name: r.violations for r in registry_checks.unique_index_violations(frames).collect()}
    assert {k: v for k, v in got.items() if v} == {"tickets_book_ref_passenger_outbound_idx": 1}


def test_unique_where(spark):
    versions = spark.createDataFrame([("s1", "A", True), ("s2", "A", True), ("s3", "B", True), ("s4", "B", False)], "airplane_sk string, airplane_code string, is_current boolean")
    frame = versions.withColumns({"valid_from": F.expr("timestamp'2024-01-01'"), "valid_to": F.expr("timestamp'2024-01-01'")})
    listed = [c for c in fv.WAREHOUSE_CONSTRAINTS if c[0] == "dds.dim_airplanes"]
    got = {r.constraint_name: r.violations for r in registry_checks.constraint_violations({"dds.dim_airplanes": frame}, listed).collect()}
    assert got == {"pk_dds_airplanes": 0, "chk_dds_airplanes_valid_period": 4, "uq_dds_dim_airplanes_current": 1}
