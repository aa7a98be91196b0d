"""Each of the fifteen checks, once passing and once failing, and the report."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from tests.conftest import at
from tierline.catalog import fixed_values as fv
from tierline.functions.expr import ts
from tierline.plans import checks

NOW = ts("2024-03-01")
KEY = {"airplanes": "airplane_code string", "seats": "airplane_code string, seat_no string", "bookings": "book_ref string"}
DATES = [at(f"2024-0{m}-01") for m in range(1, 8)]
END = at("9000-01-01")


def build(spark, source=None, raw=None, ods=None, dds=None):
    """Clean tables of all objects, single tables replaced by the arguments (object or entity name -> rows)."""
    keys = {"airplanes": [("A",), ("B",)], "seats": [("A", "1"), ("A", "2")], "bookings": [("X",), ("Y",)]}
    tables = {}
    for e, schema in KEY.items():
        amount = ", total_amount decimal(10,2)" if e == "bookings" else ""
        extra = (Decimal(5),) if amount else ()
        tables[f"source.{e}"] = spark.createDataFrame((source or {}).get(e, keys[e]), schema)
        events = [(*k, "I", 1, DATES[0]) for k in keys[e]]
        tables[f"raw.{e}"] = spark.createDataFrame(
            (raw or {}).get(e, events), f"{schema}, operation_type string, batch_id bigint, load_date timestamp"
        )
        tables[f"ods.{e}"] = spark.createDataFrame(
            (ods or {}).get(e, [(*k, *extra, False) for k in keys[e]]), f"{schema}{amount}, is_deleted boolean"
        )
        if e != "airplanes":
            name = {"seats": "dim_seats", "bookings": "fact_bookings"}[e]
            live = [(*k, *extra, False) for k in keys[e]]
            tables[f"dds.{name}"] = spark.createDataFrame((dds or {}).get(name, live), f"{schema}{amount}, is_deleted boolean")
    versions = [("A", DATES[0], DATES[1], False), ("A", DATES[1], END, True), ("B", DATES[0], END, True), ("-1", DATES[0], END, True)]
    tables["dds.dim_airplanes"] = spark.createDataFrame(
        (dds or {}).get("dim_airplanes", versions),
        "airplane_code string, valid_from timestamp, valid_to timestamp, is_current boolean",
    )
    return tables


def run(check_id, tables):
    r = checks.check(check_id, tables, 1, NOW).first()
    return (float(r.src_value), float(r.dwh_value), float(r["diff"]), r.status)


def test_all_pass_on_clean_tables(spark):
    got = checks.all_checks(build(spark), 4, NOW).collect()
    assert [r.check_id for r in got] == [c[0] for c in fv.CHECKS]
    assert {r.status for r in got} == {"PASS"} and {r.run_id for r in got} == {4}


FAILING = [
    ("RC-01", dict(source={"airplanes": [("A",), ("B",), ("C",)]}), (3, 2, 1, "FAIL")),
    ("RC-02", dict(raw={"airplanes": [("A", "I", 1, DATES[0]), ("A", "D", 2, DATES[0]), ("B", "I", 1, DATES[0])]}), (1, 2, -1, "FAIL")),
    ("RC-03", dict(ods={"airplanes": [("A", False), ("B", True)]}), (1, 2, -1, "FAIL")),
    ("SCD2-01", dict(dds={"dim_airplanes": [("A", DATES[0], END, True), ("A", DATES[1], END, True)]}), (0, 1, -1, "FAIL")),
    ("SCD2-02", dict(dds={"dim_airplanes": [("A", DATES[0], DATES[2], False), ("A", DATES[1], END, True)]}), (0, 1, -1, "FAIL")),
    ("SCD2-03", dict(dds={"dim_airplanes": [("A", DATES[0], DATES[1], False), ("A", DATES[2], END, True)]}), (0, 1, -1, "WARN")),
    # A composite key with a NULL part still counts.
    ("RC-04", dict(source={"seats": [("A", "1"), ("A", "2"), ("A", None)]}), (3, 2, 1, "FAIL")),
    # Same batch: the later load date decides.
    ("RC-05", dict(raw={"seats": [("A", "1", "D", 1, DATES[0]), ("A", "1", "I", 1, DATES[1]), ("A", "2", "D", 1, DATES[0])]}), (1, 2, -1, "FAIL")),
    ("RC-06", dict(dds={"dim_seats": [("A", "1", False), ("A", "2", True), ("-1", "-1", False)]}), (2, 1, 1, "FAIL")),
    ("DUP-01", dict(dds={"dim_seats": [("A", "1", False), ("A", "1", False), ("A", None, False), ("B", "1", True)]}), (0, 2, -2, "FAIL")),
    ("RC-07", dict(source={"bookings": [("X",), ("X",), (None,)]}), (1, 2, -1, "FAIL")),
    ("RC-08", dict(ods={"bookings": [("X", Decimal(5), False)]}), (2, 1, 1, "FAIL")),
    ("RC-09", dict(dds={"fact_bookings": [("X", Decimal(5), False), ("-1", Decimal(5), False)]}), (2, 1, 1, "FAIL")),
    ("DUP-02", dict(dds={"fact_bookings": [("X", Decimal(5), False), ("X", Decimal(5), False), (None, Decimal(0), False)]}), (0, 2, -2, "FAIL")),
    ("AGG-01", dict(dds={"fact_bookings": [("X", Decimal("5.01"), False), ("Y", Decimal(5), True)]}), (10, 5.01, 4.99, "FAIL")),
]


@pytest.mark.parametrize("check_id, changes, want", FAILING, ids=[f[0] for f in FAILING])
def test_each_check_can_fail(spark, check_id, changes, want):
    assert run(check_id, build(spark, **changes)) == want


def test_all_checks_read_each_table_once(spark, tmp_path):
    tables = {}
    for name, df in build(spark).items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    plan = checks.all_checks(tables, 1, NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == len(tables) == 12
    assert plan.count("rangepartitioning(") == 1  # overlaps and gaps come out of the same chunks
    assert "Join" not in plan


def test_history_of_many_versions(spark):
    """One airplane with most versions, copies, overlaps and gaps: the measures of the three history checks in one pass."""
    rows = [("hot", datetime(2024, 1, 1) + timedelta(hours=h), datetime(2024, 1, 1) + timedelta(hours=h + 1), False) for h in range(300)]
    rows += [("hot", DATES[3], END, True), ("hot", DATES[3], END, True), (None, DATES[0], END, True)]
    rows += [("a", DATES[0], DATES[2], False), ("a", DATES[1], END, True)]
    found = checks.history_measures(spark.createDataFrame(rows, "k string, valid_from timestamp, valid_to timestamp, is_current boolean").repartition(5), "k")
    assert found.first().asDict() == {"keys": 2, "twice": 1, "overlaps": 2, "gaps": 1}


def test_empty_amounts_reconcile(spark):
    tables = build(spark, ods={"bookings": [("X", Decimal(5), True)]}, dds={"fact_bookings": [("X", Decimal(5), True)]})
    assert run("AGG-01", tables) == (0, 0, 0, "PASS")


def test_report(spark):
    old = checks.all_checks(build(spark), 1, NOW)
    new = checks.all_checks(build(spark, **FAILING[5][1]), 2, NOW)
    results = old.unionByName(new)
    s = checks.status_summary(results).first()
    # The gap also shows as missing key B between ODS and DDS.
    assert (s.total, s["pass"], s.fail, s.warn, s.pass_percent) == (15, 13, 1, 1, 87)
    assert [(r.object_name, r.checks) for r in checks.coverage(results, "object_name").collect()] == [
        ("dim_seats", 4), ("fact_bookings", 5), ("dim_airplanes", 6)]
    assert [(r.check_type, r.checks) for r in checks.coverage(results, "check_type").collect()] == [
        ("aggregate", 1), ("duplicate", 2), ("scd2", 3), ("row_count", 9)]
    assert [(r.seam, r.checks) for r in checks.seam_coverage(results).collect()] == [
        ("source → raw", 3), ("raw → ods", 3), ("ods → dds", 4), ("dds → dds", 5)]
    detail = {r.check_id: r for r in checks.details(results).collect()}
    assert (detail["AGG-01"].src_value, detail["AGG-01"]["diff"]) == ("10", "0.00")
    assert {r.run_id: (r.checks, r["pass"]) for r in checks.run_totals(results).collect()} == {1: (15, 15), 2: (15, 13)}
