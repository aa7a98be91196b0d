from decimal import Decimal

import pytest

from tests.conftest import at
from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import ts
from tierline.operators import merge

E = ENTITIES["bookings"]
DAY = at("2024-01-01")


def staged(spark, batch, *events):
    """Events: (book_ref, amount, operation, valid)."""
    data = [(k, DAY, Decimal(a), "sys", "src", batch, op, valid) for k, a, op, valid in events]
    return spark.createDataFrame(
        data,
        "book_ref string, book_date timestamp, total_amount decimal(10,2), source_system string, record_source string,"
        " batch_id bigint, operation_type string, is_valid boolean",
    )


def state(ods):
    return {
        r.book_ref: (int(r.total_amount), r.created_batch_id, r.updated_batch_id, r.is_deleted, r.last_operation_type)
        for r in ods.collect()
    }


def apply(spark, ods, batch, *events):
    return merge.apply_stage(ods, staged(spark, batch, *events), E, ts(f"2024-01-0{batch}"))


def test_insert_delete_insert(spark):
    one = apply(spark, None, 1, ("A", 1, "I", True), ("B", 2, "I", True))
    assert state(one) == {"A": (1, 1, 1, False, "I"), "B": (2, 1, 1, False, "I")}
    two = apply(spark, one, 2, ("A", 9, "D", True), ("B", 3, "U", True))
    assert state(two) == {"A": (1, 1, 2, True, "D"), "B": (3, 1, 2, False, "U")}
    three = apply(spark, two, 3, ("A", 5, "I", True))
    assert state(three)["A"] == (5, 1, 3, False, "I")
    changed = {r.book_ref: r.last_changed_at.day for r in three.collect()}
    assert changed == {"A": 3, "B": 2}


def test_unknown_deletes_and_invalid_rows_are_ignored(spark):
    one = apply(spark, None, 1, ("A", 1, "I", True), ("Z", 1, "D", True))
    assert set(state(one)) == {"A"}
    two = apply(spark, one, 2, ("A", 7, "U", False), ("B", 1, "I", False), ("Q", 1, "D", True), ("C", 1, None, True))
    assert state(two) == state(one)


def test_two_upserts_of_one_key_fail(spark):
    with pytest.raises(Exception, match="second row for key"):
        apply(spark, None, 1, ("A", 1, "I", True), ("A", 2, "U", True)).collect()


@pytest.mark.parametrize("first", [True, False])
def test_upsert_and_delete_of_one_key_apply_in_that_order(spark, first):
    ods = None if first else apply(spark, None, 1, ("A", 1, "I", True))
    got = state(apply(spark, ods, 2, ("A", 1, "D", True), ("A", 4, "I", True)))
    assert got == {"A": (4, 2 if first else 1, 2, True, "D")}


def test_counts(spark):
    ods = apply(spark, apply(spark, None, 1, ("A", 1, "I", True), ("B", 1, "I", True)), 2, ("A", 1, "D", True))
    assert tuple(merge.active_counts(ods).first()) == (2, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame(rows, "k int, sk string, v string, batch_id int")


def test_upsert_guard_and_kept_columns(spark):
    target = frame(spark, (1, "s1", "a", 5), (2, "s2", "b", 5), (4, "s4", "d", 5))
    delta = frame(spark, (1, "x1", "A", 6), (2, "x2", "B", 4), (3, "x3", "C", 6))
    got = sorted(tuple(r) for r in merge.upsert(target, delta, ["k"], ["sk"], "t.batch_id < d.batch_id").collect())
    assert got == [(1, "s1", "A", 6), (2, "s2", "b", 5), (3, "x3", "C", 6), (4, "s4", "d", 5)]


@pytest.mark.parametrize("with_target", [True, False])
def test_upsert_fails_on_a_key_that_comes_twice(spark, with_target):
    target = frame(spark, (1, "s", "a", 1)) if with_target else None
    with pytest.raises(Exception, match='second row for key.*"k":2'):
        merge.upsert(target, frame(spark, (2, "s", "a", 1), (2, "s", "b", 1)), ["k"]).collect()


def test_latest_per_key(spark):
    df = frame(spark, (1, "a", "old", 1), (1, "b", "new", 3), (1, "a", "tie", 3), (2, "a", "x", 1))
    got = {r.k: r.v for r in merge.latest_per_key(df, ["k"], ["batch_id", "sk"]).collect()}
    assert got == {1: "new", 2: "x"}


def test_upsert_raises_on_a_key_with_a_null_part(spark):
    rows = spark.createDataFrame([("T1", None, 1)], "ticket_no string, flight_id int, n int")
    for target in (None, rows.where("false")):
        with pytest.raises(Exception, match="key with a NULL part"):
            merge.upsert(target, rows, ["ticket_no", "flight_id"], checked=True).collect()
