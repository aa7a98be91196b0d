from decimal import Decimal

from tests.conftest import at, names
from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import ts
from tierline.operators import cdc

DAY = at("2024-01-01")
NOW = ts("2024-03-01")


def bookings(rows, **amounts):
    return rows("bookings", *[(k, DAY, Decimal(v)) for k, v in amounts.items()])


def test_delta_finds_the_three_operations(rows):
    e = ENTITIES["bookings"]
    before = cdc.hashed(bookings(rows, A=1, B=2, C=3), e)
    after = cdc.hashed(bookings(rows, B=2, C=4, D=5), e)
    got = {r.book_ref: (r.operation_type, r.total_amount) for r in cdc.delta(after, before, e, 7, NOW).collect()}
    assert got == {"A": ("D", Decimal("1.00")), "C": ("U", Decimal("4.00")), "D": ("I", Decimal("5.00"))}
    assert [r.book_ref for r in cdc.inserts(after, before, e).collect()] == ["D"]
    assert [r.book_ref for r in cdc.updates(after, before, e).collect()] == ["C"]
    assert [r.book_ref for r in cdc.deletes(after, before, e).collect()] == ["A"]


def test_delta_carries_hash_and_technical_columns(rows):
    e = ENTITIES["bookings"]
    before, after = (cdc.hashed(bookings(rows, **a), e) for a in ({"A": 1}, {}))
    row = cdc.delta(after, before, e, 7, NOW).first()
    assert row.raw_row_hash == before.first().raw_row_hash
    assert (row.batch_id, row.source_system, row.record_source) == (7, "postgres_demo", "demo.bookings.bookings")


def test_unchanged_source_gives_nothing(rows):
    e = ENTITIES["bookings"]
    same = cdc.hashed(bookings(rows, A=1, B=2), e)
    assert cdc.delta(same, same, e, 7, NOW).count() == 0


def test_initial_load_is_all_inserts(rows):
    e = ENTITIES["bookings"]
    loaded = cdc.initial(bookings(rows, A=1, B=2), e, 1, NOW).collect()
    assert [r.operation_type for r in loaded] == ["I", "I"]


def test_null_and_empty_are_no_change(rows):
    e = ENTITIES["seats"]
    before, after = (cdc.hashed(rows("seats", ("A", "1", fare)), e) for fare in (None, ""))
    assert cdc.changes(after, before, e).count() == 0


def test_coordinates_are_not_hashed(rows):
    e = ENTITIES["airports"]
    before, after = (
        cdc.hashed(rows("airports", ("A", names("n"), names("c"), names("l"), (lon, 1.0), "UTC")), e) for lon in (1.0, 2.0)
    )
    assert cdc.changes(after, before, e).count() == 0


def test_composite_range_key(rows):
    e = ENTITIES["routes"]
    season = lambda n: (at(f"2024-0{n}-01"), at(f"2024-0{n + 1}-01"))
    route = lambda n, days: ("R", season(n), "A", "B", "P", days, "11:00:00", at("2024-01-01") - at("2023-12-31"))
    before = cdc.hashed(rows("routes", route(1, [1]), route(2, [1])), e)
    after = cdc.hashed(rows("routes", route(2, [2]), route(3, [1])), e)
    got = sorted((r.validity.lower.month, r.operation_type) for r in cdc.changes(after, before, e).collect())
    assert got == [(1, "D"), (2, "U"), (3, "I")]


def test_replaying_the_journal_gives_the_snapshot(rows):
    e = ENTITIES["bookings"]
    states = [{"A": 1, "B": 2}, {"B": 3, "C": 4}, {"A": 5, "C": 4}]
    replayed, previous = {}, cdc.hashed(bookings(rows, **{}), e)
    for n, state in enumerate(states):
        current = cdc.hashed(bookings(rows, **state), e)
        for r in cdc.delta(current, previous, e, n, NOW).collect():
            if r.operation_type == "D":
                del replayed[r.book_ref]
            else:
                replayed[r.book_ref] = r.total_amount
        previous = current
        assert replayed == {k: Decimal(v) for k, v in state.items()}
