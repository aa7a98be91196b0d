import pytest

from tierline.functions.expr import ts
from tierline.operators import history

TRACKED = [("name", "text"), ("size", "int"), ("spot", "point")]


def ods(spark, batch, *rows):
    """Rows: (code, name, size, deleted)."""
    data = [(c, n, s, (1.0, 2.0) if s != 99 else (3.0, 2.0), "sys", "src", batch, d) for c, n, s, d in rows]
    return spark.createDataFrame(
        data,
        "code string, name string, size int, spot struct<lon:double,lat:double>, source_system string,"
        " record_source string, updated_batch_id bigint, is_deleted boolean",
    )


def load(spark, dim, batch, month, *rows):
    return history.scd2_merge(dim, ods(spark, batch, *rows), "code", "sk", TRACKED, ts(f"2024-{month:02d}-01"))


def versions(dim, code):
    picked = dim.where(f"code = '{code}'").orderBy("valid_from").collect()
    return [(r.name, r.valid_from.month, r.valid_to.year if r.is_current else r.valid_to.month, r.is_current, r.batch_id) for r in picked]


def test_versions_over_several_loads(spark):
    one = load(spark, None, 1, 1, ("A", "a", 1, False), ("B", "b", 1, False), ("C", "c", 1, False), ("X", "x", 1, True))
    assert versions(one, "X") == []
    two = load(spark, one, 2, 2, ("A", "a", 1, False), ("B", "b2", 1, False), ("C", "c", 1, True))
    assert versions(two, "A") == [("a", 1, 9999, True, 1)]
    assert versions(two, "B") == [("b", 1, 2, False, 2), ("b2", 2, 9999, True, 2)]
    assert versions(two, "C") == [("c", 1, 2, False, 2)]
    three = load(spark, two, 3, 3, ("A", "a", 99, False), ("B", "b3", 1, False), ("C", "c", 1, True))
    assert [v[1:4] for v in versions(three, "A")] == [(1, 3, False), (3, 9999, True)]
    assert len(versions(three, "B")) == 3
    # Deleted and back: a gap in between.
    four = load(spark, three, 4, 5, ("C", "c", 1, False))
    assert versions(four, "C") == [("c", 1, 2, False, 2), ("c", 5, 9999, True, 4)]
    assert four.select("sk").distinct().count() == four.count()
    assert tuple(history.version_counts(four).first()) == (7, 3, 4)


def test_keys_without_an_ods_row_stay(spark):
    one = load(spark, None, 1, 1, ("A", "a", 1, False))
    assert versions(load(spark, one, 2, 2, ("B", "b", 1, False)), "A") == [("a", 1, 9999, True, 1)]


def test_null_compares_like_blank(spark):
    one = load(spark, None, 1, 1, ("A", None, None, False))
    assert len(versions(load(spark, one, 2, 2, ("A", "", -1, False)), "A")) == 1


def test_effective_time_must_move_forward(spark):
    one = load(spark, None, 1, 3, ("A", "a", 1, False))
    with pytest.raises(Exception, match="starts at or after"):
        load(spark, one, 2, 3, ("A", "changed", 1, False)).collect()
    assert load(spark, one, 2, 3, ("A", "a", 1, False)).count() == 1
