import random
from datetime import datetime, timedelta

import pytest

from tierline.operators import integrity

D0 = datetime(2024, 1, 1)


def brute(rows, broken):
    groups = {}
    for k, a, b in rows:
        groups.setdefault(k, []).append((a, b))
    n = 0
    for g in groups.values():
        g.sort()
        n += sum(broken(g[i - 1][1], g[i][0]) for i in range(1, len(g)))
    return n


@pytest.mark.parametrize("chunks", [None, 3, 16])
@pytest.mark.parametrize(
    "name, broken", [(integrity.OVERLAPS, lambda p, s: p > s), (integrity.GAPS, lambda p, s: p < s)]
)
def test_neighbours_with_a_hot_key_and_copies(spark, chunks, name, broken):
    rng = random.Random(3)
    rows = []
    for _ in range(900):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 30)}"
        start = D0 + timedelta(hours=rng.randint(0, 400))
        rows.append((key, start, start + timedelta(hours=rng.randint(1, 3))))
    rows += [("copied", D0, D0 + timedelta(hours=1))] * 450
    df = spark.createDataFrame(rows, "k string, a timestamp, b timestamp").repartition(6)
    got = integrity.neighbours(df, "k", "a", "b", name, chunks).first().violations
    assert got == brute(rows, broken)


def test_neighbours_of_nothing(spark):
    df = spark.createDataFrame([], "k string, a timestamp, b timestamp")
    assert integrity.neighbours(df, "k", "a", "b", integrity.OVERLAPS).first().violations == 0


def brute_overlaps(rows):
    groups = {}
    for k, a, b in rows:
        groups.setdefault(k, []).append((a, b))
    n = 0
    for g in groups.values():
        g.sort()
        n += sum(any(p[1] > g[i][0] for p in g[:i]) for i in range(len(g)))
    return n


@pytest.mark.parametrize("chunks", [None, 3, 16])
def test_overlaps_with_any_earlier_period(spark, chunks):
    rng = random.Random(4)
    hours = lambda n: D0 + timedelta(hours=n)
    rows = [("contained", hours(0), hours(10)), ("contained", hours(1), hours(2)), ("contained", hours(3), hours(4)), ("contained", hours(10), hours(11))]
    for _ in range(500):
        start = rng.randint(0, 4000)
        key = "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 30)}"
        rows.append((key, hours(start), hours(start + rng.choice([0, 1, 2, 3, 400]))))
    rows += [("copied", hours(0), hours(1))] * 100 + [("empty", hours(0), hours(0))] * 5
    df = spark.createDataFrame(rows, "k string, a timestamp, b timestamp").repartition(6)
    assert integrity.overlapping(df, "k", "a", "b", chunks).first().violations == brute_overlaps(rows)
    assert integrity.overlapping(df.where("k = 'contained'"), "k", "a", "b", chunks).first().violations == 2
    assert integrity.overlapping(df.where("false"), "k", "a", "b", chunks).first().violations == 0


def test_duplicate_and_null_keys(spark):
    rows = [("A", 1), ("A", 1), ("A", 2), ("B", None), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "a string, b int")
    primary = {(r.a, r.b): r.rows for r in integrity.duplicate_keys(df, ["a", "b"]).collect()}
    assert primary == {("A", 1): 2, ("B", None): 1, (None, None): 2}
    unique = {(r.a, r.b): r.rows for r in integrity.duplicate_keys(df, ["a", "b"], nulls_are_bad=False).collect()}
    assert unique == {("A", 1): 2}


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "p int")
    parent = spark.createDataFrame([(1,), (4,)], "id int")
    assert {r.fk_0: r.rows for r in integrity.orphans(child, ["p"], parent, ["id"]).collect()} == {2: 1, 3: 1}


def test_broken_rules(spark):
    df = spark.createDataFrame([(1, "a"), (-1, "b"), (None, "c")], "x int, y string")
    got = {r.rule: r.violations for r in integrity.broken_rules(df, {"positive": "x > 0", "known": "y in ('a', 'b')"}).collect()}
    assert got == {"positive": 1, "known": 1}
