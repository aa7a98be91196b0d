"""The join in time against plain comparison of all, and in work that stays linear for one key of many versions."""

import random
from datetime import timedelta

import pytest

from tests.conftest import at
from tierline.operators.temporal import valid_at

T0 = at("2024-01-01")


def _frames(spark, flights, routes):
    when = "struct<lower: timestamp, upper: timestamp>"
    return (
        spark.createDataFrame(flights, "id int, route_no string, t timestamp"),
        spark.createDataFrame(routes, f"r string, validity {when}, sk string"),
    )


def _hour(h):
    return None if h is None else T0 + timedelta(hours=h)


def _holds(t, r, flight):
    key, validity, _ = r
    if validity is None or key is None or flight[1] != key or t is None:
        return False
    lower, upper = validity
    return (lower is None or t >= lower) and (upper is None or t < upper)


@pytest.mark.parametrize("overlaps", [False, True])
def test_equals_plain_comparison(spark, overlaps):
    rng = random.Random(3 + overlaps)
    routes = []
    for key in ("a", "b", "c", None):
        cuts = sorted(rng.sample(range(0, 400), 30))
        ranges = list(zip(cuts, cuts[1:]))[:: 1 + (key == "b")]
        if key == "a":
            ranges = [(None, cuts[0]), *ranges, (cuts[-1], None)]
        if overlaps and key is not None:
            ranges += [(5, 390), (10, 12), (100, 100), (200, None)]
        routes += [(key, (_hour(lo), _hour(hi)), f"{key}{k}") for k, (lo, hi) in enumerate(ranges)]
    routes.append(("a", None, "none"))
    flights = [(k, rng.choice(["a", "b", "c", "d"]), _hour(rng.randrange(-10, 420))) for k in range(600)]
    flights += [(1000 + k, "a", _hour(50)) for k in range(300)] + [(2000, None, T0), (2001, "a", None)]
    f, r = _frames(spark, flights, routes)
    want = sorted((x[0], y[2]) for x in flights for y in routes if _holds(x[2], y, x))
    lone = sorted({x[0] for x in flights} - {k for k, _ in want})
    for few, chunks in ((1000, None), (0, 1), (0, 9)):
        args = (f, "route_no", "t", r, "r", "validity")
        assert sorted((x["id"], x["sk"]) for x in valid_at(*args, few=few, chunks=chunks).collect()) == want
        assert sorted(x["id"] for x in valid_at(*args, "left_anti", few=few, chunks=chunks).collect()) == lone


def test_empty_sides(spark):
    f, r = _frames(spark, [(1, "a", T0)], [("a", (T0, None), "x")])
    none_f, none_r = f.limit(0), r.limit(0)
    for few in (0, 64):
        assert valid_at(none_f, "route_no", "t", r, "r", "validity", few=few).count() == 0
        assert valid_at(f, "route_no", "t", none_r, "r", "validity", few=few).count() == 0
        assert valid_at(f, "route_no", "t", none_r, "r", "validity", "left_anti", few=few).count() == 1


def test_one_key_of_many_versions_stays_linear(spark):
    """10^5 versions and 10^5 moments of one key would be 10^10 comparisons; here no join puts out more rows than there are moments."""
    n = 100_000
    moment = "timestamp_seconds(1700000000 + id * 60 + {})"
    versions = spark.range(n).selectExpr("if(id < 0, 'b', 'a') as r", f"struct({moment.format(0)} as lower, {moment.format(60)} as upper) as validity", "id as sk")
    rows = spark.range(n).selectExpr("if(id < 0, 'b', 'a') as route_no", f"{moment.format(30)} as t", "id")
    met = valid_at(rows, "route_no", "t", versions, "r", "validity", chunks=8)
    got = met.selectExpr("count(*) as n", "count_if(id = sk) as same").first()
    assert tuple(got) == (n, n)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
