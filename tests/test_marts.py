"""Marts against plain Python over the same rows."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tierline.plans import marts

SCHEMA = """ticket_no string, flight_id int, passenger_id string, route_no string, book_ref string, price decimal(10,2),
    fare_conditions string, book_date timestamp, status string, scheduled_departure timestamp, scheduled_arrival timestamp,
    actual_departure timestamp, actual_arrival timestamp, duration interval day to second,
    departure_airport_name string, arrival_airport_name string, airplane_model string"""


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    rows = []
    for n in range(1500):
        # One flight, one airport and one passenger hold a third of the rows.
        flight = 1 if rng.random() < 0.34 else rng.randint(2, 20)
        passenger = None if rng.random() < 0.05 else ("P1" if rng.random() < 0.34 else f"P{rng.randint(2, 60)}")
        departure = datetime(2024, 1, 1) + timedelta(hours=7 * (flight % 9))
        arrival = departure + timedelta(hours=rng.choice([3, 30]))
        late = timedelta(hours=20) if flight % 4 == 0 else timedelta(0)
        rows.append((
            f"T{n // 2}", flight, passenger, f"R{flight % 5}", f"B{n // 2}", Decimal(rng.randint(0, 100000)) / 100,
            "Economy" if flight == 3 else rng.choice(["Economy", "Comfort", "Business"]), datetime(2024, 1, 1 + n % 5, 22),
            rng.choice(["Arrived", "Delayed"]), departure, arrival,
            departure + late if flight % 3 else None, arrival + late if flight % 2 else None,
            timedelta(minutes=60 + flight), None if flight == 5 else f"A{flight % 3}", f"A{(flight + 1) % 3}", f"M{flight % 4}",
        ))
    return rows


NAMES = [c.split()[0] for c in SCHEMA.replace("\n", " ").replace("decimal(10,2)", "decimal").split(",")]


@pytest.fixture(scope="module")
def sales(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


def as_dicts(data):
    return [dict(zip(NAMES, r)) for r in data]


def cents(x):
    return Decimal(x).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_flight_revenue(sales, data):
    groups = defaultdict(list)
    for r in as_dicts(data):
        groups[r["flight_id"]].append(r)
    got = {r.flight_id: r for r in marts.flight_revenue(sales).collect()}
    assert set(got) == set(groups)
    for flight, rows in groups.items():
        g = got[flight]
        prices = [r["price"] for r in rows]
        assert g.passenger_count == len({r["passenger_id"] for r in rows if r["passenger_id"]})
        assert (g.total_revenue, g.max_price, g.min_price) == (sum(prices), max(prices), min(prices))
        assert g.avg_price == cents(sum(prices) / len(prices))
        for fare in ("Economy", "Comfort", "Business"):
            part = [r for r in rows if r["fare_conditions"] == fare]
            assert g[f"{fare.lower()}_passenger_count"] == len({r["passenger_id"] for r in part if r["passenger_id"]})
            assert g[f"{fare.lower()}_revenue"] == sum(r["price"] for r in part)
        for c in ("status", "duration", "departure_airport_name", "arrival_airport_name", "airplane_model"):
            assert g[c] == max((r[c] for r in rows if r[c] is not None), default=None)


def test_airport_traffic(sales, data):
    want = defaultdict(lambda: [set(), set(), set(), set(), Decimal(0), Decimal(0)])
    for r in as_dicts(data):
        for i, side in enumerate(("departure", "arrival")):
            when = r[f"actual_{side}"] or r[f"scheduled_{side}"]
            name = r[f"{side}_airport_name"]
            if name is None or when is None:
                continue
            cell = want[(when.date(), name)]
            cell[i].add(r["flight_id"])
            cell[2 + i] |= {r["passenger_id"]} - {None}
            cell[4 + i] += r["price"]
    got = {(r.traffic_date, r.airport_name): r for r in marts.airport_traffic(sales).collect()}
    assert set(got) == set(want)
    for key, (df, af, dp, ap, dr, ar) in want.items():
        g = got[key]
        assert (g.departures_count, g.arrivals_count) == (len(df), len(af))
        assert (g.departure_passenger_count, g.arrival_passenger_count) == (len(dp), len(ap))
        assert g.total_passenger_count == len(dp) + len(ap)
        assert (g.departure_revenue, g.arrival_revenue, g.total_revenue) == (dr, ar, dr + ar)


def test_dashboard(sales, data):
    rows = as_dicts(data)
    total = sum(r["price"] for r in rows)
    k = marts.kpis(sales).first()
    assert (k.total_revenue, k.avg_ticket_price) == (total, cents(total / len(rows)))
    assert k.ticket_count == len({r["ticket_no"] for r in rows})
    by_day = defaultdict(Decimal)
    for r in rows:
        by_day[r["book_date"].date()] += r["price"]
    assert {r.book_day: r.revenue for r in marts.revenue_by_day(sales).collect()} == dict(by_day)
    fares = {r.fare_conditions: (r.revenue, r.ticket_count) for r in marts.by_fare_class(sales).collect()}
    for fare, (revenue, tickets) in fares.items():
        part = [r for r in rows if r["fare_conditions"] == fare]
        assert (revenue, tickets) == (sum(r["price"] for r in part), len({r["ticket_no"] for r in part}))
    routes = defaultdict(Decimal)
    for r in rows:
        routes[r["route_no"]] += r["price"]
    top = [(r.route_no, r.revenue) for r in marts.top_routes(sales, 3).collect()]
    assert top == sorted(routes.items(), key=lambda x: (-x[1], x[0]))[:3]
    assert sum(r.revenue for r in marts.by_model(sales).collect()) == total
    assert marts.top_departure_airports(sales, 2).count() == 2


def test_sales_mart_merges_rows_above_its_watermark(spark):
    def rows(*values):
        return spark.createDataFrame(
            values, "ticket_no string, flight_id int, price int, source_max_batch_id bigint"
        )

    mart = marts.flight_sales(None, rows(("A", 1, 10, 3), ("B", 1, 20, 5)))
    got = marts.flight_sales(mart, rows(("A", 1, 11, 5), ("B", 1, 21, 6), ("C", 1, 30, 7), ("D", 1, 1, 4)))
    # Batch 5 is already in: A stays. The deleted-row case is the same: nothing newer, nothing touched.
    assert sorted((r.ticket_no, r.price) for r in got.collect()) == [("A", 10), ("B", 21), ("C", 30)]
