"""DM: the sales mart, the two marts built from it, and the dashboard queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.catalog import fixed_values as fv
from tierline.functions.expr import packed_key, unpacked_key
from tierline.operators.merge import upsert


def _renamed(df: DataFrame, prefix: str, columns: str) -> DataFrame:
    return df.selectExpr(*[f"{c} as {prefix}_{c}" for c in columns.split()])


def _packed(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumns({k: F.expr(packed_key(k)) for k in keys})


def _left(df: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    return df.join(parent, F.expr(on), "left")


def sales_rows(
    segments: DataFrame,
    tickets: DataFrame,
    passengers: DataFrame,
    bookings: DataFrame,
    flights: DataFrame,
    routes: DataFrame,
    airports: DataFrame,
    airplanes: DataFrame,
    loaded_at: str,
) -> DataFrame:
    """Ticket x flight rows with all names, one per live segment.

    Parents are joined to their own parents first (ticket with booking, flight with route, airports, airplane); every
    join is a left join on a unique key, so the grouping does not change the result, and the segments, by far the
    widest side, cross two shuffles instead of seven. Keys of facts and passengers are packed for the joins.
    """
    t = _renamed(tickets, "t", "ticket_sk bookings_sk passenger_sk ticket_no outbound batch_id is_deleted")
    b = _renamed(bookings, "b", "bookings_sk book_ref book_date total_amount batch_id is_deleted")
    p = _packed(_renamed(passengers, "p", "passenger_sk passenger_id"), "p_passenger_sk")
    t, b = _packed(t, "t_ticket_sk", "t_bookings_sk", "t_passenger_sk"), _packed(b, "b_bookings_sk")
    f = _renamed(
        flights,
        "f",
        "flight_sk route_sk flight_id status scheduled_departure scheduled_arrival actual_departure actual_arrival"
        " batch_id is_deleted",
    )
    r = _renamed(
        routes, "r", "route_sk route_no departure_airport_sk arrival_airport_sk airplane_sk duration batch_id"
    )
    dep, arr = (_renamed(airports, x, "airport_sk airport_name_ru batch_id") for x in ("dep", "arr"))
    a = _renamed(airplanes, "a", "airplane_sk model_ru batch_id")

    ticket = _left(_left(t, b, "t_bookings_sk = b_bookings_sk"), p, "t_passenger_sk = p_passenger_sk")
    route = _left(_left(r, dep, "r_departure_airport_sk = dep_airport_sk"), arr, "r_arrival_airport_sk = arr_airport_sk")
    flight = _left(f, _left(route, a, "r_airplane_sk = a_airplane_sk"), "f_route_sk = r_route_sk")
    flight = _packed(flight, "f_flight_sk")
    s = _renamed(segments.where("not is_deleted"), "s", "ticket_sk flight_sk price fare_conditions batch_id")
    s = _packed(s, "s_ticket_sk", "s_flight_sk")
    batches = ", ".join(f"coalesce({x}_batch_id, 0)" for x in ("s", "t", "b", "f", "r", "dep", "arr", "a"))
    return (
        _left(_left(s, ticket, "s_ticket_sk = t_ticket_sk"), flight, "s_flight_sk = f_flight_sk")
        .where(" and ".join(f"not coalesce({x}_is_deleted, false)" for x in ("t", "b", "f")))
        .selectExpr(
            "t_ticket_no as ticket_no",
            "f_flight_id as flight_id",
            "p_passenger_id as passenger_id",
            "r_route_no as route_no",
            "b_book_ref as book_ref",
            "b_total_amount as total_amount",
            "s_price as price",
            "s_fare_conditions as fare_conditions",
            "t_outbound as outbound",
            "b_book_date as book_date",
            "f_status as status",
            "f_scheduled_departure as scheduled_departure",
            "f_scheduled_arrival as scheduled_arrival",
            "f_actual_departure as actual_departure",
            "f_actual_arrival as actual_arrival",
            "r_duration as duration",
            "dep_airport_name_ru as departure_airport_name",
            "arr_airport_name_ru as arrival_airport_name",
            "a_model_ru as airplane_model",
            f"cast(greatest({batches}) as bigint) as source_max_batch_id",
            f"{loaded_at} as mart_load_date",
        )
    )


def changed_segments(
    segments: DataFrame,
    tickets: DataFrame,
    bookings: DataFrame,
    flights: DataFrame,
    routes: DataFrame,
    airports: DataFrame,
    airplanes: DataFrame,
    newest: int,
) -> DataFrame:
    """Segments that a batch later than `newest` has touched, themselves or through a parent.

    Changes travel down by key: airports and airplanes to routes, routes to flights, bookings to tickets. Each table is read
    once for the few columns this needs, and tested against the changed keys of its parents, which are small after a small batch.
    Where they are not, the tests shuffle, so keys of facts are packed for them.
    """
    later, columns = f"batch_id > {newest}", segments.columns
    segments, tickets = _packed(segments, "ticket_sk", "flight_sk"), _packed(tickets, "ticket_sk", "bookings_sk")
    bookings, flights = _packed(bookings, "bookings_sk"), _packed(flights, "flight_sk")
    names = {"ports": airports.where(later).select("airport_sk"), "models": airplanes.where(later).select("airplane_sk")}
    spark = segments.sparkSession
    changed_routes = spark.sql(
        f"select route_sk from {{routes}} where {later} or airplane_sk in (select airplane_sk from {{models}})"
        " or departure_airport_sk in (select airport_sk from {ports}) or arrival_airport_sk in (select airport_sk from {ports})",
        routes=routes,
        **names,
    )
    changed_flights = spark.sql(
        f"select flight_sk from {{flights}} where {later} or route_sk in (select route_sk from {{routes}})",
        flights=flights,
        routes=changed_routes,
    )
    changed_tickets = spark.sql(
        f"select ticket_sk from {{tickets}} where {later} or bookings_sk in (select bookings_sk from {{bookings}})",
        tickets=tickets,
        bookings=bookings.where(later).select("bookings_sk"),
    )
    found = spark.sql(
        f"select * from {{segments}} where {later} or ticket_sk in (select ticket_sk from {{tickets}})"
        " or flight_sk in (select flight_sk from {flights})",
        segments=segments,
        tickets=changed_tickets,
        flights=changed_flights,
    )
    return found.selectExpr(*[f"{unpacked_key(c)} as {c}" if c in ("ticket_sk", "flight_sk") else f"`{c}`" for c in columns])


#: With more segments than this share of a parent's rows, finding out which parents they have costs more than joining all.
FEW_SEGMENTS = 0.25


def only_parents_of(segments: DataFrame, parent: DataFrame, key: str, n_segments: int = 0, n_parents: int = 1) -> DataFrame:
    """The rows of a parent that some of the segments belong to, for a left join of the segments; all, where the segments are many."""
    if n_segments > FEW_SEGMENTS * n_parents:
        return parent
    return parent.join(segments.select(key), key, "left_semi")


def flight_sales(mart: DataFrame | None, rows: DataFrame) -> DataFrame:
    """Rows newer than the newest one in the mart are merged in; rows of deleted facts stay until rebuilt."""
    if mart is None:
        fresh = rows.where("source_max_batch_id > 0")
    else:
        newest = mart.agg(F.expr("coalesce(max(source_max_batch_id), 0)"))
        fresh = rows.where(F.col("source_max_batch_id") > newest.scalar())
    return upsert(mart, fresh, SALES_KEYS, checked=True)


SALES_KEYS = ["ticket_no", "flight_id"]
#: What the sales mart takes from segments.
SEGMENT_COLUMNS = ["ticket_sk", "flight_sk", "price", "fare_conditions", "batch_id", "is_deleted"]
TRAFFIC_KEYS = ["traffic_date", "airport_name"]


def _agg(grouped, *expressions: str) -> DataFrame:
    return grouped.agg(*[F.expr(e) for e in expressions])


#: A flight with more sales than this is dealt out by its passengers as well.
HOT_SALES = 100_000


def _by_flight(sales: DataFrame, hot: int = HOT_SALES) -> DataFrame:
    """Sales dealt out by flight, those of a hot flight, or of none, by flight and passenger; `part` follows from both.

    Nearly every sale is a (flight, passenger) of its own, so sums before the shuffle would only make its rows wider.
    """
    sizes = sales.where("flight_id is not null").groupBy("flight_id").agg(F.expr("count(*) as n"))
    crowded = sizes.where(f"n > {hot}").selectExpr("flight_id as hot_flight")
    found = sales.join(F.broadcast(crowded), F.expr("flight_id = hot_flight"), "left")
    part = "if(flight_id is null or hot_flight is not null, hash(passenger_id), null) as part"
    return found.selectExpr("flight_id", "passenger_id", "price", "fare_conditions", part).repartition("flight_id", "part")


def flight_revenue(sales: DataFrame) -> DataFrame:
    """Passengers and revenue per flight, total and by fare class.

    Measures: one narrow shuffle of the sales by flight, then one row per (flight, passenger), so that distinct passengers become plain
    counts, then one row per flight. A hot flight is spread over its passengers. Names: the few combinations of a flight with
    their number of prices, then the maximum of each name. The number keeps the first step a hash aggregate, which
    reduces the rows before the shuffle; the second one sorts, because Spark has no hash maximum of text, but only what
    is left. Both sides meet co-partitioned by flight.
    """
    classes = {f.lower(): f"fare_conditions = '{f}'" for f in fv.FARE_CONDITIONS}
    per_passenger = _agg(
        _by_flight(sales).groupBy("flight_id", "part", "passenger_id"),
        "sum(price) as revenue",
        "max(price) as max_price",
        "min(price) as min_price",
        *[f"sum(price) filter (where {cond}) as {f}_revenue" for f, cond in classes.items()],
        *[f"max({cond}) as in_{f}" for f, cond in classes.items()],
    )
    by_class = [
        e
        for f in classes
        for e in (
            f"count_if(passenger_id is not null and in_{f}) as {f}_passenger_count",
            f"coalesce(sum({f}_revenue), 0) as {f}_revenue",
        )
    ]
    measures = _agg(
        per_passenger.groupBy("flight_id"),
        "count(passenger_id) as passenger_count",
        "sum(revenue) as total_revenue",
        *by_class,
        "max(max_price) as max_price",
        "min(min_price) as min_price",
    )
    names = ["status", "duration", "departure_airport_name", "arrival_airport_name", "airplane_model"]
    combinations = _agg(sales.groupBy("flight_id", *names), "count(price) as prices")
    labels = _agg(combinations.groupBy("flight_id"), "sum(prices) as prices", *[f"max({c}) as {c}" for c in names])
    return measures.join(labels, "flight_id").selectExpr(
        "flight_id",
        "passenger_count",
        "total_revenue",
        *[f"{f}_{m}" for f in classes for m in ("passenger_count", "revenue")],
        "round(total_revenue / nullif(prices, 0), 2) as avg_price",
        "max_price",
        "min_price",
        *names,
    )


def _events(sales: DataFrame) -> DataFrame:
    def event(kind: str, side: str) -> str:
        return (
            f"named_struct('kind', '{kind}', 'airport_name', {side}_airport_name,"
            f" 'traffic_date', to_date(coalesce(actual_{side}, scheduled_{side})))"
        )

    both_ends = f"explode(array({event('d', 'departure')}, {event('a', 'arrival')})) as e"
    return (
        sales.selectExpr("flight_id", "passenger_id", "price", both_ends)
        .selectExpr("flight_id", "passenger_id", "price", "e.*")
        .where("airport_name is not null and traffic_date is not null")
    )


def days_of(sales: DataFrame) -> DataFrame:
    """The days and airports that some sales count for."""
    return _events(sales).select(*TRAFFIC_KEYS).distinct()


def airport_traffic(sales: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Flights, passengers and revenue per day and airport, departures and arrivals side by side; of all, or of `days` only.

    Each sale yields a departure and an arrival event. Passengers: first one row per (day, airport, side, passenger)
    with the revenue summed up, then counts; flights: their few distinct ids, then counts. Hot airports are spread
    over passengers and flights before the last shuffle, and no row is expanded for a distinct count.
    """

    def both(column: str, name: str, aggregate: str) -> list[str]:
        return [
            f"coalesce({aggregate}({column}) filter (where kind = '{kind}'), 0) as {name.format(side)}"
            for kind, side in (("d", "departure"), ("a", "arrival"))
        ]

    day, events = TRAFFIC_KEYS, _events(sales)
    if days is not None:
        events = events.join(days, day, "left_semi")
    per_passenger = _agg(events.groupBy(*day, "kind", "passenger_id"), "sum(price) as revenue")
    passengers = _agg(
        per_passenger.groupBy(*day),
        *both("passenger_id", "{}_passenger_count", "count"),
        *both("revenue", "{}_revenue", "sum"),
    )
    per_flight = events.select(*day, "kind", "flight_id").distinct()
    flights = _agg(per_flight.groupBy(*day), *both("flight_id", "{}s_count", "count"))
    # Both sides hold exactly the days and airports of the events.
    return passengers.join(flights, day).selectExpr(
        *day,
        "departures_count",
        "arrivals_count",
        "departure_passenger_count",
        "arrival_passenger_count",
        "departure_passenger_count + arrival_passenger_count as total_passenger_count",
        "departure_revenue",
        "arrival_revenue",
        "departure_revenue + arrival_revenue as total_revenue",
    )


# --- Dashboard ------------------------------------------------------------------------------------------------------


def revenue_by_day(sales: DataFrame) -> DataFrame:
    return _agg(sales.groupBy(F.expr("to_date(book_date) as book_day")), "sum(price) as revenue")


def _per_ticket(sales: DataFrame, *by: str) -> DataFrame:
    """One row per group and ticket with partial sums; distinct tickets become counts without expanding the rows."""
    return _agg(sales.groupBy(*by, "ticket_no"), "sum(price) as revenue", "count(price) as prices")


def kpis(sales: DataFrame) -> DataFrame:
    return _agg(
        _per_ticket(sales),
        "sum(revenue) as total_revenue",
        "round(sum(revenue) / nullif(sum(prices), 0), 2) as avg_ticket_price",
        "count(ticket_no) as ticket_count",
    )


def by_fare_class(sales: DataFrame) -> DataFrame:
    per_ticket = _per_ticket(sales, "fare_conditions").groupBy("fare_conditions")
    return _agg(per_ticket, "sum(revenue) as revenue", "count(ticket_no) as ticket_count")


def by_model(sales: DataFrame) -> DataFrame:
    return _agg(sales.groupBy("airplane_model"), "sum(price) as revenue")


def top_departure_airports(sales: DataFrame, n: int = 10) -> DataFrame:
    known = sales.where("departure_airport_name is not null").groupBy("departure_airport_name")
    totals = _agg(known, "sum(price) as revenue", "count(*) as segment_count")
    return totals.orderBy(F.desc("revenue"), "departure_airport_name").limit(n)


def top_routes(sales: DataFrame, n: int = 10) -> DataFrame:
    totals = _agg(sales.where("route_no is not null").groupBy("route_no"), "sum(price) as revenue")
    return totals.orderBy(F.desc("revenue"), "route_no").limit(n)
