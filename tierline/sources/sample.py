"""The nine source tables derived from the star-schema sample tables, in three states.

state "all":    every row.
state "before": the earlier snapshot; rows marked new are absent, rows marked changed have their old value.
state "after":  the later snapshot; rows marked gone are absent.
Marks come from business columns, and every row of a table is in at least one of the two snapshots.

Seats and line items by part are aggregates of the line items. `keep` may write them once for readers that come back for more states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.catalog import fixed_values as fv
from tierline.catalog.entities import ENTITIES
from tierline.functions.expr import SPARK_TYPE, in_range, quoted

BASE_MICROS = 1_577_836_800_000_000  # 2020-01-01 00:00:00 UTC
MINUTE = 60_000_000
HOUR = 60 * MINUTE
WINDOW_HOURS = 500  # length of one route validity window; four windows follow each other

# entity -> (column, its value before the change)
OLD_VALUE = {
    "airplanes": ("speed", "speed + 5"),
    "airports": ("timezone", "'Etc/GMT'"),
    "routes": ("days_of_week", "array(2, 4, 6)"),
    "seats": ("fare_conditions", "'Comfort'"),
    "flights": ("scheduled_arrival", "scheduled_arrival + interval '1' minute"),
    "bookings": ("total_amount", "total_amount + 1"),
    "tickets": ("passenger_name", "upper(passenger_name)"),
    "segments": ("price", "price + 1"),
    "boarding_passes": ("boarding_no", "boarding_no + 1"),
}


def _padded(number: str, digits: int = 3) -> str:
    """With leading zeros up to so many digits; longer numbers stay whole."""
    text = f"cast({number} as string)"
    return f"lpad({text}, greatest({digits}, length({text})), '0')"


def _airport(number: str) -> str:
    return f"concat('N', {_padded(number, 2)})"


def _names(en: str, ru: str) -> str:
    return f"to_json(named_struct('en', {en}, 'ru', {ru}))"


def _mark(new: str, gone: str, changed: str) -> str:
    return f"case when {new} then 'new' when {gone} then 'gone' when {changed} then 'changed' else 'same' end as mark"


def _micros(expression: str) -> str:
    return f"timestamp_micros(cast({expression} as bigint))"


def _departure(part: str) -> str:
    return f"({BASE_MICROS} + pmod({part}, 2000) * {HOUR} + {part} div 2000)"


ORDER_MARK = _mark("o_orderpriority = '1-URGENT'", "o_orderpriority = '5-LOW'", "o_orderpriority = '2-HIGH'")
LINE_MARK = _mark("line = 1", "line = 2", "line = 3")


class SampleSources:
    def __init__(self, spark: SparkSession, sf_dir: str, keep: Callable[[str, DataFrame], DataFrame] = lambda name, rows: rows):
        self.spark = spark
        self.sf_dir = sf_dir
        self.keep = keep
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def source(self, entity: str, state: str = "all") -> DataFrame:
        df = getattr(self, f"_{entity}")()
        changed, old = OLD_VALUE[entity]
        if state == "before":
            df = df.where("mark <> 'new'")
        elif state == "after":
            df = df.where("mark <> 'gone'")
        return df.selectExpr(
            *[
                f"cast(if(mark = 'changed', {old}, {c}) as {SPARK_TYPE[k]}) as {c}"
                if state == "before" and c == changed
                else f"cast({c} as {SPARK_TYPE[k]}) as {c}"
                for c, k in ENTITIES[entity].columns
            ]
        )

    def _airplanes(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            f"{_padded('s_suppkey')} as airplane_code",
            f"{_names('s_name', 'lower(s_name)')} as model",
            "1000 + s_suppkey as range",
            "500 + s_nationkey as speed",
            _mark("s_nationkey < 5", "s_nationkey between 5 and 9", "s_nationkey between 10 and 14"),
        )

    def _airports(self) -> DataFrame:
        named = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
        return named.selectExpr(
            f"{_airport('n_nationkey')} as airport_code",
            f"{_names('n_name', 'n_name')} as airport_name",
            f"{_names('n_name', 'n_name')} as city",
            f"{_names('r_name', 'r_name')} as country",
            "named_struct('lon', cast(n_nationkey * 10 as double), 'lat', cast(n_regionkey * 10 as double)) as coordinates",
            "'UTC' as timezone",
            _mark("n_regionkey = 0", "n_regionkey = 1", "n_regionkey = 2"),
        )

    def _routes(self) -> DataFrame:
        brands = self.table("part").select("p_brand").distinct()
        seasons = brands.selectExpr(
            "p_brand as route_no", r"cast(regexp_extract(p_brand, '([0-9]+)$', 1) as int) as b", "explode(sequence(0, 3)) as w"
        )
        # Supplier keys are numbers without gaps; a large prime spreads the routes over all of them.
        known = self.table("supplier").agg(F.expr("min(s_suppkey)")).scalar(), self.table("supplier").agg(F.expr("count(*)")).scalar()
        seasons = seasons.withColumns({"first": known[0], "airplanes": known[1]})
        low, high = (_micros(f"{BASE_MICROS} + cast({n} as bigint) * {WINDOW_HOURS * HOUR}") for n in ("w", "(w + 1)"))
        return seasons.selectExpr(
            "route_no",
            f"named_struct('lower', {low}, 'upper', {high}) as validity",
            f"{_airport('b % 25')} as departure_airport",
            f"{_airport('(b + 1 + w) % 25')} as arrival_airport",
            f"{_padded('first + pmod((b * 4 + w) * 7919, airplanes)')} as airplane_code",
            "array(1, 3, 5) as days_of_week",
            "'11:00:00' as scheduled_time",
            "make_dt_interval(0, 0, b + 60, 0) as duration",
            _mark("w = 3", "w = 0", "w = 1"),
        )

    def _seats(self) -> DataFrame:
        numbers = self.keep("seat_numbers", self.table("lineitem").select("l_suppkey", "l_linenumber").distinct())
        return numbers.selectExpr(
            f"{_padded('l_suppkey')} as airplane_code",
            "concat(l_linenumber, 'A') as seat_no",
            "case l_linenumber when 1 then 'Business' when 2 then 'Comfort' else 'Economy' end as fare_conditions",
            _mark("l_linenumber = 1", "l_linenumber = 2", "l_linenumber = 3"),
        )

    def _flights(self) -> DataFrame:
        departure = _departure("p_partkey")
        arrival = f"({departure} + cast(p_size + 30 as bigint) * {MINUTE})"
        statuses = ", ".join(quoted(s) for s in fv.FLIGHT_STATUSES)
        return self.table("part").selectExpr(
            "p_partkey as flight_id",
            "p_brand as route_no",
            f"element_at(array({statuses}), cast(pmod(p_partkey, 7) + 1 as int)) as status",
            f"{_micros(departure)} as scheduled_departure",
            f"{_micros(arrival)} as scheduled_arrival",
            f"if(pmod(p_partkey, 3) = 0, null, {_micros(f'{departure} + {5 * MINUTE}')}) as actual_departure",
            f"if(pmod(p_partkey, 3) = 0 or pmod(p_partkey, 5) = 0, null, {_micros(f'{arrival} + {7 * MINUTE}')})"
            " as actual_arrival",
            _mark("p_type = 'PROMO'", "p_type = 'SMALL'", "p_type = 'LARGE'"),
        )

    def _bookings(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "cast(o_orderkey as string) as book_ref",
            "cast(o_orderdate as timestamp) as book_date",
            "cast(o_totalprice as decimal(10,2)) as total_amount",
            ORDER_MARK,
        )

    def _tickets(self) -> DataFrame:
        customer = self.table("customer").selectExpr("c_custkey as o_custkey", "c_name")
        return (
            self.table("orders")
            .join(customer, "o_custkey")
            .selectExpr(
                "cast(o_orderkey as string) as ticket_no",
                "cast(o_orderkey as string) as book_ref",
                "cast(o_custkey as string) as passenger_id",
                "c_name as passenger_name",
                "o_orderstatus = 'F' as outbound",
                ORDER_MARK,
            )
        )

    def _order_parts(self) -> DataFrame:
        """Line items per (order, part): that pair is a key, (order, line number) is not.

        The one-letter flags are compared as numbers, which keeps the aggregate hash-based.
        """
        smallest = ["min(ascii(l_returnflag)) as flag", "min(ascii(l_linestatus)) as status", "min(l_linenumber) as line"]
        parts = (
            self.table("lineitem")
            .groupBy("l_orderkey", "l_partkey")
            .agg(F.expr("sum(cast(l_extendedprice as decimal(10,2))) as price"), *[F.expr(e) for e in smallest])
            .selectExpr("l_orderkey", "l_partkey", "price", "char(flag) as flag", "char(status) as status", "line")
        )
        return self.keep("order_parts", parts)

    def _segments(self) -> DataFrame:
        return self._order_parts().selectExpr(
            "cast(l_orderkey as string) as ticket_no",
            "l_partkey as flight_id",
            "case flag when 'A' then 'Economy' when 'N' then 'Comfort' else 'Business' end as fare_conditions",
            "cast(price as decimal(10,2)) as price",
            LINE_MARK,
        )

    def _boarding_passes(self) -> DataFrame:
        # The pass number is taken from the ticket, not from a rank within the flight: a rank would sort a hot flight in
        # one task. The seat holds the whole number; a pass number beyond the column's range is unknown.
        number = "(l_orderkey + 1)"
        return (
            self._order_parts()
            .where("status = 'F'")
            .selectExpr(
                "cast(l_orderkey as string) as ticket_no",
                "l_partkey as flight_id",
                f"concat(cast({number} as string), 'B') as seat_no",
                f"try_cast({number} as int) as boarding_no",
                f"{_micros(_departure('l_partkey') + f' - {30 * MINUTE}')} as boarding_time",
                LINE_MARK,
            )
        )

    def sales(self) -> DataFrame:
        """Rows of the sales mart for state "all", joined by natural keys straight from the sources."""
        airports = self.source("airports")
        models = self.source("airplanes").selectExpr("airplane_code", "get_json_object(model, '$.ru') as airplane_model")

        def airport(side: str) -> DataFrame:
            return airports.selectExpr(
                f"airport_code as {side}_airport", f"get_json_object(airport_name, '$.ru') as {side}_airport_name"
            )

        routes = (
            self.source("routes")
            .join(airport("departure"), "departure_airport")
            .join(airport("arrival"), "arrival_airport")
            .join(models, "airplane_code")
            .select(
                "route_no", "validity", "duration", "departure_airport_name", "arrival_airport_name", "airplane_model"
            )
        )
        in_force = in_range("scheduled_departure", "validity")
        flights = self.source("flights").join(routes, "route_no").where(in_force).drop("validity")
        orders = self.table("orders").selectExpr(
            "cast(o_orderkey as string) as ticket_no",
            "cast(o_custkey as string) as passenger_id",
            "cast(o_orderkey as string) as book_ref",
            "cast(o_totalprice as decimal(10,2)) as total_amount",
            "o_orderstatus = 'F' as outbound",
            "cast(o_orderdate as timestamp) as book_date",
        )
        return self.source("segments").join(orders, "ticket_no").join(flights, "flight_id")
