"""The nine entities as data: columns, keys, hash columns, cleansing and validation rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from tierline.catalog import fixed_values as fv
from tierline.functions.expr import SPARK_TYPE


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when `broken` is true; NULL does not break it."""

    broken: str
    message: str


def empty(column: str) -> Rule:
    return Rule(f"{column} is null or trim({column}) = ''", f"{column} is empty")


def missing(column: str) -> Rule:
    return Rule(f"{column} is null", f"{column} is null")


def not_positive(column: str) -> Rule:
    return Rule(f"{column} is null or {column} <= 0", f"{column} must be greater than 0")


def negative(column: str) -> Rule:
    return Rule(f"{column} < 0", f"{column} must be greater than or equal to 0")


def not_after(later: str, earlier: str) -> Rule:
    return Rule(f"{later} <= {earlier}", f"{later} must be greater than {earlier}")


def outside(column: str, values: tuple[str, ...]) -> Rule:
    listed = ", ".join(f"'{v}'" for v in values)
    return Rule(f"trim({column}) <> '' and {column} not in ({listed})", f"{column} is invalid")


BAD_OPERATION = Rule("operation_type not in ('I', 'U', 'D')", "operation_type is invalid")


@dataclass(frozen=True)
class Cleaned:
    """One STAGE column: its name, kind and how it is cut from the RAW row."""

    name: str
    kind: str
    how: str = "keep"  # keep | code | text | upper_text | json:<source column>.<field>

    def sql(self) -> str:
        text = f"nullif(trim({self.name}), '')"
        if self.how == "code":
            return f"upper(trim({self.name})) as {self.name}"
        if self.how == "text":
            return f"{text} as {self.name}"
        if self.how == "upper_text":
            return f"upper({text}) as {self.name}"
        if self.how.startswith("json:"):
            source, key = self.how[5:].split(".")
            return f"nullif(trim(get_json_object({source}, '$.{key}')), '') as {self.name}"
        return self.name


@dataclass(frozen=True)
class Entity:
    name: str
    source_object: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    stage: tuple[Cleaned, ...]
    rules: tuple[Rule, ...]
    unhashed: tuple[str, ...] = field(default=())

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def hash_columns(self) -> list[tuple[str, str]]:
        return [(c, k) for c, k in self.columns if c not in self.unhashed]

    @property
    def stage_names(self) -> list[str]:
        return [c.name for c in self.stage]

    @property
    def record_source(self) -> str:
        return fv.RECORD_SOURCE_PREFIX + self.source_object

    @property
    def source_schema(self) -> str:
        return ", ".join(f"`{c}` {SPARK_TYPE[k]}" for c, k in self.columns)


def _both_languages(*names: str) -> tuple[Cleaned, ...]:
    return tuple(Cleaned(f"{n}_{lang}", "text", f"json:{n}.{lang}") for n in names for lang in ("en", "ru"))


AIRPLANES = Entity(
    name="airplanes",
    source_object="airplanes_data",
    columns=(("airplane_code", "text"), ("model", "json"), ("range", "int"), ("speed", "int")),
    keys=("airplane_code",),
    stage=(
        Cleaned("airplane_code", "text", "code"),
        *_both_languages("model"),
        Cleaned("range", "int"),
        Cleaned("speed", "int"),
    ),
    rules=(
        empty("airplane_code"),
        BAD_OPERATION,
        missing("model_en"),
        missing("model_ru"),
        not_positive("range"),
        not_positive("speed"),
    ),
)

AIRPORTS = Entity(
    name="airports",
    source_object="airports_data",
    columns=(
        ("airport_code", "text"),
        ("airport_name", "json"),
        ("city", "json"),
        ("country", "json"),
        ("coordinates", "point"),
        ("timezone", "text"),
    ),
    keys=("airport_code",),
    unhashed=("coordinates",),
    stage=(
        Cleaned("airport_code", "text", "code"),
        *_both_languages("airport_name", "city", "country"),
        Cleaned("coordinates", "point"),
        Cleaned("timezone", "text", "text"),
    ),
    rules=(
        empty("airport_code"),
        BAD_OPERATION,
        missing("airport_name_en"),
        missing("airport_name_ru"),
        missing("city_en"),
        missing("city_ru"),
        missing("country_en"),
        missing("country_ru"),
        missing("coordinates"),
        empty("timezone"),
    ),
)

ROUTES = Entity(
    name="routes",
    source_object="routes",
    columns=(
        ("route_no", "text"),
        ("validity", "range"),
        ("departure_airport", "text"),
        ("arrival_airport", "text"),
        ("airplane_code", "text"),
        ("days_of_week", "int_array"),
        ("scheduled_time", "time"),
        ("duration", "interval"),
    ),
    keys=("route_no", "validity"),
    stage=(
        Cleaned("route_no", "text", "text"),
        Cleaned("validity", "range"),
        Cleaned("departure_airport", "text", "upper_text"),
        Cleaned("arrival_airport", "text", "upper_text"),
        Cleaned("airplane_code", "text", "upper_text"),
        Cleaned("days_of_week", "int_array"),
        Cleaned("scheduled_time", "time"),
        Cleaned("duration", "interval"),
    ),
    rules=(
        empty("route_no"),
        missing("validity"),
        empty("departure_airport"),
        empty("arrival_airport"),
        Rule("departure_airport = arrival_airport", "departure_airport equals arrival_airport"),
        empty("airplane_code"),
        missing("days_of_week"),
        missing("scheduled_time"),
        missing("duration"),
        Rule("duration <= interval '0' second", "duration must be greater than 0"),
        BAD_OPERATION,
    ),
)

SEATS = Entity(
    name="seats",
    source_object="seats",
    columns=(("airplane_code", "text"), ("seat_no", "text"), ("fare_conditions", "text")),
    keys=("airplane_code", "seat_no"),
    stage=(
        Cleaned("airplane_code", "text", "upper_text"),
        Cleaned("seat_no", "text", "text"),
        Cleaned("fare_conditions", "text", "text"),
    ),
    rules=(
        empty("airplane_code"),
        empty("seat_no"),
        empty("fare_conditions"),
        outside("fare_conditions", fv.FARE_CONDITIONS),
        BAD_OPERATION,
    ),
)

FLIGHTS = Entity(
    name="flights",
    source_object="flights",
    columns=(
        ("flight_id", "int"),
        ("route_no", "text"),
        ("status", "text"),
        ("scheduled_departure", "timestamp"),
        ("scheduled_arrival", "timestamp"),
        ("actual_departure", "timestamp"),
        ("actual_arrival", "timestamp"),
    ),
    keys=("flight_id",),
    stage=(
        Cleaned("flight_id", "int"),
        Cleaned("route_no", "text", "text"),
        Cleaned("status", "text", "text"),
        Cleaned("scheduled_departure", "timestamp"),
        Cleaned("scheduled_arrival", "timestamp"),
        Cleaned("actual_departure", "timestamp"),
        Cleaned("actual_arrival", "timestamp"),
    ),
    rules=(
        missing("flight_id"),
        empty("route_no"),
        empty("status"),
        outside("status", fv.FLIGHT_STATUSES),
        missing("scheduled_departure"),
        missing("scheduled_arrival"),
        not_after("scheduled_arrival", "scheduled_departure"),
        Rule(
            "actual_arrival is not null and actual_departure is null",
            "actual_departure is null while actual_arrival is not null",
        ),
        not_after("actual_arrival", "actual_departure"),
        BAD_OPERATION,
    ),
)

BOOKINGS = Entity(
    name="bookings",
    source_object="bookings",
    columns=(("book_ref", "text"), ("book_date", "timestamp"), ("total_amount", "decimal")),
    keys=("book_ref",),
    stage=(
        Cleaned("book_ref", "text", "text"),
        Cleaned("book_date", "timestamp"),
        Cleaned("total_amount", "decimal"),
    ),
    rules=(
        empty("book_ref"),
        missing("book_date"),
        missing("total_amount"),
        negative("total_amount"),
        BAD_OPERATION,
    ),
)

TICKETS = Entity(
    name="tickets",
    source_object="tickets",
    columns=(
        ("ticket_no", "text"),
        ("book_ref", "text"),
        ("passenger_id", "text"),
        ("passenger_name", "text"),
        ("outbound", "bool"),
    ),
    keys=("ticket_no",),
    stage=(
        Cleaned("ticket_no", "text", "text"),
        Cleaned("book_ref", "text", "text"),
        Cleaned("passenger_id", "text", "text"),
        Cleaned("passenger_name", "text", "text"),
        Cleaned("outbound", "bool"),
    ),
    rules=(
        empty("ticket_no"),
        empty("book_ref"),
        empty("passenger_id"),
        empty("passenger_name"),
        missing("outbound"),
        BAD_OPERATION,
    ),
)

SEGMENTS = Entity(
    name="segments",
    source_object="segments",
    columns=(("ticket_no", "text"), ("flight_id", "int"), ("fare_conditions", "text"), ("price", "decimal")),
    keys=("ticket_no", "flight_id"),
    stage=(
        Cleaned("ticket_no", "text", "text"),
        Cleaned("flight_id", "int"),
        Cleaned("fare_conditions", "text", "text"),
        Cleaned("price", "decimal"),
    ),
    rules=(
        empty("ticket_no"),
        missing("flight_id"),
        empty("fare_conditions"),
        outside("fare_conditions", fv.FARE_CONDITIONS),
        missing("price"),
        negative("price"),
        BAD_OPERATION,
    ),
)

BOARDING_PASSES = Entity(
    name="boarding_passes",
    source_object="boarding_passes",
    columns=(
        ("ticket_no", "text"),
        ("flight_id", "int"),
        ("seat_no", "text"),
        ("boarding_no", "int"),
        ("boarding_time", "timestamp"),
    ),
    keys=("ticket_no", "flight_id"),
    stage=(
        Cleaned("ticket_no", "text", "text"),
        Cleaned("flight_id", "int"),
        Cleaned("seat_no", "text", "text"),
        Cleaned("boarding_no", "int"),
        Cleaned("boarding_time", "timestamp"),
    ),
    rules=(
        empty("ticket_no"),
        missing("flight_id"),
        empty("seat_no"),
        BAD_OPERATION,
        Rule("boarding_no <= 0", "boarding_no must be greater than 0"),
    ),
)

# Load order: dimensions before the facts that look their keys up.
ENTITIES = {
    e.name: e
    for e in (AIRPLANES, AIRPORTS, ROUTES, SEATS, FLIGHTS, BOOKINGS, TICKETS, SEGMENTS, BOARDING_PASSES)
}
