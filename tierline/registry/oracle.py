"""The registered queries once more, as SQL for an independent engine (DuckDB) over the same tables.

Types follow registry.output.plain: decimals as double, timestamps as text, intervals as seconds, ranges and points flat.
"""

from __future__ import annotations

from tierline.catalog import fixed_values as fv
from tierline.registry.dirty import SPOILED

T1, T2 = "2024-01-01 00:00:00.000000", "2024-02-01 00:00:00.000000"
OPEN = "9999-12-31 00:00:00.000000"
STAMP1, STAMP2 = "2024-01-01T00:00:00.000000", "2024-02-01T00:00:00.000000"
B2 = 100
BASE = 1_577_836_800_000_000
MIN = 60_000_000
HOUR = 3_600_000_000


def _mark(column: str, new: str, gone: str, changed: str) -> str:
    return (
        f"case when {column} in ({new}) then 'new' when {column} in ({gone}) then 'gone'"
        f" when {column} in ({changed}) then 'changed' else 'same' end as mark"
    )


def _code(x: str, digits: int = 3) -> str:
    return f"lpad(({x})::varchar, greatest({digits}, length(({x})::varchar))::int, '0')"


def _at(micros: str) -> str:
    return f"make_timestamp(({micros})::bigint)"


_DEP = f"{BASE} + (p_partkey % 2000) * {HOUR} + p_partkey // 2000"
_ARR = f"{_DEP} + (p_size + 30)::bigint * {MIN}"
_STATUSES = "[" + ", ".join(f"'{s}'" for s in fv.FLIGHT_STATUSES) + "]"
_ORDER_MARK = _mark("o_orderpriority", "'1-URGENT'", "'5-LOW'", "'2-HIGH'")
_PARTS = (
    "select l_orderkey, l_partkey, min(l_returnflag) as flag, sum(l_extendedprice::decimal(10,2)) as price,"
    " min(l_linestatus) as st, min(l_linenumber) as line from lineitem group by 1, 2"
)
_FARE = "case flag when 'A' then 'Economy' when 'N' then 'Comfort' else 'Business' end"

# Rows of each entity in their later form, with mark. Ranges, points, arrays and intervals are flat already.
SRC = {
    "airplanes": f"""select {_code('s_suppkey')} as airplane_code,
        '{{"en":"' || s_name || '","ru":"' || lower(s_name) || '"}}' as model,
        (1000 + s_suppkey)::int as range, (500 + s_nationkey)::int as speed,
        {_mark('s_nationkey', '0,1,2,3,4', '5,6,7,8,9', '10,11,12,13,14')} from supplier""",
    "airports": f"""select 'N' || {_code('n_nationkey', 2)} as airport_code,
        '{{"en":"' || n_name || '","ru":"' || n_name || '"}}' as airport_name,
        '{{"en":"' || n_name || '","ru":"' || n_name || '"}}' as city,
        '{{"en":"' || r_name || '","ru":"' || r_name || '"}}' as country,
        (n_nationkey * 10)::double as coordinates_lon, (n_regionkey * 10)::double as coordinates_lat,
        'UTC' as timezone, {_mark('n_regionkey', '0', '1', '2')} from nation join region on n_regionkey = r_regionkey""",
    "routes": f"""select p_brand as route_no, {_at(f'{BASE} + w * 500 * {HOUR}')} as validity_lower,
        {_at(f'{BASE} + (w + 1) * 500 * {HOUR}')} as validity_upper,
        'N' || {_code('b % 25', 2)} as departure_airport,
        'N' || {_code('(b + 1 + w) % 25', 2)} as arrival_airport,
        {_code('(select min(s_suppkey) from supplier) + ((b * 4 + w) * 7919) % (select count(*) from supplier)')} as airplane_code, '{{1,3,5}}' as days_of_week, '11:00:00' as scheduled_time,
        ((b + 60) * 60)::bigint as duration_seconds, {_mark('w', '3', '0', '1')}
        from (select distinct p_brand, replace(p_brand, 'Brand#', '')::int as b from part) as brands,
        (values (0), (1), (2), (3)) as seasons(w)""",
    "seats": f"""select {_code('l_suppkey')} as airplane_code, l_linenumber::varchar || 'A' as seat_no,
        case l_linenumber when 1 then 'Business' when 2 then 'Comfort' else 'Economy' end as fare_conditions,
        {_mark('l_linenumber', '1', '2', '3')} from (select distinct l_suppkey, l_linenumber from lineitem)""",
    "flights": f"""select p_partkey::int as flight_id, p_brand as route_no,
        {_STATUSES}[(p_partkey % 7 + 1)::int] as status,
        {_at(_DEP)} as scheduled_departure, {_at(_ARR)} as scheduled_arrival,
        case when p_partkey % 3 <> 0 then {_at(f'{_DEP} + 5 * {MIN}')} end as actual_departure,
        case when p_partkey % 3 <> 0 and p_partkey % 5 <> 0 then {_at(f'{_ARR} + 7 * {MIN}')} end as actual_arrival,
        {_mark('p_type', "'PROMO'", "'SMALL'", "'LARGE'")} from part""",
    "bookings": f"""select o_orderkey::varchar as book_ref, o_orderdate as book_date,
        o_totalprice::decimal(10,2) as total_amount, {_ORDER_MARK} from orders""",
    "tickets": f"""select o_orderkey::varchar as ticket_no, o_orderkey::varchar as book_ref,
        o_custkey::varchar as passenger_id, c_name as passenger_name, o_orderstatus = 'F' as outbound, {_ORDER_MARK}
        from orders join customer on o_custkey = c_custkey""",
    "segments": f"""select l_orderkey::varchar as ticket_no, l_partkey::int as flight_id, {_FARE} as fare_conditions,
        price::decimal(10,2) as price, {_mark('line', '1', '2', '3')} from ({_PARTS})""",
    "boarding_passes": f"""select l_orderkey::varchar as ticket_no, l_partkey::int as flight_id,
        (l_orderkey + 1)::varchar || 'B' as seat_no, try_cast(l_orderkey + 1 as int) as boarding_no,
        {_at(_DEP.replace('p_partkey', 'l_partkey') + f' - 30 * {MIN}')} as boarding_time,
        {_mark('line', '1', '2', '3')} from ({_PARTS}) where st = 'F'""",
}
BATCH = {name: i + 1 for i, name in enumerate(SRC)}
OBJECT = {"airplanes": "airplanes_data", "airports": "airports_data"}
KEYS = {
    "airplanes": ["airplane_code"],
    "airports": ["airport_code"],
    "routes": ["route_no", "validity_lower", "validity_upper"],
    "seats": ["airplane_code", "seat_no"],
    "flights": ["flight_id"],
    "bookings": ["book_ref"],
    "tickets": ["ticket_no"],
    "segments": ["ticket_no", "flight_id"],
    "boarding_passes": ["ticket_no", "flight_id"],
}
RAW = {
    "airplanes": ["airplane_code", "model", "range", "speed"],
    "airports": ["airport_code", "airport_name", "city", "country", "coordinates_lon", "coordinates_lat", "timezone"],
    "routes": ["route_no", "validity_lower", "validity_upper", "departure_airport", "arrival_airport", "airplane_code",
               "days_of_week", "scheduled_time", "duration_seconds"],
    "seats": ["airplane_code", "seat_no", "fare_conditions"],
    "flights": ["flight_id", "route_no", "status", "scheduled_departure", "scheduled_arrival", "actual_departure",
                "actual_arrival"],
    "bookings": ["book_ref", "book_date", "total_amount"],
    "tickets": ["ticket_no", "book_ref", "passenger_id", "passenger_name", "outbound"],
    "segments": ["ticket_no", "flight_id", "fare_conditions", "price"],
    "boarding_passes": ["ticket_no", "flight_id", "seat_no", "boarding_no", "boarding_time"],
}
OLD = {
    "airplanes": ("speed", "speed + 5"),
    "airports": ("timezone", "'Etc/GMT'"),
    "routes": ("days_of_week", "'{2,4,6}'"),
    "seats": ("fare_conditions", "'Comfort'"),
    "flights": ("scheduled_arrival", "scheduled_arrival + interval 1 minute"),
    "bookings": ("total_amount", "(total_amount + 1)::decimal(10,2)"),
    "tickets": ("passenger_name", "upper(passenger_name)"),
    "segments": ("price", "(price + 1)::decimal(10,2)"),
    "boarding_passes": ("boarding_no", "boarding_no + 1"),
}
TIMES = {"validity_lower", "validity_upper", "scheduled_departure", "scheduled_arrival", "actual_departure",
         "actual_arrival", "book_date", "boarding_time"}
MONEY = {"total_amount", "price"}


def _z(c: str) -> str:
    return f"{c}::varchar || '+00'"


HASH = {
    "airports": ["airport_code", "airport_name", "city", "country", "timezone"],
    "routes": ["route_no", f"""'["' || {_z('validity_lower')} || '","' || {_z('validity_upper')} || '")'""",
               "departure_airport", "arrival_airport", "airplane_code", "days_of_week", "scheduled_time",
               "printf('%02d:%02d:%02d', duration_seconds // 3600, duration_seconds // 60 % 60, duration_seconds % 60)"],
}


def _hash(name: str) -> str:
    parts = HASH.get(name) or [_z(c) if c in TIMES else f"{c}::varchar" for c in RAW[name]]
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({p}, '')" for p in parts) + "))"


def _out(c: str, source: str | None = None) -> str:
    x = source or c
    if c in TIMES:
        return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f') as {c}"
    if c in MONEY:
        return f"{x}::double as {c}"
    return f"{x} as {c}" if source else c


def _state(name: str, state: str) -> str:
    if state == "all":
        return f"select * from ({SRC[name]})"
    if state == "after":
        return f"select * from ({SRC[name]}) where mark <> 'gone'"
    column, value = OLD[name]
    return (
        f"select * replace (case when mark = 'changed' then {value} else {column} end as {column})"
        f" from ({SRC[name]}) where mark <> 'new'"
    )


def _hashed(name: str, state: str) -> str:
    return f"select {', '.join(RAW[name])}, {_hash(name)} as raw_row_hash from ({_state(name, state)})"


def _technical(name: str, batch: int, at: str, op: str) -> str:
    source = fv.RECORD_SOURCE_PREFIX + OBJECT.get(name, name)
    return (
        f"'{at}' as load_date, '{source}' as record_source, '{fv.SOURCE_SYSTEM}' as source_system,"
        f" {batch}::bigint as batch_id, {op} as operation_type, raw_row_hash"
    )


def _journal(name: str, state: str, batch: int, at: str) -> str:
    cols = ", ".join(_out(c) for c in RAW[name])
    technical = _technical(name, batch, at, "'I'")
    return f"select {cols}, {technical} from ({_hashed(name, state)})"


def _same(name: str, a: str, b: str) -> str:
    return " and ".join(f"{a}.{k} = {b}.{k}" for k in KEYS[name])


def _delta(name: str) -> str:
    """The three probes: new keys, known keys with another hash, keys that are gone."""
    cols = ", ".join(RAW[name])
    b, a = f"({_hashed(name, 'before')})", f"({_hashed(name, 'after')})"
    n = ", ".join("n." + c for c in RAW[name])
    rows = f"""select {cols}, raw_row_hash, 'I' as op from {a} as n
            where not exists (select 1 from {b} as o where {_same(name, 'n', 'o')})
        union all select {n}, n.raw_row_hash, 'U' from {a} as n join {b} as o on {_same(name, 'n', 'o')}
            where n.raw_row_hash <> o.raw_row_hash
        union all select {cols}, raw_row_hash, 'D' from {b} as o
            where not exists (select 1 from {a} as n where {_same(name, 'n', 'o')})"""
    out = ", ".join(_out(c) for c in RAW[name])
    return f"select {out}, {_technical(name, B2, T2, 'op')} from ({rows})"


# --- STAGE ----------------------------------------------------------------------------------------------------------


def _json(column: str, lang: str) -> str:
    return f"nullif(trim(json_extract_string({column}, '$.{lang}')), '')"


def _text(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _keep(*names: str) -> list[tuple[str, str]]:
    return [(n, n) for n in names]


STAGE = {
    "airplanes": [("airplane_code", "upper(trim(airplane_code))"), ("model_en", _json("model", "en")),
                  ("model_ru", _json("model", "ru")), *_keep("range", "speed")],
    "airports": [("airport_code", "upper(trim(airport_code))"),
                 *[(f"{c}_{x}", _json(c, x)) for c in ("airport_name", "city", "country") for x in ("en", "ru")],
                 *_keep("coordinates_lon", "coordinates_lat"), ("timezone", _text("timezone"))],
    "routes": [("route_no", _text("route_no")), *_keep("validity_lower", "validity_upper"),
               *[(c, f"upper({_text(c)})") for c in ("departure_airport", "arrival_airport", "airplane_code")],
               *_keep("days_of_week", "scheduled_time", "duration_seconds")],
    "seats": [("airplane_code", f"upper({_text('airplane_code')})"), ("seat_no", _text("seat_no")),
              ("fare_conditions", _text("fare_conditions"))],
    "flights": [*_keep("flight_id"), ("route_no", _text("route_no")), ("status", _text("status")),
                *_keep("scheduled_departure", "scheduled_arrival", "actual_departure", "actual_arrival")],
    "bookings": [("book_ref", _text("book_ref")), *_keep("book_date", "total_amount")],
    "tickets": [*[(c, _text(c)) for c in ("ticket_no", "book_ref", "passenger_id", "passenger_name")], *_keep("outbound")],
    "segments": [("ticket_no", _text("ticket_no")), *_keep("flight_id"), ("fare_conditions", _text("fare_conditions")),
                 *_keep("price")],
    "boarding_passes": [("ticket_no", _text("ticket_no")), *_keep("flight_id"), ("seat_no", _text("seat_no")),
                        *_keep("boarding_no", "boarding_time")],
}
_FARES = "('Economy', 'Comfort', 'Business')"
_OP = ("operation_type <> 'I' and operation_type <> 'U' and operation_type <> 'D'", "operation_type is invalid")
RULES = {
    "airplanes": [
        ("coalesce(airplane_code, '') = ''", "airplane_code is empty"), _OP,
        ("model_en is null", "model_en is null"), ("model_ru is null", "model_ru is null"),
        ("coalesce(range, 0) <= 0", "range must be greater than 0"),
        ("coalesce(speed, 0) <= 0", "speed must be greater than 0"),
    ],
    "airports": [
        ("coalesce(airport_code, '') = ''", "airport_code is empty"), _OP,
        *[(f"{c}_{x} is null", f"{c}_{x} is null") for c in ("airport_name", "city", "country") for x in ("en", "ru")],
        ("coordinates_lon is null", "coordinates is null"), ("timezone is null", "timezone is empty"),
    ],
    "routes": [
        ("route_no is null", "route_no is empty"), ("validity_lower is null", "validity is null"),
        ("departure_airport is null", "departure_airport is empty"), ("arrival_airport is null", "arrival_airport is empty"),
        ("departure_airport = arrival_airport", "departure_airport equals arrival_airport"),
        ("airplane_code is null", "airplane_code is empty"), ("days_of_week is null", "days_of_week is null"),
        ("scheduled_time is null", "scheduled_time is null"), ("duration_seconds is null", "duration is null"),
        ("duration_seconds <= 0", "duration must be greater than 0"), _OP,
    ],
    "seats": [
        ("airplane_code is null", "airplane_code is empty"), ("seat_no is null", "seat_no is empty"),
        ("fare_conditions is null", "fare_conditions is empty"),
        (f"fare_conditions not in {_FARES}", "fare_conditions is invalid"), _OP,
    ],
    "flights": [
        ("flight_id is null", "flight_id is null"), ("route_no is null", "route_no is empty"),
        ("status is null", "status is empty"), (f"not list_contains({_STATUSES}, status)", "status is invalid"),
        ("scheduled_departure is null", "scheduled_departure is null"),
        ("scheduled_arrival is null", "scheduled_arrival is null"),
        ("scheduled_arrival <= scheduled_departure", "scheduled_arrival must be greater than scheduled_departure"),
        ("actual_arrival is not null and actual_departure is null",
         "actual_departure is null while actual_arrival is not null"),
        ("actual_arrival <= actual_departure", "actual_arrival must be greater than actual_departure"), _OP,
    ],
    "bookings": [
        ("book_ref is null", "book_ref is empty"), ("book_date is null", "book_date is null"),
        ("total_amount is null", "total_amount is null"),
        ("total_amount < 0", "total_amount must be greater than or equal to 0"), _OP,
    ],
    "tickets": [
        *[(f"{c} is null", f"{c} is empty") for c in ("ticket_no", "book_ref", "passenger_id", "passenger_name")],
        ("outbound is null", "outbound is null"), _OP,
    ],
    "segments": [
        ("ticket_no is null", "ticket_no is empty"), ("flight_id is null", "flight_id is null"),
        ("fare_conditions is null", "fare_conditions is empty"),
        (f"fare_conditions not in {_FARES}", "fare_conditions is invalid"),
        ("price is null", "price is null"), ("price < 0", "price must be greater than or equal to 0"), _OP,
    ],
    "boarding_passes": [
        ("ticket_no is null", "ticket_no is empty"), ("flight_id is null", "flight_id is null"),
        ("seat_no is null", "seat_no is empty"), _OP, ("boarding_no <= 0", "boarding_no must be greater than 0"),
    ],
}


def _staged(name: str) -> str:
    spoiled = SPOILED[name]
    spoil = ", ".join(f"{sql} as {c}" for c, sql in spoiled if c != "operation_type")
    op = next(sql for c, sql in spoiled if c == "operation_type")
    raw = f"select *, 'I' as operation_type from ({_state(name, 'all')})"
    dirty = f"select * replace ({spoil}, {op} as operation_type) from ({raw})"
    clean = ", ".join(f"{sql} as {c}" for c, sql in STAGE[name])
    staged = f"select {clean}, operation_type from ({dirty})"
    messages = ", ".join(f"case when {cond} then '{text}' end" for cond, text in RULES[name])
    return f"select *, nullif(concat_ws('; ', {messages}), '') as validation_error from ({staged})"


def _stage(name: str) -> str:
    cols = ", ".join(_out(c) for c, _ in STAGE[name])
    source = fv.RECORD_SOURCE_PREFIX + OBJECT.get(name, name)
    return (
        f"select {cols}, '{T1}' as raw_load_date, '{T1}' as stg_load_date, '{fv.SOURCE_SYSTEM}' as source_system,"
        f" '{source}' as record_source, {BATCH[name]}::bigint as batch_id, operation_type, validation_error,"
        f" validation_error is null as is_valid from ({_staged(name)})"
    )


# --- ODS ------------------------------------------------------------------------------------------------------------


def _clean_state(name: str, state: str) -> str:
    clean = ", ".join(f"{sql} as {c}" for c, sql in STAGE[name])
    return f"select {clean}, raw_row_hash from ({_hashed(name, state)})"


def _ods_rows(name: str) -> str:
    """ODS after both loads, stated by comparing the two snapshots; native types."""
    a, b = f"({_clean_state(name, 'after')})", f"({_clean_state(name, 'before')})"
    cols = [c for c, _ in STAGE[name]]
    first, source = BATCH[name], fv.RECORD_SOURCE_PREFIX + OBJECT.get(name, name)
    key = KEYS[name][0]
    n, o = ", ".join("n." + c for c in cols), ", ".join("o." + c for c in cols)
    return f"""select {n}, '{fv.SOURCE_SYSTEM}' as source_system, '{source}' as record_source,
            (case when o.{key} is null then {B2} else {first} end)::bigint as created_batch_id,
            (case when o.raw_row_hash = n.raw_row_hash then {first} else {B2} end)::bigint as updated_batch_id,
            case when o.raw_row_hash = n.raw_row_hash then '{T1}' else '{T2}' end as last_changed_at,
            false as is_deleted,
            case when o.{key} is null or o.raw_row_hash = n.raw_row_hash then 'I' else 'U' end as last_operation_type
        from {a} as n left join {b} as o on {_same(name, 'n', 'o')}
        union all
        select {o}, '{fv.SOURCE_SYSTEM}', '{source}', {first}, {B2}, '{T2}', true, 'D' from {b} as o
        where not exists (select 1 from {a} as n where {_same(name, 'n', 'o')})"""


def _ods(name: str) -> str:
    technical = ["source_system", "record_source", "created_batch_id", "updated_batch_id", "last_changed_at", "is_deleted",
                 "last_operation_type"]
    cols = [_out(c) for c, _ in STAGE[name]] + technical
    return f"select {', '.join(cols)} from ({_ods_rows(name)})"


# --- DDS ------------------------------------------------------------------------------------------------------------


def _sk(*parts: str) -> str:
    return f"md5({' || chr(124) || '.join(parts)})::uuid::varchar"


def _first_version(code: str) -> str:
    return _sk(code, f"'{STAMP1}'")


def _scd2(name: str, sk: str) -> str:
    key = KEYS[name][0]
    cols = [c for c, _ in STAGE[name]]
    source = fv.RECORD_SOURCE_PREFIX + OBJECT.get(name, name)
    a, b = f"({_clean_state(name, 'after')})", f"({_clean_state(name, 'before')})"
    differs = " or ".join(f"n.{c} is distinct from o.{c}" for c in cols if c != key)
    fixed = f"'{fv.SOURCE_SYSTEM}' as source_system, '{source}' as record_source"
    n, o = ", ".join("n." + c for c in cols), ", ".join("o." + c for c in cols)
    ends = f"n.{key} is null or {differs}"
    return f"""select {_sk('o.' + key, f"'{STAMP1}'")} as {sk}, {o}, {fixed}, '{T1}' as valid_from,
            case when {ends} then '{T2}' else '{OPEN}' end as valid_to, not ({ends}) as is_current,
            (case when {ends} then {B2} else {BATCH[name]} end)::bigint as batch_id
        from {b} as o left join {a} as n on n.{key} = o.{key}
        union all
        select {_sk('n.' + key, f"'{STAMP2}'")}, {n}, {fixed}, '{T2}', '{OPEN}', true, {B2}
        from {a} as n left join {b} as o on n.{key} = o.{key} where o.{key} is null or {differs}"""


def _loaded(name: str) -> str:
    return f"'{fv.SOURCE_SYSTEM}' as source_system, '{fv.RECORD_SOURCE_PREFIX + OBJECT.get(name, name)}' as record_source, {BATCH[name]}::bigint as batch_id, '{T1}' as last_changed_at"


def _src(name: str) -> str:
    return f"({SRC[name]})"


_SYSTEM = f"'{fv.SOURCE_SYSTEM}'"
_ROUTE_SK = _sk("route_no", _z("validity_lower"), _z("validity_upper"))
_IN_SEASON = "f.scheduled_departure >= r.validity_lower and f.scheduled_departure < r.validity_upper"

DDS = {
    "dim_routes": f"""select {_ROUTE_SK} as route_sk, route_no, {_out('validity_lower')}, {_out('validity_upper')},
        {_first_version('departure_airport')} as departure_airport_sk,
        {_first_version('arrival_airport')} as arrival_airport_sk, {_first_version('airplane_code')} as airplane_sk,
        days_of_week, scheduled_time, duration_seconds, {_loaded('routes')}, false as is_deleted
        from {_src('routes')} as r
        where departure_airport in (select airport_code from {_src('airports')})
          and arrival_airport in (select airport_code from {_src('airports')})
          and airplane_code in (select airplane_code from {_src('airplanes')})""",
    "dim_seats": f"""select {_sk('airplane_code', 'seat_no')} as seat_sk, airplane_code, seat_no,
        {_first_version('airplane_code')} as airplane_sk, fare_conditions, {_loaded('seats')}, false as is_deleted
        from {_src('seats')} where airplane_code in (select airplane_code from {_src('airplanes')})""",
    "dim_passenger": f"""select {_sk('passenger_id')} as passenger_sk, passenger_id, passenger_name, {_loaded('tickets')}
        from (select passenger_id, arg_max(passenger_name, ticket_no) as passenger_name from {_src('tickets')} group by 1)""",
    "fact_flights": f"""select {_sk('flight_id::varchar', _SYSTEM)} as flight_sk,
        {_ROUTE_SK.replace('route_no', 'r.route_no')} as route_sk, flight_id, status, {_out('scheduled_departure')},
        {_out('scheduled_arrival')}, {_out('actual_departure')}, {_out('actual_arrival')}, {_loaded('flights')},
        false as is_deleted
        from {_src('flights')} as f join {_src('routes')} as r on f.route_no = r.route_no and {_IN_SEASON}""",
    "fact_bookings": f"""select {_sk('book_ref', _SYSTEM)} as bookings_sk, book_ref, {_out('book_date')},
        {_out('total_amount')}, {_loaded('bookings')}, false as is_deleted from {_src('bookings')}""",
    "fact_tickets": f"""select {_sk('ticket_no', _SYSTEM)} as ticket_sk, {_sk('t.book_ref', _SYSTEM)} as bookings_sk,
        {_sk('passenger_id')} as passenger_sk, ticket_no, outbound, {_loaded('tickets')}, false as is_deleted
        from {_src('tickets')} as t join {_src('bookings')} as b on t.book_ref = b.book_ref""",
    "fact_segments": f"""select {_sk('s.ticket_no', 's.flight_id::varchar', _SYSTEM)} as segment_sk,
        {_sk('s.ticket_no', _SYSTEM)} as ticket_sk, {_sk('s.flight_id::varchar', _SYSTEM)} as flight_sk, fare_conditions,
        {_out('price')}, {_loaded('segments')}, false as is_deleted
        from {_src('segments')} as s join {_src('tickets')} as t on s.ticket_no = t.ticket_no
        join {_src('flights')} as f on s.flight_id = f.flight_id
        join {_src('routes')} as r on f.route_no = r.route_no and {_IN_SEASON}""",
    "fact_boarding_passes": f"""select {_sk('s.ticket_no', 's.flight_id::varchar', _SYSTEM)} as boarding_pass_sk,
        {_sk('s.ticket_no', _SYSTEM)} as ticket_sk, {_sk('s.flight_id::varchar', _SYSTEM)} as flight_sk, seat_no, boarding_no,
        {_out('boarding_time')}, {_loaded('boarding_passes')}, false as is_deleted
        from {_src('boarding_passes')} as s join {_src('tickets')} as t on s.ticket_no = t.ticket_no
        join {_src('flights')} as f on s.flight_id = f.flight_id
        join {_src('routes')} as r on f.route_no = r.route_no and {_IN_SEASON}""",
}

_SEATS_TWICE = f"""with ods as ({_ods_rows('seats')}),
    later as (select o.* from ods as o join ({_state('airplanes', 'after')}) as a on a.airplane_code = o.airplane_code
        where o.updated_batch_id = {B2}),
    versions as ({_scd2('airplanes', 'airplane_sk')}),
    earlier as (select s.* from ({_state('seats', 'before')}) as s
        where exists (select 1 from ({_state('airplanes', 'before')}) as a where a.airplane_code = s.airplane_code)
          and not exists (select 1 from later as l where l.airplane_code = s.airplane_code and l.seat_no = s.seat_no))
    select {_sk('l.airplane_code', 'l.seat_no')} as seat_sk, l.airplane_code, l.seat_no, v.airplane_sk, l.fare_conditions,
        l.source_system, l.record_source, {B2}::bigint as batch_id, '{T2}' as last_changed_at, l.is_deleted
    from later as l join versions as v on v.airplane_code = l.airplane_code and v.is_current
    union all
    select {_sk('airplane_code', 'seat_no')}, airplane_code, seat_no, {_first_version('airplane_code')}, fare_conditions,
        {_SYSTEM}, '{fv.RECORD_SOURCE_PREFIX}seats', {BATCH['seats']}, '{T1}', false from earlier"""

_BOOKINGS_TWICE = f"""select {_sk('book_ref', _SYSTEM)} as bookings_sk, book_ref, {_out('book_date')}, {_out('total_amount')},
    source_system, record_source, updated_batch_id as batch_id, last_changed_at, is_deleted from ({_ods_rows('bookings')})"""


# --- DM -------------------------------------------------------------------------------------------------------------


def _sales(src=_src) -> str:
    """The sales mart with native types."""
    return f"""select s.ticket_no, s.flight_id, t.passenger_id, r.route_no, b.book_ref, b.total_amount, s.price,
    s.fare_conditions, t.outbound, b.book_date, f.status, f.scheduled_departure, f.scheduled_arrival, f.actual_departure,
    f.actual_arrival, r.duration_seconds, json_extract_string(dep.airport_name, '$.ru') as departure_airport_name,
    json_extract_string(arr.airport_name, '$.ru') as arrival_airport_name,
    json_extract_string(a.model, '$.ru') as airplane_model
    from {src('segments')} as s join {src('tickets')} as t on s.ticket_no = t.ticket_no
    join {src('bookings')} as b on t.book_ref = b.book_ref join {src('flights')} as f on s.flight_id = f.flight_id
    join {src('routes')} as r on f.route_no = r.route_no and {_IN_SEASON}
    join {src('airports')} as dep on dep.airport_code = r.departure_airport
    join {src('airports')} as arr on arr.airport_code = r.arrival_airport
    join {src('airplanes')} as a on a.airplane_code = r.airplane_code"""


_SALES = _sales()
_SALES_COLUMNS = [
    "ticket_no", "flight_id", "passenger_id", "route_no", "book_ref", "total_amount", "price", "fare_conditions", "outbound",
    "book_date", "status", "scheduled_departure", "scheduled_arrival", "actual_departure", "actual_arrival",
    "duration_seconds", "departure_airport_name", "arrival_airport_name", "airplane_model",
]
_SALES_OUT = ", ".join(_out(c) for c in _SALES_COLUMNS)
_LAST = BATCH["segments"]


def _by_class(fare: str) -> str:
    f = fare.lower()
    return (
        f"count(distinct passenger_id) filter (where fare_conditions = '{fare}') as {f}_passenger_count,"
        f" coalesce(sum(price) filter (where fare_conditions = '{fare}'), 0)::double as {f}_revenue"
    )


def _traffic_side(kind: str, actual: str, scheduled: str) -> str:
    zero = {"departure": ("count(distinct flight_id)", "0", "count(distinct passenger_id)", "0", "sum(price)", "0"),
            "arrival": ("0", "count(distinct flight_id)", "0", "count(distinct passenger_id)", "0", "sum(price)")}[kind]
    return f"""select coalesce({actual}, {scheduled})::date as d, {kind}_airport_name as n, {zero[0]} as dc, {zero[1]} as ac,
        {zero[2]} as dp, {zero[3]} as ap, {zero[4]} as dr, {zero[5]} as ar from sales
        where {kind}_airport_name is not null and coalesce({actual}, {scheduled}) is not null group by 1, 2"""


# Exact half-up rounding of the mean, in whole cents.
_MEAN = "((2 * (sum(price) * 100)::hugeint + count(price)) // (2 * count(price)))::double / 100"


def _revenue(sales: str) -> str:
    return f"""select flight_id, count(distinct passenger_id) as passenger_count, sum(price)::double as total_revenue,
    {', '.join(_by_class(f) for f in fv.FARE_CONDITIONS)}, {_MEAN} as avg_price,
    max(price)::double as max_price, min(price)::double as min_price, max(status) as status,
    max(duration_seconds) as duration_seconds, max(departure_airport_name) as departure_airport_name,
    max(arrival_airport_name) as arrival_airport_name, max(airplane_model) as airplane_model
    from ({sales}) group by flight_id"""


def _traffic(sales: str) -> str:
    return f"""with sales as ({sales}), sides as (
    {_traffic_side('departure', 'actual_departure', 'scheduled_departure')} union all
    {_traffic_side('arrival', 'actual_arrival', 'scheduled_arrival')})
    select strftime(d, '%Y-%m-%d') as traffic_date, n as airport_name, sum(dc)::bigint as departures_count,
    sum(ac)::bigint as arrivals_count, sum(dp)::bigint as departure_passenger_count,
    sum(ap)::bigint as arrival_passenger_count, (sum(dp) + sum(ap))::bigint as total_passenger_count,
    sum(dr)::double as departure_revenue, sum(ar)::double as arrival_revenue, (sum(dr) + sum(ar))::double as total_revenue
    from sides group by 1, 2"""


_REVENUE, _TRAFFIC = _revenue(_SALES), _traffic(_SALES)


# --- DQ -------------------------------------------------------------------------------------------------------------

_OBJECT_KEYS = {"dim_airplanes": ("airplanes", "airplane_code"), "dim_seats": ("seats", "(airplane_code, seat_no)"),
                "fact_bookings": ("bookings", "book_ref")}


def _journal_live(name: str) -> str:
    keys = ", ".join(KEYS[name])
    events = f"""select {keys}, operation_type, batch_id from ({_journal(name, 'before', BATCH[name], T1)})
        union all select {keys}, operation_type, batch_id from ({_delta(name)})"""
    last = f"select {keys}, operation_type, row_number() over (partition by {keys} order by batch_id desc) as n from ({events})"
    return f"select {keys} from ({last}) where n = 1 and operation_type <> 'D'"


_DDS_LIVE = {
    "dim_airplanes": f"select * from ({_scd2('airplanes', 'airplane_sk')}) where is_current",
    "dim_seats": f"select * from ({_SEATS_TWICE}) where not is_deleted",
    "fact_bookings": f"select * from ({_BOOKINGS_TWICE}) where not is_deleted",
}


def _check(check: tuple) -> str:
    check_id, check_type, layer_from, layer_to, obj, text = check
    entity, key = _OBJECT_KEYS[obj]
    count = f"count(distinct {key})"
    rows = {
        "source": f"select * from ({_state(entity, 'after')})",
        "raw": _journal_live(entity),
        "ods": f"select * from ({_ods_rows(entity)}) where not is_deleted",
        "dds": _DDS_LIVE[obj],
    }
    bad = "WARN" if check_id == "SCD2-03" else "FAIL"
    if check_type == "row_count":
        src, dwh = (f"(select {count} from ({rows[x]}))" for x in (layer_from, layer_to))
    elif check_type == "aggregate":
        src, dwh = (f"(select coalesce(sum(total_amount::decimal(12,2)), 0) from ({rows[x]}))" for x in ("ods", "dds"))
    elif check_type == "duplicate" or check_id == "SCD2-01":
        keys = ", ".join(KEYS[entity])
        src, dwh = "0", f"(select count(*) from (select {keys} from ({rows['dds']}) group by all having count(*) > 1))"
    else:
        sign = ">" if check_id == "SCD2-02" else "<"
        periods = f"""select valid_from, lag(valid_to) over (partition by airplane_code order by valid_from, valid_to) as p
            from ({_scd2('airplanes', 'airplane_sk')})"""
        src, dwh = "0", f"(select count(*) from ({periods}) where p {sign} valid_from)"
    return f"""select '{check_id}' as check_id, '{check_type}' as check_type, '{layer_from}' as layer_from,
        '{layer_to}' as layer_to, '{obj}' as object_name, '{text}' as description, src_value, dwh_value,
        src_value - dwh_value as diff, case when src_value = dwh_value then 'PASS' else '{bad}' end as status,
        1::bigint as run_id, '{T2}' as checked_at
        from (select {src}::double as src_value, {dwh}::double as dwh_value)"""


_ALL_CHECKS = " union all ".join(_check(c) for c in fv.CHECKS)
_LAST_RUN = f"""select * replace (2::bigint as run_id, case when check_type = 'scd2' then 'WARN' else status end as status)
    from ({_ALL_CHECKS})"""
_SEAM = "layer_from || ' → ' || layer_to"


# --- Constraints and registries -------------------------------------------------------------------------------------

_MIXED = {n: "after" if n in ("airplanes", "airports", "flights", "tickets") else "all" for n in SRC}
_ENTITY_OF = {OBJECT.get(n, n): n for n in SRC}


def _mixed(obj: str) -> str:
    name = _ENTITY_OF[obj]
    return f"({_state(name, _MIXED[name])})"


def _columns(text: str) -> list[str]:
    return [c.strip() for c in text.split(",")]


def _constraint(c: tuple, _mixed=_mixed) -> str:
    table, name, kind, columns, parent, parent_columns, rule, _ = c
    cols = _columns(columns)
    if kind in ("PRIMARY KEY", "UNIQUE"):
        key = ", ".join(cols).replace("validity", "validity_lower, validity_upper")
        only = f" where {rule}" if rule else ""
        n = f"select count(*) from (select 1 from {_mixed(table)}{only} group by {key} having count(*) > 1)"
    elif kind == "FOREIGN KEY":
        pairs = " and ".join(f"c.{a} = p.{b}" for a, b in zip(cols, _columns(parent_columns)))
        n = f"select count(*) from {_mixed(table)} as c where not exists (select 1 from {_mixed(parent)} as p where {pairs})"
    elif kind == "EXCLUDE":
        numbered = f"""select route_no, validity_lower, validity_upper, row_number() over (partition by route_no
            order by validity_lower, validity_upper) as n from {_mixed(table)}"""
        n = f"""select count(*) from ({numbered}) as v where exists (select 1 from ({numbered}) as p
            where p.route_no = v.route_no and p.n < v.n and p.validity_upper > v.validity_lower)"""
    else:
        if " in (" in rule and "'" not in rule:
            column, values = rule.rstrip(")").split(" in (")
            rule = f"{column} in ({', '.join(repr(v) for v in _columns(values))})"
        n = f"select count(*) from {_mixed(table)} where not ({rule})"
    return f"select '{table}' as table_name, '{name}' as constraint_name, '{kind}' as constraint_type, ({n}) as violations"


def _warehouse_table(name: str) -> str:
    layer, table = name.split(".")
    if table in ("dim_airplanes", "dim_airports"):
        entity = table[4:]
        code = KEYS[entity][0]
        return f"""(select {_first_version(code)} as {code[:-5]}_sk, {code}, '{T1}' as valid_from, '{OPEN}' as valid_to,
            true as is_current from {_src(entity)})"""
    if layer == "ods":
        return _src(table)
    marts = {"flight_sales_mart": _SALES, "flight_revenue_mart": _REVENUE, "airport_traffic_daily": _TRAFFIC}
    return f"({_ALL_CHECKS if layer == 'dq' else marts.get(table) or DDS[table]})"


def _index(i: tuple) -> str:
    table, name, _, columns, _, _ = i
    n = f"select count(*) from (select 1 from {_mixed(table)} group by {columns} having count(*) > 1)"
    return f"select '{table}' as table_name, '{name}' as index_name, ({n}) as violations"


def _dictionary(row: tuple) -> str:
    obj, column, kind, nullable, _ = row
    real = {"coordinates": "coordinates_lon", "validity": "validity_lower", "duration": "duration_seconds"}.get(column, column)
    holds = "true" if nullable is None else f"count(*) = count({real})"
    return f"""select '{obj}' as object_name, '{column}' as column_name, '{kind}' as data_type, count(*) as rows,
        count(*) - count({real}) as null_rows, {holds} as holds from {_mixed(obj)}"""


_VISITS = "select user_id, ts, row_number() over (partition by user_id order by ts) as n from events"
_RULES = [
    ("segments_price_check", "price < 0"),
    ("segments_fare_conditions_check", f"fare_conditions not in {_FARES}"),
    ("segments_price_limit", "price >= 50000"),
    ("segments_economy_limit", "fare_conditions = 'Economy' and price >= 10000"),
]


def _full_load_rows() -> str:
    parts = [f"select '{layer}.{n}' as table_name, (select count(*) from {_src(n)}) as rows" for layer in ("raw", "ods") for n in SRC]
    parts += [f"select 'dds.dim_{n}', (select count(*) from {_src(n)})" for n in ("airplanes", "airports")]
    parts += [f"select 'dds.{t}', (select count(*) from ({sql}))" for t, sql in DDS.items()]
    parts.append(f"select 'dm.flight_sales_mart', (select count(*) from ({_SALES}))")
    parts.append(f"select 'dm.flight_revenue_mart', (select count(*) from ({_REVENUE}))")
    parts.append(f"select 'dm.airport_traffic_daily', (select count(*) from ({_TRAFFIC}))")
    return " union all ".join(parts)


# --- Two loads of the stored warehouse: the earlier snapshot, then the later one ------------------------------------

# A route is loaded once its airports and its airplane are current: at the first load, or at the second, which also tries
# the rows that have waited.
_ROUTES_TWICE = f"""select * from ({SRC['routes']}) where {' or '.join(
    f"({and_new} departure_airport in (select airport_code from ({_state('airports', when)}))"
    f" and arrival_airport in (select airport_code from ({_state('airports', when)}))"
    f" and airplane_code in (select airplane_code from ({_state('airplanes', when)})))"
    for when, and_new in (('before', "mark <> 'new' and"), ('after', ''))
)}"""
_SEAT_ROWS_TWICE = f"""select * from ({SRC['seats']}) where (mark <> 'new'
    and airplane_code in (select airplane_code from ({_state('airplanes', 'before')})))
    or airplane_code in (select airplane_code from ({_state('airplanes', 'after')}))"""


def _of_batch(name: str) -> str:
    """Batches of the stored warehouse are numbered in load order."""
    second = len(BATCH) + BATCH[name]
    return f"source_system, record_source, (case when updated_batch_id = {B2} then {second} else {BATCH[name]} end)::bigint as batch_id"


_LOADED_FLIGHTS = f"""select f.*, {_ROUTE_SK.replace('route_no', 'r.route_no')} as route_sk from ({_ods_rows('flights')}) as f
    join ({_ROUTES_TWICE}) as r on f.route_no = r.route_no and {_IN_SEASON}"""
_KEYS_OF_SEGMENT = f"{_sk('ticket_no', _SYSTEM)} as ticket_sk, {_sk('flight_id::varchar', _SYSTEM)} as flight_sk"
_HAS_FLIGHT = f"flight_id in (select flight_id from ({_LOADED_FLIGHTS}))"
SECOND = {
    "dim_passenger": f"""select {_sk('passenger_id')} as passenger_sk, passenger_id, passenger_name, {_of_batch('tickets')} from (
        select * from ({_ods_rows('tickets')}) where passenger_id is not null
        qualify row_number() over (partition by passenger_id order by updated_batch_id desc, ticket_no desc) = 1)""",
    "fact_flights": f"""select {_sk('flight_id::varchar', _SYSTEM)} as flight_sk, route_sk, flight_id, status, {_out('scheduled_departure')},
        {_out('scheduled_arrival')}, {_out('actual_departure')}, {_out('actual_arrival')}, {_of_batch('flights')}, is_deleted from ({_LOADED_FLIGHTS})""",
    "fact_bookings": f"""select {_sk('book_ref', _SYSTEM)} as bookings_sk, book_ref, {_out('book_date')}, {_out('total_amount')},
        {_of_batch('bookings')}, is_deleted from ({_ods_rows('bookings')})""",
    "fact_tickets": f"""select {_sk('ticket_no', _SYSTEM)} as ticket_sk, {_sk('book_ref', _SYSTEM)} as bookings_sk,
        {_sk('passenger_id')} as passenger_sk, ticket_no, outbound, {_of_batch('tickets')}, is_deleted from ({_ods_rows('tickets')})""",
    "fact_segments": f"""select {_sk('ticket_no', 'flight_id::varchar', _SYSTEM)} as segment_sk, {_KEYS_OF_SEGMENT}, fare_conditions,
        {_out('price')}, {_of_batch('segments')}, is_deleted from ({_ods_rows('segments')}) where {_HAS_FLIGHT}""",
    "fact_boarding_passes": f"""select {_sk('ticket_no', 'flight_id::varchar', _SYSTEM)} as boarding_pass_sk, {_KEYS_OF_SEGMENT}, seat_no,
        boarding_no, {_out('boarding_time')}, {_of_batch('boarding_passes')}, is_deleted from ({_ods_rows('boarding_passes')}) where {_HAS_FLIGHT}""",
}


def _later_source(name: str) -> str:
    """What the second mart load joins: later states, all routes that were loaded, and any version of airports and airplanes (names do not change)."""
    return f"({_ROUTES_TWICE})" if name == "routes" else _src(name) if name in ("airports", "airplanes") else f"({_state(name, 'after')})"


# Rows of facts deleted since the first load stay in the mart as they were.
_SALES_TWICE = f"""with first_load as ({_sales(lambda n: f"({_state(n, 'before')})")}), second_load as ({_sales(_later_source)})
    select * from second_load union all
    select * from first_load as o where not exists (select 1 from second_load as n where n.ticket_no = o.ticket_no and n.flight_id = o.flight_id)"""


def _two_loads_rows() -> str:
    frames = {f"raw.{n}": f"select 1 from ({_state(n, 'before')}) union all select 1 from ({_delta(n)})" for n in SRC}
    frames |= {f"ods.{n}": _ods_rows(n) for n in SRC}
    frames |= {"dds.dim_airplanes": _scd2("airplanes", "sk"), "dds.dim_airports": _scd2("airports", "sk")}
    frames |= {"dds.dim_routes": _ROUTES_TWICE, "dds.dim_seats": _SEAT_ROWS_TWICE} | {f"dds.{t}": q for t, q in SECOND.items()}
    frames |= {"dm.flight_sales_mart": _SALES_TWICE, "dm.flight_revenue_mart": _revenue(_SALES_TWICE), "dm.airport_traffic_daily": _traffic(_SALES_TWICE)}
    return " union all ".join(f"select '{t}' as table_name, (select count(*) from ({q})) as rows" for t, q in frames.items())


def _batch_log() -> str:
    rows = [
        f"select {b}::bigint as batch_id, 'raw.load_{OBJECT.get(n, n)}_delta' as process_name, 'SUCCESS' as status,"
        f" (select count(*) from {_src(n)}) as rows"
        for n, b in BATCH.items()
    ]
    return " union all ".join(rows)


def oracle() -> dict[str, str]:
    sql: dict[str, str] = {}
    for n in SRC:
        sql[f"cdc_initial_{n}"] = _journal(n, "all", BATCH[n], T1)
        sql[f"cdc_delta_{n}"] = _delta(n)
        sql[f"stg_{n}"] = _stage(n)
        sql[f"ods_{n}"] = _ods(n)
    b = ", ".join(_out(c) for c in RAW["bookings"]) + ", raw_row_hash"
    for op, letter in (("inserts", "I"), ("updates", "U"), ("deletes", "D")):
        columns = "book_ref, book_date, total_amount, raw_row_hash"
        sql[f"cdc_{op}_bookings"] = f"select {columns} from ({_delta('bookings')}) where operation_type = '{letter}'"
    sql["cdc_snapshot_bookings"] = f"select {b}, '{T2}' as last_seen_at from ({_hashed('bookings', 'after')})"
    sql["stg_counts"] = " union all ".join(
        f"select '{n}' as entity, {BATCH[n]}::bigint as batch_id, count(*) as rows, count(validation_error) as invalid_rows"
        f" from ({_staged(n)})"
        for n in SRC
    )
    sql["ods_counts"] = " union all ".join(
        f"select '{n}' as entity, count(*) as rows, count(*) filter (where not is_deleted) as active_rows,"
        f" count(*) filter (where is_deleted) as deleted_rows from ({_ods_rows(n)})"
        for n in SRC
    )
    sql["scd2_airplanes"] = _scd2("airplanes", "airplane_sk")
    sql["scd2_airports"] = _scd2("airports", "airport_sk")
    sql["scd2_counts"] = f"""select count(*) as rows, count(*) filter (where is_current) as current_rows,
        count(*) filter (where not is_current) as historical_rows from ({sql['scd2_airplanes']})"""
    sql |= DDS
    sql["dim_seats_second_load"] = _SEATS_TWICE
    sql["fact_bookings_second_load"] = _BOOKINGS_TWICE
    sql["temporal_join"] = f"""select flight_id, f.route_no, {_out('scheduled_departure')},
        r.validity_lower::varchar as season_start
        from {_src('flights')} as f join {_src('routes')} as r on f.route_no = r.route_no and {_IN_SEASON}"""

    sql["dm_flight_sales"] = f"select {_SALES_OUT}, {_LAST}::bigint as source_max_batch_id, '{T1}' as mart_load_date from ({_SALES})"
    late = "status = 'Delayed'"
    sql["dm_flight_sales_increment"] = f"""select {_SALES_OUT},
        (case when {late} then 100 else {_LAST} end)::bigint as source_max_batch_id,
        case when {late} then '{T2}' else '{T1}' end as mart_load_date from ({_SALES})"""
    sql["dm_flight_revenue"] = _REVENUE
    sql["dm_airport_traffic"] = sql["warehouse_traffic_mart"] = _TRAFFIC
    sql["bi_revenue_by_day"] = f"select strftime(book_date, '%Y-%m-%d') as book_day, sum(price)::double as revenue from ({_SALES}) group by 1"
    sql["bi_kpis"] = f"""select sum(price)::double as total_revenue, {_MEAN} as avg_ticket_price,
        count(distinct ticket_no) as ticket_count from ({_SALES})"""
    sql["bi_fare_class"] = f"""select fare_conditions, sum(price)::double as revenue, count(distinct ticket_no) as ticket_count
        from ({_SALES}) group by 1"""
    sql["bi_model_revenue"] = f"select airplane_model, sum(price)::double as revenue from ({_SALES}) group by 1"
    sql["bi_top_departure_airports"] = f"""select departure_airport_name, sum(price)::double as revenue, count(*) as segment_count
        from ({_SALES}) group by 1 order by revenue desc, 1 limit 10"""
    sql["bi_top_routes"] = f"select route_no, sum(price)::double as revenue from ({_SALES}) group by 1 order by revenue desc, 1 limit 10"

    for c in fv.CHECKS:
        sql[f"dq_{c[0].lower().replace('-', '_')}"] = _check(c)
    sql["dq_run"] = _ALL_CHECKS
    by_status = ", ".join(f"count(*) filter (where status = '{s}') as {s.lower()}" for s in fv.CHECK_STATUSES)
    sql["dq_run_totals"] = f"select run_id, count(*) as checks, {by_status} from ({_ALL_CHECKS}) group by 1"
    sql["rep_last_run"] = _LAST_RUN
    sql["rep_status"] = f"""select *, round(pass * 100.0 / total)::int as pass_percent
        from (select count(*) as total, {by_status} from ({_LAST_RUN}))"""
    sql["rep_object"] = f"select object_name, count(*) as checks from ({_LAST_RUN}) group by 1"
    sql["rep_type"] = f"select check_type, count(*) as checks from ({_LAST_RUN}) group by 1"
    order = "[" + ", ".join(f"'{s}'" for s in fv.SEAM_ORDER) + "]"
    sql["rep_seam"] = f"""select {_SEAM} as seam, count(*) as checks, list_position({order}, {_SEAM})::bigint as position
        from ({_LAST_RUN}) group by 1"""
    sql["rep_detail"] = f"""select check_id, object_name, {_SEAM} as seam, check_type,
        format('{{:,}}', round(src_value)::bigint) as src_value, format('{{:,}}', round(dwh_value)::bigint) as dwh_value,
        format('{{:,.2f}}', diff) as diff, status from ({_LAST_RUN})"""

    sql["con_unique"] = "select l_orderkey, l_linenumber, count(*) as rows from lineitem group by 1, 2 having count(*) > 1"
    first_dim = f"select airplane_code from ({_state('airplanes', 'before')})"
    sql["con_partial_unique"] = f"""select airplane_code, count(*) as rows from ({first_dim} union all
        select airplane_code from ({sql['scd2_airplanes']}) where is_current) group by 1 having count(*) > 1"""
    sql["con_fk"] = f"""select ticket_no as fk_0, flight_id as fk_1, count(*) as rows from ({_state('boarding_passes', 'before')}) as c
        where not exists (select 1 from ({_state('segments', 'after')}) as p
            where p.ticket_no = c.ticket_no and p.flight_id = c.flight_id) group by 1, 2"""
    sql["con_check"] = " union all ".join(
        f"select '{name}' as rule, count(*) as violations from {_src('segments')} where {broken}" for name, broken in _RULES
    )
    sql["con_no_overlap"] = f"""with visits as ({_VISITS}) select count(*) as violations from visits as v where exists
        (select 1 from visits as p where p.user_id = v.user_id and p.n < v.n and p.ts + interval 6 hour > v.ts)"""
    sql["meta_dictionary"] = " union all ".join(_dictionary(r) for r in fv.DICTIONARY if r[1] is not None)
    sql["meta_constraints"] = " union all ".join(_constraint(c) for c in fv.CONSTRAINTS)
    sql["con_warehouse"] = " union all ".join(_constraint(c, _warehouse_table) for c in fv.WAREHOUSE_CONSTRAINTS)
    sql["meta_indexes"] = " union all ".join(_index(i) for i in fv.INDEXES if i[4] and i[2] == "btree")
    sql["warehouse_late_parents"] = f"""select segment_sk, ticket_sk, flight_sk, fare_conditions, price, is_deleted
        from ({DDS['fact_segments']})"""
    sql["warehouse_full_load"] = _full_load_rows()
    sql["warehouse_batch_log"] = _batch_log()
    sql["warehouse_two_loads"] = _two_loads_rows()
    sql |= {f"warehouse_second_{t}": q for t, q in SECOND.items()}
    sql["warehouse_second_flight_sales"] = f"select {_SALES_OUT} from ({_SALES_TWICE})"
    sql["warehouse_second_flight_revenue"] = _revenue(_SALES_TWICE)
    sql["warehouse_second_airport_traffic"] = _traffic(_SALES_TWICE)
    return sql
