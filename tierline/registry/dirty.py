"""Journal rows spoiled by rule, to exercise cleansing and validation over whole tables.

Each entry is (RAW column, SQL expression over the RAW row). The expressions are plain SQL, so the checking engine can
spoil its own copy of the rows the same way; cleansing and validation are then written twice.
"""

SPOILED: dict[str, list[tuple[str, str]]] = {
    "airplanes": [
        ("airplane_code", "case when speed = 500 then '   ' else concat('  ', lower(airplane_code), ' ') end"),
        ("model", "case when speed = 501 then '{\"en\":\" \",\"ru\":\" x \"}' when speed = 502 then '{\"en\":\"a\"}' else model end"),
        ("range", "case when speed in (500, 503) then 0 when speed = 504 then null else range end"),
        ("operation_type", "case when speed in (500, 506) then 'X' else operation_type end"),
        ("speed", "case when speed in (500, 505) then -1 else speed end"),
    ],
    "airports": [
        ("airport_name", "case when airport_code = 'N01' then '{\"ru\":\"x\"}' else airport_name end"),
        ("city", "case when airport_code in ('N01', 'N02') then '{\"en\":\"  \"}' else city end"),
        ("country", "case when airport_code = 'N03' then null else country end"),
        ("timezone", "case when airport_code in ('N01', 'N04') then '  ' else concat(' ', timezone) end"),
        ("operation_type", "case when airport_code = 'N05' then 'Q' else operation_type end"),
        ("airport_code", "case when airport_code = 'N06' then ' ' else concat(' ', lower(airport_code)) end"),
    ],
    "routes": [
        ("departure_airport", "case when airplane_code = '001' then arrival_airport when airplane_code = '002' then ' ' else lower(departure_airport) end"),
        ("days_of_week", "case when airplane_code = '003' then null else days_of_week end"),
        ("scheduled_time", "case when airplane_code = '004' then null else scheduled_time end"),
        ("operation_type", "case when airplane_code = '005' then 'i' else operation_type end"),
        ("route_no", "case when airplane_code = '006' then '  ' else concat(' ', route_no, ' ') end"),
        ("airplane_code", "case when airplane_code in ('007', '002') then '' else airplane_code end"),
    ],
    "seats": [
        ("seat_no", "case when fare_conditions = 'Business' then ' ' else concat(seat_no, ' ') end"),
        ("airplane_code", "case when seat_no = '5A' then null else airplane_code end"),
        ("operation_type", "case when seat_no = '4A' then 'Z' else operation_type end"),
        ("fare_conditions", "case when seat_no = '2A' then 'First' when seat_no = '3A' then '  ' else concat(' ', fare_conditions) end"),
    ],
    "flights": [
        ("route_no", "case when status = 'Boarding' then '  ' else concat(' ', route_no) end"),
        ("scheduled_arrival", "case when route_no = 'Brand#1' then scheduled_departure when route_no = 'Brand#2' then null else scheduled_arrival end"),
        ("actual_departure", "case when status in ('Delayed', 'Arrived') then null else actual_departure end"),
        ("actual_arrival", "case when status = 'Departed' then actual_departure else actual_arrival end"),
        ("operation_type", "case when route_no = 'Brand#3' then '' else operation_type end"),
        ("status", "case when status = 'Cancelled' then 'Lost' when route_no = 'Brand#4' then null else concat(status, ' ') end"),
    ],
    "bookings": [
        ("operation_type", "case when total_amount < 100000 then 'x' else operation_type end"),
        ("book_ref", "case when total_amount > 400000 then '   ' else concat(' ', book_ref, '  ') end"),
        ("book_date", "case when total_amount > 450000 then null else book_date end"),
        ("total_amount", "case when total_amount between 200000 and 300000 then -total_amount when total_amount > 300000 and total_amount < 350000 then null else total_amount end"),
    ],
    "tickets": [
        ("passenger_name", "case when outbound then '  ' else concat(passenger_name, ' ') end"),
        ("passenger_id", "case when length(passenger_id) = 2 then null else passenger_id end"),
        ("book_ref", "case when length(book_ref) = 3 then '' else concat(' ', book_ref) end"),
        ("operation_type", "case when length(ticket_no) = 4 then 'N' else operation_type end"),
        ("outbound", "case when length(passenger_id) = 3 then null else outbound end"),
    ],
    "segments": [
        ("ticket_no", "case when price > 100000 then ' ' else concat(ticket_no, ' ') end"),
        ("operation_type", "case when price < 5000 then 'E' else operation_type end"),
        ("fare_conditions", "case when price between 5000 and 9000 then 'Lounge' when price between 9000 and 12000 then null else concat(' ', fare_conditions) end"),
        ("price", "case when price between 20000 and 30000 then -price when price between 30000 and 40000 then null else price end"),
    ],
    "boarding_passes": [
        ("operation_type", "case when length(ticket_no) = 2 then 'B' else operation_type end"),
        ("boarding_no", "case when length(ticket_no) = 3 then -boarding_no when length(ticket_no) = 4 then null else boarding_no end"),
        ("seat_no", "case when length(seat_no) = 5 then '  ' else concat(' ', seat_no) end"),
        ("ticket_no", "case when length(ticket_no) = 2 then '' else ticket_no end"),
    ],
}
