"""Fixed values of the data model.

Everything below is data that must be equal to the published data model for results to be right: code lists, the
source dictionary, the constraint and index registries, and the texts of the fifteen reconciliation checks.
"""

# --- Fixed values: constants written into every RAW row ------------------------------------------------------------

SOURCE_SYSTEM = "postgres_demo"
SOURCE_SCHEMA = "bookings"
RECORD_SOURCE_PREFIX = "demo.bookings."

# --- Fixed values: code lists --------------------------------------------------------------------------------------

OPERATIONS = ("I", "U", "D")
FARE_CONDITIONS = ("Economy", "Comfort", "Business")
FLIGHT_STATUSES = ("Scheduled", "On Time", "Delayed", "Boarding", "Departed", "Arrived", "Cancelled")
CHECK_STATUSES = ("PASS", "FAIL", "WARN")
LAYERS_FROM = ("source", "raw", "stg", "ods", "dds", "dm")
LAYERS_TO = ("raw", "stg", "ods", "dds", "dm")
SEAM_ORDER = ("source → raw", "raw → ods", "ods → dds", "dds → dds")
OPEN_END = "9999-12-31 00:00:00"
STUB_KEY = "-1"

# --- Fixed values: reconciliation checks (id, type, layer from, layer to, object, description) ----------------------

CHECKS = [
    ("RC-01", "row_count", "source", "raw", "dim_airplanes", "Source FDW airplanes vs RAW actual airplanes: live-FDW check, assumes source is stable during PMI"),
    ("RC-02", "row_count", "raw", "ods", "dim_airplanes", "RAW actual airplanes vs ODS active airplanes: checks that ODS correctly collapsed RAW I/U/D journal"),
    ("RC-03", "row_count", "ods", "dds", "dim_airplanes", "ODS active airplanes vs DDS current airplane versions: checks SCD2 current slice completeness"),
    ("SCD2-01", "scd2", "dds", "dds", "dim_airplanes", "DDS dim_airplanes SCD2 check: no more than one current version per airplane_code"),
    ("SCD2-02", "scd2", "dds", "dds", "dim_airplanes", "DDS dim_airplanes SCD2 check: no overlapping validity periods by airplane_code"),
    ("SCD2-03", "scd2", "dds", "dds", "dim_airplanes", "DDS dim_airplanes SCD2 warning: validity period gaps between versions by airplane_code"),
    ("RC-04", "row_count", "source", "raw", "dim_seats", "Source FDW seats vs RAW actual seats: live-FDW check, assumes source is stable during PMI"),
    ("RC-05", "row_count", "raw", "ods", "dim_seats", "RAW actual seats vs ODS active seats: checks that ODS correctly collapsed RAW I/U/D journal"),
    ("RC-06", "row_count", "ods", "dds", "dim_seats", "ODS active seats vs DDS active seats: checks SCD1 dimension completeness by airplane_code and seat_no, excluding technical stub row"),
    ("DUP-01", "duplicate", "dds", "dds", "dim_seats", "DDS dim_seats duplicate/key check: no duplicates and no null business keys by airplane_code and seat_no for active records"),
    ("RC-07", "row_count", "source", "raw", "fact_bookings", "Source FDW bookings vs RAW actual bookings: live-FDW check, assumes source is stable during PMI"),
    ("RC-08", "row_count", "raw", "ods", "fact_bookings", "RAW actual bookings vs ODS active bookings: checks that ODS correctly collapsed RAW I/U/D journal"),
    ("RC-09", "row_count", "ods", "dds", "fact_bookings", "ODS active bookings vs DDS active fact_bookings: checks fact completeness by book_ref, excluding technical stub row"),
    ("DUP-02", "duplicate", "dds", "dds", "fact_bookings", "DDS fact_bookings duplicate/key check: no duplicates and no null book_ref for active records"),
    ("AGG-01", "aggregate", "ods", "dds", "fact_bookings", "ODS active bookings vs DDS active fact_bookings: total_amount sum reconciliation, excluding technical stub row"),
]

# --- Fixed values: source dictionary (object, column, type, nullability, description) -------------------------------

DICTIONARY = [
    ("airplanes_data", None, None, None, "Самолёты с переводами моделей"),
    ("airplanes_data", "airplane_code", "char(3)", "not null", "Код самолёта, ИАТА"),
    ("airplanes_data", "model", "jsonb", "not null", "Модель самолёта на разных языках"),
    ("airplanes_data", "range", "integer", "not null", "Максимальная дальность полёта, км"),
    ("airplanes_data", "speed", "integer", "not null", "Крейсерская скорость, км/ч"),
    ("airports_data", None, None, None, "Аэропорты с переводами названий, городов и стран"),
    ("airports_data", "airport_code", "char(3)", "not null", "Код аэропорта, ИАТА"),
    ("airports_data", "airport_name", "jsonb", "not null", "Название аэропорта на разных языках"),
    ("airports_data", "city", "jsonb", "not null", "Город на разных языках"),
    ("airports_data", "country", "jsonb", "not null", "Страна на разных языках"),
    ("airports_data", "coordinates", "point", "not null", "Координаты аэропорта"),
    ("airports_data", "timezone", "text", "not null", "Часовой пояс аэропорта"),
    ("boarding_passes", None, None, None, "Посадочные талоны"),
    ("boarding_passes", "ticket_no", "text", "not null", "Номер билета"),
    ("boarding_passes", "flight_id", "integer", "not null", "Идентификатор рейса"),
    ("boarding_passes", "seat_no", "text", "not null", "Номер места"),
    ("boarding_passes", "boarding_no", "integer", None, "Номер посадочного талона"),
    ("boarding_passes", "boarding_time", "timestamptz", None, "Время посадки"),
    ("bookings", None, None, None, "Бронирования"),
    ("bookings", "book_ref", "char(6)", "not null", "Номер бронирования"),
    ("bookings", "book_date", "timestamptz", "not null", "Дата бронирования"),
    ("bookings", "total_amount", "numeric(10,2)", "not null", "Полная сумма бронирования"),
    ("flights", None, None, None, "Рейсы"),
    ("flights", "flight_id", "integer", "not null", "Идентификатор рейса"),
    ("flights", "route_no", "text", "not null", "Номер маршрута"),
    ("flights", "status", "text", "not null", "Статус рейса"),
    ("flights", "scheduled_departure", "timestamptz", "not null", "Время вылета по расписанию"),
    ("flights", "scheduled_arrival", "timestamptz", "not null", "Время прилёта по расписанию"),
    ("flights", "actual_departure", "timestamptz", None, "Фактическое время вылета"),
    ("flights", "actual_arrival", "timestamptz", None, "Фактическое время прилёта"),
    ("routes", None, None, None, "Маршруты"),
    ("routes", "route_no", "text", "not null", "Номер маршрута"),
    ("routes", "validity", "tstzrange", "not null", "Период действия маршрута"),
    ("routes", "departure_airport", "char(3)", "not null", "Аэропорт отправления"),
    ("routes", "arrival_airport", "char(3)", "not null", "Аэропорт прибытия"),
    ("routes", "airplane_code", "char(3)", "not null", "Код самолёта, ИАТА"),
    ("routes", "days_of_week", "integer[]", "not null", "Дни недели выполнения рейсов"),
    ("routes", "scheduled_time", "time", "not null", "Местное время вылета по расписанию"),
    ("routes", "duration", "interval", "not null", "Планируемая длительность полёта"),
    ("seats", None, None, None, "Места в самолётах"),
    ("seats", "airplane_code", "char(3)", "not null", "Код самолёта, ИАТА"),
    ("seats", "seat_no", "text", "not null", "Номер места"),
    ("seats", "fare_conditions", "text", "not null", "Класс обслуживания"),
    ("segments", None, None, None, "Перелёты по билетам"),
    ("segments", "ticket_no", "text", "not null", "Номер билета"),
    ("segments", "flight_id", "integer", "not null", "Идентификатор рейса"),
    ("segments", "fare_conditions", "text", "not null", "Класс обслуживания"),
    ("segments", "price", "numeric(10,2)", "not null", "Стоимость перелёта"),
    ("tickets", None, None, None, "Билеты"),
    ("tickets", "ticket_no", "text", "not null", "Номер билета"),
    ("tickets", "book_ref", "char(6)", "not null", "Номер бронирования"),
    ("tickets", "passenger_id", "text", "not null", "Номер документа пассажира"),
    ("tickets", "passenger_name", "text", "not null", "Полное имя пассажира"),
    ("tickets", "outbound", "boolean", "not null", "Признак прямого билета"),
]

# --- Fixed values: constraints (table, name, type, columns, referenced table, referenced columns, rule, description) -

CONSTRAINTS = [
    ("airplanes_data", "airplanes_data_pkey", "PRIMARY KEY", "airplane_code", None, None, None, "Уникальный ключ самолёта"),
    ("airplanes_data", "airplanes_data_range_check", "CHECK", "range", None, None, "range > 0", "Дальность полёта должна быть больше нуля"),
    ("airplanes_data", "airplanes_data_speed_check", "CHECK", "speed", None, None, "speed > 0", "Крейсерская скорость должна быть больше нуля"),
    ("airports_data", "airports_data_pkey", "PRIMARY KEY", "airport_code", None, None, None, "Уникальный ключ аэропорта"),
    ("boarding_passes", "boarding_passes_pkey", "PRIMARY KEY", "ticket_no, flight_id", None, None, None, "Уникальный ключ посадочного талона"),
    ("boarding_passes", "boarding_passes_flight_boarding_no_key", "UNIQUE", "flight_id, boarding_no", None, None, None, "Номер посадочного талона уникален в рамках рейса"),
    ("boarding_passes", "boarding_passes_flight_seat_no_key", "UNIQUE", "flight_id, seat_no", None, None, None, "Одно место не может быть выдано двум пассажирам на одном рейсе"),
    ("boarding_passes", "boarding_passes_ticket_flight_fkey", "FOREIGN KEY", "ticket_no, flight_id", "segments", "ticket_no, flight_id", None, "Посадочный талон связан с перелётом билета"),
    ("bookings", "bookings_pkey", "PRIMARY KEY", "book_ref", None, None, None, "Уникальный ключ бронирования"),
    ("flights", "flights_pkey", "PRIMARY KEY", "flight_id", None, None, None, "Уникальный ключ рейса"),
    ("flights", "flights_route_departure_key", "UNIQUE", "route_no, scheduled_departure", None, None, None, "Естественный ключ рейса: маршрут и плановая дата вылета"),
    ("flights", "flights_scheduled_arrival_check", "CHECK", "scheduled_arrival, scheduled_departure", None, None, "scheduled_arrival > scheduled_departure", "Плановое время прилёта должно быть позже планового времени вылета"),
    ("flights", "flights_actual_arrival_check", "CHECK", "actual_arrival, actual_departure", None, None, "actual_arrival is null or actual_arrival > actual_departure", "Фактическое время прилёта должно быть позже фактического времени вылета"),
    ("flights", "flights_status_check", "CHECK", "status", None, None, "status in (Scheduled, On Time, Delayed, Boarding, Departed, Arrived, Cancelled)", "Статус рейса должен входить в допустимый список"),
    ("routes", "routes_temporal_exclude", "EXCLUDE", "route_no, validity", None, None, "route_no with =, validity with &&", "Для одного route_no интервалы validity не должны пересекаться"),
    ("routes", "routes_airplane_code_fkey", "FOREIGN KEY", "airplane_code", "airplanes_data", "airplane_code", None, "Маршрут связан с самолётом"),
    ("routes", "routes_departure_airport_fkey", "FOREIGN KEY", "departure_airport", "airports_data", "airport_code", None, "Маршрут связан с аэропортом отправления"),
    ("routes", "routes_arrival_airport_fkey", "FOREIGN KEY", "arrival_airport", "airports_data", "airport_code", None, "Маршрут связан с аэропортом прибытия"),
    ("seats", "seats_pkey", "PRIMARY KEY", "airplane_code, seat_no", None, None, None, "Уникальный ключ места в самолёте"),
    ("seats", "seats_fare_conditions_check", "CHECK", "fare_conditions", None, None, "fare_conditions in (Economy, Comfort, Business)", "Класс обслуживания должен входить в допустимый список"),
    ("seats", "seats_airplane_code_fkey", "FOREIGN KEY", "airplane_code", "airplanes_data", "airplane_code", None, "Место связано с самолётом"),
    ("segments", "segments_pkey", "PRIMARY KEY", "ticket_no, flight_id", None, None, None, "Уникальный ключ перелёта в билете"),
    ("segments", "segments_price_check", "CHECK", "price", None, None, "price >= 0", "Стоимость перелёта не может быть отрицательной"),
    ("segments", "segments_fare_conditions_check", "CHECK", "fare_conditions", None, None, "fare_conditions in (Economy, Comfort, Business)", "Класс обслуживания должен входить в допустимый список"),
    ("segments", "segments_ticket_no_fkey", "FOREIGN KEY", "ticket_no", "tickets", "ticket_no", None, "Перелёт связан с билетом"),
    ("segments", "segments_flight_id_fkey", "FOREIGN KEY", "flight_id", "flights", "flight_id", None, "Перелёт связан с рейсом"),
    ("tickets", "tickets_pkey", "PRIMARY KEY", "ticket_no", None, None, None, "Уникальный ключ билета"),
    ("tickets", "tickets_book_ref_passenger_outbound_key", "UNIQUE", "book_ref, passenger_id, outbound", None, None, None, "Один пассажир не может иметь два одинаковых билета одного направления в рамках одного бронирования"),
    ("tickets", "tickets_book_ref_fkey", "FOREIGN KEY", "book_ref", "bookings", "book_ref", None, "Билет связан с бронированием"),
]

# --- Fixed values: indexes (table, name, type, columns, unique, description) ----------------------------------------

INDEXES = [
    ("airplanes_data", "airplanes_data_pkey_idx", "btree", "airplane_code", True, "Индекс первичного ключа самолётов"),
    ("airports_data", "airports_data_pkey_idx", "btree", "airport_code", True, "Индекс первичного ключа аэропортов"),
    ("boarding_passes", "boarding_passes_pkey_idx", "btree", "ticket_no, flight_id", True, "Индекс первичного ключа посадочных талонов"),
    ("boarding_passes", "boarding_passes_flight_boarding_no_idx", "btree", "flight_id, boarding_no", True, "Уникальный индекс номера посадочного талона в рамках рейса"),
    ("boarding_passes", "boarding_passes_flight_seat_no_idx", "btree", "flight_id, seat_no", True, "Уникальный индекс места в рамках рейса"),
    ("bookings", "bookings_pkey_idx", "btree", "book_ref", True, "Индекс первичного ключа бронирований"),
    ("flights", "flights_pkey_idx", "btree", "flight_id", True, "Индекс первичного ключа рейсов"),
    ("flights", "flights_route_departure_idx", "btree", "route_no, scheduled_departure", True, "Уникальный индекс естественного ключа рейса"),
    ("routes", "routes_departure_airport_lower_validity_idx", "btree", "departure_airport, lower(validity)", False, "Индекс для поиска маршрутов по аэропорту отправления и началу периода действия"),
    ("routes", "routes_temporal_exclude_idx", "gist", "route_no, validity", True, "GiST-индекс для ограничения пересечения интервалов validity по route_no"),
    ("seats", "seats_pkey_idx", "btree", "airplane_code, seat_no", True, "Индекс первичного ключа мест"),
    ("segments", "segments_pkey_idx", "btree", "ticket_no, flight_id", True, "Индекс первичного ключа перелётов"),
    ("segments", "segments_flight_id_idx", "btree", "flight_id", False, "Индекс для поиска перелётов по рейсу"),
    ("tickets", "tickets_pkey_idx", "btree", "ticket_no", True, "Индекс первичного ключа билетов"),
    ("tickets", "tickets_book_ref_passenger_outbound_idx", "btree", "book_ref, passenger_id, outbound", True, "Уникальный индекс пассажира и направления внутри бронирования"),
]

# --- Fixed values: constraints of the warehouse tables (table, name, type, columns, referenced table, referenced columns,
# --- rule, description); a rule on a UNIQUE constraint limits it to the rows it holds for --------------------------------

WAREHOUSE_CONSTRAINTS = [
    ("ods.airplanes", "pk_ods_airplanes", "PRIMARY KEY", "airplane_code", None, None, None, None),
    ("ods.airports", "pk_ods_airports", "PRIMARY KEY", "airport_code", None, None, None, None),
    ("ods.routes", "pk_ods_routes", "PRIMARY KEY", "route_no, validity", None, None, None, None),
    ("ods.seats", "pk_ods_seats", "PRIMARY KEY", "airplane_code, seat_no", None, None, None, None),
    ("ods.flights", "pk_ods_flights", "PRIMARY KEY", "flight_id", None, None, None, None),
    ("ods.bookings", "pk_ods_bookings", "PRIMARY KEY", "book_ref", None, None, None, None),
    ("ods.tickets", "pk_ods_tickets", "PRIMARY KEY", "ticket_no", None, None, None, None),
    ("ods.segments", "pk_ods_segments", "PRIMARY KEY", "ticket_no, flight_id", None, None, None, None),
    ("ods.boarding_passes", "pk_ods_boarding_passes", "PRIMARY KEY", "ticket_no, flight_id", None, None, None, None),
    ("dds.dim_airplanes", "pk_dds_airplanes", "PRIMARY KEY", "airplane_sk", None, None, None, None),
    ("dds.dim_airplanes", "chk_dds_airplanes_valid_period", "CHECK", "valid_to, valid_from", None, None, "valid_to > valid_from", None),
    ("dds.dim_airplanes", "uq_dds_dim_airplanes_current", "UNIQUE", "airplane_code", None, None, "is_current = true", None),
    ("dds.dim_airports", "pk_dds_airports", "PRIMARY KEY", "airport_sk", None, None, None, None),
    ("dds.dim_airports", "chk_dds_airports_valid_period", "CHECK", "valid_to, valid_from", None, None, "valid_to > valid_from", None),
    ("dds.dim_airports", "uq_dds_dim_airport_current", "UNIQUE", "airport_code", None, None, "is_current = true", None),
    ("dds.dim_routes", "pk_dds_routes", "PRIMARY KEY", "route_sk", None, None, None, None),
    ("dds.dim_routes", "uq_dds_dim_seats_source_key", "UNIQUE", "route_no, validity", None, None, None, None),
    ("dds.dim_routes", "fk_dds_routes_departure_airport", "FOREIGN KEY", "departure_airport_sk", "dds.dim_airports", "airport_sk", None, None),
    ("dds.dim_routes", "fk_dds_routes_arrival_airport", "FOREIGN KEY", "arrival_airport_sk", "dds.dim_airports", "airport_sk", None, None),
    ("dds.dim_routes", "fk_dds_routes_airplane", "FOREIGN KEY", "airplane_sk", "dds.dim_airplanes", "airplane_sk", None, None),
    ("dds.dim_seats", "pk_dds_dim_seats", "PRIMARY KEY", "seat_sk", None, None, None, None),
    ("dds.dim_seats", "uq_dds_dim_routes_source_key", "UNIQUE", "seat_no, airplane_code", None, None, None, None),
    ("dds.dim_seats", "fk_dds_dim_seats_airplane", "FOREIGN KEY", "airplane_sk", "dds.dim_airplanes", "airplane_sk", None, None),
    ("dds.dim_passenger", "pk_dds_dim_passenger", "PRIMARY KEY", "passenger_sk", None, None, None, None),
    ("dds.dim_passenger", "uq_dds_dim_passenger_passenger_id", "UNIQUE", "passenger_id", None, None, None, None),
    ("dds.fact_flights", "pk_dds_fact_flights", "PRIMARY KEY", "flight_sk", None, None, None, None),
    ("dds.fact_flights", "uq_dds_fact_flights_source_key", "UNIQUE", "flight_id", None, None, None, None),
    ("dds.fact_flights", "fk_dds_fact_flights_routes", "FOREIGN KEY", "route_sk", "dds.dim_routes", "route_sk", None, None),
    ("dds.fact_flights", "chk_dds_fact_flights_sch", "CHECK", "scheduled_departure, scheduled_arrival", None, None, "scheduled_departure < scheduled_arrival", None),
    ("dds.fact_flights", "chk_dds_fact_flights_act", "CHECK", "actual_departure, actual_arrival", None, None, "actual_arrival is null or (actual_departure is not null and actual_departure < actual_arrival)", None),
    ("dds.fact_bookings", "pk_dds_fact_bookings", "PRIMARY KEY", "bookings_sk", None, None, None, None),
    ("dds.fact_bookings", "uq_dds_fact_bookings_source_key", "UNIQUE", "book_ref", None, None, None, None),
    ("dds.fact_tickets", "pk_dds_fact_tickets", "PRIMARY KEY", "ticket_sk", None, None, None, None),
    ("dds.fact_tickets", "fk_dds_fact_tickets_bookings", "FOREIGN KEY", "bookings_sk", "dds.fact_bookings", "bookings_sk", None, None),
    ("dds.fact_tickets", "fk_dds_fact_tickets_passenger", "FOREIGN KEY", "passenger_sk", "dds.dim_passenger", "passenger_sk", None, None),
    ("dds.fact_tickets", "uq_dds_fact_tickets_source_key", "UNIQUE", "ticket_no", None, None, None, None),
    ("dds.fact_segments", "pk_dds_fact_segments", "PRIMARY KEY", "segment_sk", None, None, None, None),
    ("dds.fact_segments", "uq_dds_fact_segments_source_key", "UNIQUE", "ticket_sk, flight_sk", None, None, None, None),
    ("dds.fact_segments", "fk_dds_fact_segments_ticket", "FOREIGN KEY", "ticket_sk", "dds.fact_tickets", "ticket_sk", None, None),
    ("dds.fact_segments", "fk_dds_fact_segments_flight", "FOREIGN KEY", "flight_sk", "dds.fact_flights", "flight_sk", None, None),
    ("dds.fact_boarding_passes", "pk_dds_fact_boarding_passes", "PRIMARY KEY", "boarding_pass_sk", None, None, None, None),
    ("dds.fact_boarding_passes", "uq_dds_fact_boarding_passes", "UNIQUE", "ticket_sk, flight_sk", None, None, None, None),
    ("dds.fact_boarding_passes", "fk_dds_fact_boarding_passes_ticket", "FOREIGN KEY", "ticket_sk", "dds.fact_tickets", "ticket_sk", None, None),
    ("dds.fact_boarding_passes", "fk_dds_fact_boarding_passes_flight", "FOREIGN KEY", "flight_sk", "dds.fact_flights", "flight_sk", None, None),
    ("dm.flight_sales_mart", "pk_dm_flight_sales_mart", "PRIMARY KEY", "ticket_no, flight_id", None, None, None, None),
    ("dm.flight_revenue_mart", "pk_dm_flight_revenue_mart", "PRIMARY KEY", "flight_id", None, None, None, None),
    ("dm.airport_traffic_daily", "pk_dm_airport_traffic_daily", "PRIMARY KEY", "traffic_date, airport_name", None, None, None, None),
    ("dq.pmi_results", "chk_dq_pmi_results_status", "CHECK", "status", None, None, "status in ('PASS', 'FAIL', 'WARN')", None),
    ("dq.pmi_results", "chk_dq_pmi_results_layers", "CHECK", "layer_from", None, None, "layer_from in ('source', 'raw', 'stg', 'ods', 'dds', 'dm')", None),
    ("dq.pmi_results", "chk_dq_pmi_results_layer_to", "CHECK", "layer_to", None, None, "layer_to in ('raw', 'stg', 'ods', 'dds', 'dm')", None),
]
