"""Schemas of the landed sources, as DDL text.

Fixed values: column names and order are those of the publishers. Columns that may hold dirty text, or numbers written as
text, are read as STRING and coerced by the cleaning jobs. A scan keeps the columns its schema names: of the 19 taxi
columns offered, 14 are kept.
"""

RAW_FHV = """
    pickup_datetime STRING, dropoff_datetime STRING, pulocationid STRING, dolocationid STRING,
    trip_miles STRING, base_passenger_fare STRING, tolls STRING, tips STRING, driver_pay STRING
"""
RAW_YLC = """
    vendorid STRING, tpep_pickup_datetime STRING, tpep_dropoff_datetime STRING, passenger_count STRING,
    trip_distance STRING, pulocationid STRING, dolocationid STRING, payment_type STRING, fare_amount STRING,
    extra STRING, tip_amount STRING, tolls_amount STRING, congestion_surcharge STRING, total_amount STRING
"""
RAW_TRAFFIC = """
    RequestID BIGINT, Boro STRING, Yr INT, M INT, D INT, HH INT, MM INT, Vol BIGINT, SegmentID BIGINT,
    WktGeom STRING, street STRING, fromSt STRING, toSt STRING, Direction STRING
"""
RAW_EVENTS = """
    `Event ID` STRING, `Event Name` STRING, `Start Date/Time` STRING, `End Date/Time` STRING,
    `Event Agency` STRING, `Event Type` STRING, `Event Borough` STRING, `Event Location` STRING,
    `Event Street Side` STRING, `Street Closure Type` STRING, `Community Board` STRING, `Police Precinct` STRING
"""
RAW_EVENT_PAGES = """
    event_id STRING, event_name STRING, start_date_time STRING, end_date_time STRING, event_agency STRING,
    event_type STRING, event_borough STRING, event_location STRING, event_street_side STRING,
    street_closure_type STRING, community_board STRING, police_precinct STRING
"""
RAW_GAMES = "venue STRING, start_time_ny STRING, end_time_ny STRING"
RAW_WEATHER = """
    date STRING, temperature_2m STRING, precipitation STRING, rain STRING, snowfall STRING, snow_depth STRING
"""
ZONE_LOOKUP = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
SCHEDULE = """
    dates ARRAY<STRUCT<games: ARRAY<STRUCT<
        gameDate: STRING, venue: STRUCT<name: STRING>, gameInfo: STRUCT<gameDurationMinutes: INT>>>>>
"""
WEATHER_RESPONSE = """
    time_start BIGINT, time_end BIGINT, interval_s BIGINT, temperature_2m ARRAY<DOUBLE>,
    precipitation ARRAY<DOUBLE>, rain ARRAY<DOUBLE>, snowfall ARRAY<DOUBLE>, snow_depth ARRAY<DOUBLE>
"""
