"""The registered queries once more as DuckDB SQL over the benchmark tables, for differential checks.

Written row by row in the plain form of each definition: matches are joined out in full, shares divide by
subqueries, the map projection uses the series solution instead of iteration.
"""

from __future__ import annotations

import re


def _r(expr: str, name: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"round_even(({expr}) * {scale}, 0) / {scale} + 0.0 AS {name}"


def _boro(index: str) -> str:
    names = ["Bronx", "Queens", "Manhattan", "Brooklyn", "Staten Island"]
    return f"(['{names[0]}', '{names[1]}', '{names[2]}', '{names[3]}', '{names[4]}'])[({index}) + 1]"


# Fixed values, written out independently of the code: the parameters of EPSG:2263 on the GRS80 ellipsoid.
_GRID = {
    "SEMI_MAJOR_M": "CAST(6378137.0 AS DOUBLE)",
    "FLATTENING": "(1 / CAST(298.257222101 AS DOUBLE))",
    "LATITUDE_ORIGIN": "(40 + 10 / CAST(60 AS DOUBLE))",
    "LONGITUDE_ORIGIN": "CAST(-74.0 AS DOUBLE)",
    "PARALLEL_SOUTH": "(40 + 40 / CAST(60 AS DOUBLE))",
    "PARALLEL_NORTH": "(41 + 2 / CAST(60 AS DOUBLE))",
    "FALSE_EASTING_M": "CAST(300000.0 AS DOUBLE)",
}

_MINUTES = "date_diff('microsecond', {a}, {b}) / 1e6 / 60"

_SEGMENT = """CASE WHEN {h} BETWEEN 5 AND 7 THEN 'Primera mañana' WHEN {h} BETWEEN 8 AND 10 THEN 'Hora pico mañana'
                    WHEN {h} BETWEEN 11 AND 15 THEN 'Mediodía' WHEN {h} BETWEEN 16 AND 20 THEN 'Regreso a casa'
                    ELSE 'Noche / Madrugada' END"""

# Named subqueries. A statement pulls in the ones it mentions.
_CTE: dict[str, str] = {
    "b_ylc": """
        SELECT CAST(event_id % 2 + 1 AS INTEGER) AS vendorid,
               CASE WHEN event_id % 199 <> 0 THEN ts END AS pickup,
               ts + to_minutes(event_id % 50 - 5) AS dropoff,
               CAST(CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN event_id % 5 END AS DOUBLE) AS passenger_count,
               CASE WHEN event_id % 103 <> 0 THEN value / 10 - 1 END AS trip_distance,
               CAST(user_id % 27 AS INTEGER) AS pulocationid, CAST(user_id * 7 % 27 AS INTEGER) AS dolocationid,
               CAST(event_id % 4 AS INTEGER) AS payment_type, value AS fare_amount, CAST(0.5 AS DOUBLE) AS extra,
               value * CAST(0.1 AS DOUBLE) AS tip_amount, CAST(event_id % 7 AS DOUBLE) AS tolls_amount,
               CAST(2.5 AS DOUBLE) AS congestion_surcharge,
               CASE WHEN event_id % 107 <> 0 THEN value - 5 END AS total_amount
        FROM events""",
    "b_fhv": """
        SELECT CASE WHEN event_id % 211 <> 0 THEN ts - INTERVAL 20 MINUTE END AS pickup,
               ts + to_minutes(event_id * 7 % 53 - 24) AS dropoff,
               CAST(CASE WHEN event_id % 61 <> 0 THEN user_id % 27 END AS DOUBLE) AS pulocationid,
               CAST(user_id * 7 % 27 AS DOUBLE) AS dolocationid,
               value / 10 - CAST(0.5 AS DOUBLE) AS trip_miles,
               CASE WHEN event_id % 53 <> 0 THEN value - 3 END AS base_passenger_fare,
               CASE WHEN event_id % 7 <> 0 THEN value * CAST(0.05 AS DOUBLE) END AS tolls,
               CASE WHEN event_id % 59 <> 0 THEN value * CAST(0.1 AS DOUBLE) END AS tips,
               CASE WHEN event_id % 109 <> 0 THEN value * CAST(0.7 AS DOUBLE) - 2 END AS driver_pay
        FROM events""",
    "lookup": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS LocationID, n_name AS zone,
               CASE WHEN n_nationkey = 24 THEN 'Unknown' WHEN n_nationkey <> 13 THEN {_boro('n_regionkey')} END AS Borough
        FROM nation""",
    "ylc_timed": f"""
        SELECT *, round_even({_MINUTES.format(a='pickup', b='dropoff')} * 100, 0) / 100 AS trip_duration_min
        FROM b_ylc WHERE pickup IS NOT NULL AND dropoff IS NOT NULL""",
    "ylc": """
        SELECT * FROM ylc_timed
        WHERE trip_distance > 0 AND total_amount > 0 AND passenger_count > 0 AND trip_duration_min > 0""",
    "fhv_timed": f"SELECT *, {_MINUTES.format(a='pickup', b='dropoff')} AS trip_duration_min FROM b_fhv",
    "fhv": """
        SELECT * FROM fhv_timed
        WHERE trip_duration_min > 0 AND trip_miles >= 0 AND base_passenger_fare >= 0 AND driver_pay >= 0""",
    "services": """
        SELECT pickup, CAST(pulocationid AS BIGINT) AS pulocationid, 'FHV' AS service FROM fhv
        UNION ALL SELECT pickup, CAST(pulocationid AS BIGINT), 'YLC' FROM ylc""",
    "trips": """
        SELECT pickup AS pickup_datetime, pulocationid, service AS tipo_servicio, CAST(hour(pickup) AS INTEGER) AS pickup_hour
        FROM services WHERE pickup IS NOT NULL AND pulocationid IS NOT NULL""",
    "titled": """
        SELECT pickup AS datetime, pulocationid, CASE service WHEN 'FHV' THEN 'Uber/FHV' ELSE 'Taxi Amarillo' END AS tipo_servicio,
               CAST(hour(pickup) AS INTEGER) AS hora_entera
        FROM services""",
    "zh_counts": """
        SELECT pulocationid AS LocationID, pickup_hour,
               count(*) FILTER (WHERE tipo_servicio = 'FHV') AS FHV, count(*) FILTER (WHERE tipo_servicio = 'YLC') AS YLC
        FROM trips GROUP BY ALL""",
    "zh": f"""
        SELECT LocationID, pickup_hour, FHV, YLC, FHV + YLC AS total,
               {_r('CAST(FHV AS DOUBLE) / (FHV + YLC)', 'market_share')}, {_r('CAST(FHV AS DOUBLE) / (YLC + 1)', 'ratio')}
        FROM zh_counts""",
    "hourly_trips": """
        SELECT 'YLC' AS tipo_servicio, pickup AS pickup_datetime, trip_distance, fare_amount, total_amount,
               trip_duration_min, CAST(NULL AS DOUBLE) AS tolls, CAST(NULL AS DOUBLE) AS tips,
               date_trunc('hour', pickup) AS datetime_hour FROM ylc
        UNION ALL
        SELECT 'FHV', pickup, trip_miles, base_passenger_fare, base_passenger_fare + tolls, trip_duration_min, tolls, tips,
               date_trunc('hour', pickup) FROM fhv""",
    "mobility_counts": """
        SELECT datetime_hour, coalesce(y.n, 0) AS YLC, coalesce(h.n, 0) AS FHV
        FROM (SELECT datetime_hour, count(*) AS n FROM hourly_trips WHERE tipo_servicio = 'YLC' GROUP BY 1) y
        FULL JOIN (SELECT datetime_hour, count(*) AS n FROM hourly_trips WHERE tipo_servicio = 'FHV' GROUP BY 1) h
        USING (datetime_hour)""",
    "mobility": """
        SELECT datetime_hour, YLC, FHV, YLC + FHV AS total, CAST(FHV AS DOUBLE) / (YLC + FHV) AS market_share,
               CAST(FHV AS DOUBLE) / (YLC + 1) AS ratio
        FROM mobility_counts""",
    "b_weather": """
        SELECT TIMESTAMP '2024-01-01' + to_hours(CAST(l_orderkey % 718 AS INTEGER)) AS stamp, count(*) AS c
        FROM lineitem GROUP BY 1""",
    "weather": """
        SELECT stamp, CAST(c % 5 AS DOUBLE) AS temperature_2m, CAST(c % 3 AS DOUBLE) AS precipitation,
               CAST(c % 3 AS DOUBLE) AS rain, CAST(0 AS DOUBLE) AS snowfall, CAST(0 AS DOUBLE) AS snow_depth
        FROM b_weather""",
    "hourly_all": """
        SELECT m.*, coalesce(temperature_2m, 0) AS temperature_2m, coalesce(precipitation, 0) AS precipitation,
               coalesce(rain, 0) AS rain, coalesce(snowfall, 0) AS snowfall, coalesce(snow_depth, 0) AS snow_depth
        FROM mobility m LEFT JOIN weather w ON w.stamp = m.datetime_hour""",
    "hourly": """
        SELECT * FROM hourly_all QUALIFY row_number() OVER (
            PARTITION BY YLC, FHV, total, market_share, ratio, temperature_2m, precipitation, rain, snowfall, snow_depth
            ORDER BY datetime_hour) = 1""",
    "rain_means": """
        SELECT precipitation > 0 AS wet, avg(YLC) AS YLC, avg(FHV) AS FHV, avg(total) AS total, avg(market_share) AS market_share
        FROM hourly GROUP BY 1""",
    "seg": f"""
        SELECT {_SEGMENT.format(h='pickup_hour')} AS segmento,
               LocationID, CAST(sum(FHV) AS BIGINT) AS FHV, CAST(sum(YLC) AS BIGINT) AS YLC
        FROM zh GROUP BY 1, 2""",
    "seg_share": f"SELECT *, {_r('CAST(FHV AS DOUBLE) / (FHV + YLC)', 'market_share', 4)} FROM seg",
    # Traffic
    "b_traffic": f"""
        SELECT event_id, {_boro('user_id % 5')} AS Boro,
               CAST(CASE WHEN event_id % 307 = 0 THEN 2022 ELSE year(ts) END AS INTEGER) AS Yr,
               CAST(CASE WHEN event_id % 509 = 0 THEN 13 ELSE month(ts) END AS INTEGER) AS M,
               CAST(day(ts) AS INTEGER) AS D, CAST(hour(ts) AS INTEGER) AS HH,
               CAST(minute(ts) // 15 * 15 AS INTEGER) AS MM,
               CASE WHEN event_id % 401 <> 0 THEN CAST(floor(value) AS BIGINT) - 3 END AS Vol,
               user_id % 150 AS SegmentID,
               CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 THEN 920000.25::DOUBLE + 1000 * (user_id % 150) END AS x,
               CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 THEN 150000::DOUBLE + 700 * (user_id % 150) END AS y,
               CASE WHEN event_id % 101 = 0 THEN 'bad' WHEN event_id % 103 = 0 THEN 'POINT(1 2)' ELSE
                    'POINT (' || (920000 + 1000 * (user_id % 150)) || '.25 ' || (150000 + 700 * (user_id % 150)) || ')' END AS WktGeom,
               'Main Street ' || (user_id % 150) AS street
        FROM events""",
    "timed": """
        SELECT *, CASE WHEN M <= 12 THEN make_timestamp(Yr, M, D, HH, MM, 0) END AS timestamp
        FROM b_traffic WHERE Yr IN (2023, 2024)""",
    "ellipsoid": f"""
        SELECT {_GRID['SEMI_MAJOR_M']} AS a, sqrt({_GRID['FLATTENING']} * (2 - {_GRID['FLATTENING']})) AS e,
               radians({_GRID['PARALLEL_SOUTH']}) AS p1, radians({_GRID['PARALLEL_NORTH']}) AS p2, radians({_GRID['LATITUDE_ORIGIN']}) AS p0""",
    "cone_parts": """
        SELECT a, e,
               cos(p1) / sqrt(1 - pow(e * sin(p1), 2)) AS m1, cos(p2) / sqrt(1 - pow(e * sin(p2), 2)) AS m2,
               tan(pi() / 4 - p1 / 2) / pow((1 - e * sin(p1)) / (1 + e * sin(p1)), e / 2) AS t1,
               tan(pi() / 4 - p2 / 2) / pow((1 - e * sin(p2)) / (1 + e * sin(p2)), e / 2) AS t2,
               tan(pi() / 4 - p0 / 2) / pow((1 - e * sin(p0)) / (1 + e * sin(p0)), e / 2) AS t0
        FROM ellipsoid""",
    "cone": """
        SELECT *, m1 / (n * pow(t1, n)) * a AS af, m1 / (n * pow(t1, n)) * a * pow(t0, n) AS rho0
        FROM (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM cone_parts)""",
    "polar": f"""
        SELECT event_id, atan2(x * 1200 / 3937 - {_GRID['FALSE_EASTING_M']}, rho0 - y * 1200 / 3937) / n AS dl,
               pi() / 2 - 2 * atan(pow(sqrt(pow(x * 1200 / 3937 - {_GRID['FALSE_EASTING_M']}, 2) + pow(rho0 - y * 1200 / 3937, 2)) / af, 1 / n)) AS c,
               e
        FROM b_traffic, cone WHERE x IS NOT NULL""",
    "places": f"""
        SELECT event_id, {_GRID['LONGITUDE_ORIGIN']} + degrees(dl) AS longitude,
               degrees(c + (pow(e, 2) / 2 + 5 * pow(e, 4) / 24 + pow(e, 6) / 12 + 13 * pow(e, 8) / 360) * sin(2 * c)
                 + (7 * pow(e, 4) / 48 + 29 * pow(e, 6) / 240 + 811 * pow(e, 8) / 11520) * sin(4 * c)
                 + (7 * pow(e, 6) / 120 + 81 * pow(e, 8) / 1120) * sin(6 * c)
                 + 4279 * pow(e, 8) / 161280 * sin(8 * c)) AS latitude
        FROM polar""",
    "placed": "SELECT t.*, longitude, latitude FROM timed t LEFT JOIN places USING (event_id)",
    "valid": "SELECT * FROM placed WHERE Vol >= 0 AND timestamp IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL",
    "features": """
        SELECT *, HH AS hora_entera, strftime(timestamp, '%A') AS dia_semana, strftime(timestamp, '%B') AS mes_nombre
        FROM valid WHERE Vol < (SELECT quantile_cont(CAST(Vol AS DOUBLE), 0.9995) FROM valid)""",
    # Events
    "b_events": f"""
        SELECT o_orderkey AS event_id, CASE WHEN o_orderkey % 41 <> 0 THEN 'Event ' || o_orderkey END AS event_name,
               CASE WHEN o_orderkey % 35 = 0 THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'Special Event' ELSE o_orderpriority END AS event_type,
               {_boro('o_custkey % 5')} AS event_borough,
               TIMESTAMP '2024-01-01' + to_hours(CAST(o_orderkey // 5 % 87600 AS INTEGER)) + to_minutes(o_custkey % 4 * 15) AS start_time,
               o_custkey % 6 - 1 AS hours, o_orderkey % 43 = 0 AS open_end
        FROM orders""",
    "ev": """
        SELECT event_id, event_name, event_type, event_borough, start_time,
               CASE WHEN NOT open_end THEN start_time + to_hours(CAST(hours AS INTEGER)) END AS end_time
        FROM b_events
        WHERE event_type IS NULL OR event_type NOT IN ('Sport - Youth', 'Sport - Adult', 'Special Event')""",
    "evh": """
        SELECT unnest(generate_series(start_time, end_time, INTERVAL 1 HOUR)) AS timestamp, event_borough AS Boro,
               event_type, event_id, event_name
        FROM ev WHERE end_time >= start_time""",
    "base": """
        SELECT *, avg(Vol) OVER (PARTITION BY Boro, dia_semana, hora_entera) AS baseline_vol FROM features""",
    "te": """
        SELECT b.*, event_type, e.event_id AS eid, event_name, (Vol - baseline_vol) / nullif(baseline_vol, 0) * 100 AS pct
        FROM base b LEFT JOIN evh e ON e.timestamp = b.timestamp AND e.Boro = b.Boro""",
    "games": """
        SELECT CASE s_suppkey % 2 WHEN 0 THEN 'Yankee Stadium' ELSE 'Citi Field' END AS venue,
               ((TIMESTAMP '2024-01-01 18:05:00' + to_hours(CAST(s_suppkey * 7 % 87600 AS INTEGER)))
                   AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS start_time_ny,
               CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0 THEN 150 + s_suppkey % 60 END AS minutes, s_suppkey
        FROM supplier""",
    "games_timed": "SELECT venue, start_time_ny, start_time_ny + to_minutes(minutes) AS end_time_ny FROM games",
    "week_games": "SELECT * FROM games_timed WHERE day(start_time_ny) BETWEEN 1 AND 7",
    "mlb_all": """
        SELECT (SELECT coalesce(max(event_id), 0) FROM ev)
                 + row_number() OVER (ORDER BY start_time_ny, venue, end_time_ny NULLS LAST) AS event_id,
               venue || ' MLB Game' AS event_name, 'MLB' AS event_type,
               CASE venue WHEN 'Yankee Stadium' THEN 'Bronx' ELSE 'Queens' END AS event_borough,
               start_time_ny AS start_time, end_time_ny AS end_time
        FROM games_timed""",
    "mlb_week": """
        SELECT (SELECT coalesce(max(event_id), 0) FROM ev)
                 + row_number() OVER (ORDER BY start_time_ny, venue, end_time_ny NULLS LAST) AS event_id,
               venue || ' MLB Game' AS event_name, 'MLB' AS event_type,
               CASE venue WHEN 'Yankee Stadium' THEN 'Bronx' ELSE 'Queens' END AS event_borough,
               start_time_ny AS start_time, end_time_ny AS end_time
        FROM week_games""",
    "mlbh": """
        SELECT date_trunc('hour', unnest(generate_series(start_time, end_time, INTERVAL 1 HOUR))) AS timestamp,
               event_borough AS Boro, event_type, event_id, event_name
        FROM mlb_week WHERE end_time >= start_time""",
    "tem": """
        SELECT t.* EXCLUDE (timestamp, event_type, eid, event_name), date_trunc('hour', t.timestamp) AS timestamp,
               coalesce(t.event_type, g.event_type) AS event_type, coalesce(t.eid, g.event_id) AS eid,
               coalesce(t.event_name, g.event_name) AS event_name
        FROM te t LEFT JOIN mlbh g ON g.timestamp = date_trunc('hour', t.timestamp) AND g.Boro = t.Boro""",
    "by_event": f"""
        SELECT s.*, event_name
        FROM (SELECT eid AS event_id, count(*) AS count, avg(pct) AS mean_impact,
                     quantile_cont(pct, 0.5) AS median_impact, max(pct) AS max_impact
              FROM tem WHERE eid IS NOT NULL GROUP BY 1) s
        LEFT JOIN (SELECT DISTINCT eid, event_name FROM tem) n ON n.eid = s.event_id""",
    "boxes": """
        SELECT event_type, quantile_cont(pct, 0.25) AS q1, quantile_cont(pct, 0.5) AS median, quantile_cont(pct, 0.75) AS q3
        FROM tem WHERE event_type IS NOT NULL AND pct IS NOT NULL GROUP BY 1""",
    "kde_rows": "SELECT event_type IS NOT NULL AS has_event, pct, count(*) AS n FROM tem WHERE pct IS NOT NULL GROUP BY 1, 2",
    "kde_stats": """
        SELECT event_type IS NOT NULL AS has_event, count(*) AS n_all, min(pct) AS lo, max(pct) AS hi,
               stddev_samp(pct) * pow(count(*), CAST(-0.2 AS DOUBLE)) AS bw
        FROM tem WHERE pct IS NOT NULL GROUP BY 1""",
    "kde_grid": """
        SELECT *, lo - 3 * bw + i * (hi - lo + 6 * bw) / 199 AS x
        FROM kde_stats, (SELECT unnest(range(200)) AS i)""",
    "kde_binned_at": """
        SELECT has_event, floor((pct - lo) * 1024 / (hi - lo)) AS edge, (pct - lo) * 1024 / (hi - lo) AS place, n
        FROM kde_rows JOIN kde_stats USING (has_event) WHERE hi > lo""",
    "kde_bins": """
        SELECT has_event, edge, sum(w) AS w FROM (
          SELECT has_event, edge, n * (1 - (place - edge)) AS w FROM kde_binned_at
          UNION ALL SELECT has_event, edge + 1, n * (place - edge) FROM kde_binned_at) GROUP BY ALL""",
    # Space
    "mapped": "SELECT t.*, l.LocationID, l.Borough FROM titled t LEFT JOIN lookup l ON l.LocationID = t.pulocationid",
    "traffic_share": """
        SELECT Boro AS Borough, 100.0::DOUBLE * sum(Vol) / (SELECT sum(Vol) FROM features) AS share FROM features GROUP BY 1""",
    "zone_slots": """
        SELECT LocationID, zone, CAST(h AS INTEGER) AS pickup_hour, coalesce(FHV, 0) AS FHV, coalesce(YLC, 0) AS YLC,
               coalesce(ratio, 0) AS ratio
        FROM lookup CROSS JOIN (SELECT unnest(range(24)) AS h)
        LEFT JOIN (SELECT LocationID AS loc, pickup_hour AS hr, FHV, YLC, ratio FROM zh) ON loc = LocationID AND hr = h""",
    "slider": """
        SELECT *, '2023-01-01T' || lpad(CAST(pickup_hour AS VARCHAR), 2, '0') || ':00:00' AS time,
               least(CAST(0.8 AS DOUBLE), ratio / (max(ratio) OVER (PARTITION BY pickup_hour) + 1)) AS fill_opacity
        FROM zone_slots""",
}

_NUMERIC = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "tip_amount",
    "tolls_amount",
    "congestion_surcharge",
    "total_amount",
]
_FHV_NUMERIC = ["trip_miles", "base_passenger_fare", "tolls", "tips", "driver_pay", "trip_duration_min"]
_CLEAN_FHV = f"""
    SELECT pickup AS pickup_datetime, dropoff AS dropoff_datetime, pulocationid, dolocationid,
           {', '.join(_r(c, c) for c in _FHV_NUMERIC)}
    FROM fhv"""
_TRAFFIC_KEYS = f"timestamp, SegmentID, Boro, dia_semana, hora_entera, Vol, {_r('latitude', 'latitude')}, {_r('longitude', 'longitude')}"
_MATCHED = f"{_TRAFFIC_KEYS}, {_r('baseline_vol', 'baseline_vol')}, event_type, eid AS event_id, event_name, {_r('pct', 'pct_change_vs_baseline')}"
_HOURLY = f"""datetime_hour, YLC, FHV, total, {_r('market_share', 'market_share')}, {_r('ratio', 'ratio')},
    temperature_2m, precipitation, rain, snowfall, snow_depth"""
_BY_EVENT = f"event_id, count, {_r('mean_impact', 'mean_impact')}, {_r('median_impact', 'median_impact')}, {_r('max_impact', 'max_impact')}, event_name"
_FLAGS = ", ".join(
    f"CAST(Boro = '{b}' AS TINYINT) AS \"Boro_{b}\"" for b in ("Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island")
)
_PART_OF_DAY = """CASE WHEN HH BETWEEN 6 AND 11 THEN 'Mañana' WHEN HH BETWEEN 12 AND 16 THEN 'Tarde'
    WHEN HH BETWEEN 17 AND 21 THEN 'Noche' ELSE 'Madrugada' END AS momento_dia"""
_DAY = f"""
    SELECT hora_entera, {_r('avg(Vol)', 'Vol')}, {_r('avg(baseline_vol)', 'baseline_vol')}
    FROM tem WHERE CAST(timestamp AS DATE) = DATE '2024-01-05' {{more}} GROUP BY 1"""


def _per_column(template: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(template.replace("{c}", c) for c in columns)


_SELECT: dict[str, str] = {
    "clean_ylc": f"""
        SELECT vendorid, pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, pulocationid, dolocationid, payment_type,
               {', '.join(_r(c, c) for c in _NUMERIC)}, {_r('trip_duration_min', 'trip_duration_min')},
               CAST(hour(pickup) AS INTEGER) AS pickup_hour, CAST(isodow(pickup) - 1 AS INTEGER) AS pickup_weekday,
               round_even(total_amount / trip_distance * 100, 0) / 100 AS revenue_per_mile
        FROM ylc""",
    "clean_fhv": _CLEAN_FHV,
    "normalize_trips": "SELECT * FROM trips",
    "trips_zone_hour_service": "SELECT pulocationid, pickup_hour, tipo_servicio, count(*) AS viajes FROM trips GROUP BY ALL",
    "zone_hour": "SELECT * FROM zh",
    "prepare_hourly": f"""
        SELECT tipo_servicio, pickup_datetime, datetime_hour,
               {', '.join(_r(c, c) for c in ('trip_distance', 'fare_amount', 'total_amount', 'trip_duration_min', 'tolls', 'tips'))}
        FROM hourly_trips""",
    "hourly_mobility": f"""
        SELECT datetime_hour, YLC, FHV, total, {_r('market_share', 'market_share')}, {_r('ratio', 'ratio')} FROM mobility""",
    "segment_zone": "SELECT segmento, LocationID, FHV, YLC, market_share FROM seg_share",
    "segment_max": """
        SELECT segmento, CAST(max(FHV) AS DOUBLE) AS FHV, CAST(max(YLC) AS DOUBLE) AS YLC, CAST(1 AS DOUBLE) AS market_share
        FROM seg GROUP BY 1""",
    "segment_map": "SELECT segmento, CAST(LocationID AS VARCHAR) AS zona, FHV, YLC, market_share FROM seg_share",
    "top5_longest_trips": f"""
        SELECT {_r('trip_distance', 'trip_distance')}, {_r('fare_amount', 'fare_amount')}, {_r('total_amount', 'total_amount')}
        FROM (SELECT * FROM b_ylc WHERE trip_distance IS NOT NULL
              ORDER BY trip_distance DESC, fare_amount DESC NULLS LAST, total_amount DESC NULLS LAST LIMIT 5)""",
    "weather_series": "SELECT stamp AS date, temperature_2m, precipitation, rain, snowfall, snow_depth FROM weather",
    "hourly_weather": f"SELECT {_HOURLY} FROM hourly",
    "hourly_weather_local": f"""
        SELECT datetime_hour, YLC, FHV, total, {_r('market_share', 'market_share')}, {_r('ratio', 'ratio')},
               coalesce(temperature_2m, 0) AS temperature_2m, coalesce(precipitation, 0) AS precipitation, coalesce(rain, 0) AS rain,
               coalesce(snowfall, 0) AS snowfall, coalesce(snow_depth, 0) AS snow_depth
        FROM mobility m LEFT JOIN weather w ON m.datetime_hour = w.stamp - INTERVAL 5 HOUR""",
    "rain_impact": _per_column(
        f"""SELECT '{{c}}' AS variable, {_r('(w.{c} - d.{c}) / d.{c} * 100', 'percent_change')}
            FROM (SELECT * FROM rain_means WHERE wet) w, (SELECT * FROM rain_means WHERE NOT wet) d""",
        ["YLC", "FHV", "total", "market_share"],
    ),
    "traffic_time": """
        SELECT SegmentID, Vol, timestamp, CAST(hour(timestamp) AS INTEGER) AS hora_entera,
               strftime(timestamp, '%A') AS dia_semana, strftime(timestamp, '%B') AS mes_nombre
        FROM timed""",
    "traffic_time_text": """
        SELECT SegmentID, Vol, CASE WHEN event_id % 113 <> 0 AND event_id % 127 <> 0 AND event_id % 131 <> 0 THEN timestamp END AS timestamp
        FROM timed""",
    "wkt_point": "SELECT SegmentID, WktGeom, x, y FROM b_traffic",
    "geo_to_latlon": f"""
        SELECT SegmentID, WktGeom, {_r('longitude', 'longitude')}, {_r('latitude', 'latitude')}
        FROM b_traffic LEFT JOIN places USING (event_id)""",
    "bucket_part_of_day": f"SELECT SegmentID, HH, {_PART_OF_DAY} FROM b_traffic",
    "title_case": f"""
        SELECT user_id % 150 AS SegmentID, '  ' || upper({_boro('user_id % 5')}) || ' ' AS Boro,
               ' main STREET ' || (user_id % 150) || ' ' AS street,
               array_to_string(list_transform(string_split(lower({_boro('user_id % 5')}), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS boro_title,
               'Main Street ' || (user_id % 150) AS street_title
        FROM events""",
    "traffic_outlier_filter": """
        SELECT SegmentID, Yr, M, D, HH, MM, Vol FROM b_traffic
        WHERE Vol >= 0 AND Vol < (SELECT quantile_cont(CAST(Vol AS DOUBLE), 0.9995) FROM b_traffic WHERE Vol >= 0)""",
    "traffic_features": f"""
        SELECT timestamp, mes_nombre, dia_semana, hora_entera, {_PART_OF_DAY}, Vol, {_r('latitude', 'latitude')},
               {_r('longitude', 'longitude')}, Boro, street, 'West End' AS fromSt, 'East End' AS toSt, 'Nb' AS Direction, SegmentID,
               {_r('sin(2 * pi() * HH / 24)', 'hour_sin')}, {_r('cos(2 * pi() * HH / 24)', 'hour_cos')}, {_FLAGS}
        FROM features""",
    "onehot_borough": f"SELECT SegmentID, Boro, {_FLAGS} FROM b_traffic",
    "traffic_segment_hour": f"""
        SELECT SegmentID, hora_entera, street, Boro, {_r('any_value(latitude)', 'latitude')}, {_r('any_value(longitude)', 'longitude')},
               round_even(avg(Vol), 0) AS Vol
        FROM features GROUP BY SegmentID, hora_entera, street, Boro""",
    "traffic_hotspots": f"""
        SELECT {_r('any_value(latitude)', 'latitude')}, {_r('any_value(longitude)', 'longitude')}, {_r('avg(Vol)', 'vol')}
        FROM features WHERE Vol > (SELECT quantile_cont(CAST(Vol AS DOUBLE), 0.5) FROM features) GROUP BY x, y""",
    "traffic_borough_hour": f"SELECT hora_entera, Boro, {_r('avg(Vol)', 'vol')} FROM features GROUP BY ALL",
    "clean_events": "SELECT event_id, event_name, event_type, event_borough, start_time, end_time FROM ev",
    "expand_events_hourly": "SELECT * FROM evh",
    "traffic_baseline": f"SELECT {_TRAFFIC_KEYS}, {_r('baseline_vol', 'baseline_vol')} FROM base",
    "traffic_event_impact": f"SELECT {_MATCHED} FROM te",
    "flatten_mlb_schedule": "SELECT * FROM games_timed",
    "mlb_first_week": "SELECT * FROM week_games",
    "mlb_as_events": "SELECT * FROM mlb_all",
    "traffic_events_mlb": f"SELECT {_MATCHED} FROM tem",
    "distinct_event_types": "SELECT event_type, count(*) AS n FROM tem WHERE event_type IS NOT NULL GROUP BY 1",
    "impact_by_type": f"""
        SELECT event_type, {_r('avg(pct)', 'mean')}, {_r('quantile_cont(pct, 0.5)', 'median')}, {_r('max(pct)', 'max')}, count(pct) AS count
        FROM tem WHERE event_type IS NOT NULL GROUP BY 1""",
    "impact_by_event": f"SELECT {_BY_EVENT} FROM by_event",
    "top_events": f"""
        SELECT {_BY_EVENT} FROM (SELECT * FROM by_event
        ORDER BY max_impact DESC NULLS LAST, event_id, event_name NULLS LAST LIMIT 20)""",
    "extreme_events": f"""
        SELECT {_BY_EVENT} FROM (
          (SELECT * FROM by_event ORDER BY max_impact DESC NULLS LAST, event_id, event_name NULLS LAST LIMIT 50)
          UNION ALL (SELECT * FROM by_event ORDER BY max_impact ASC NULLS LAST, event_id, event_name NULLS LAST LIMIT 10))""",
    "day_vs_baseline": _DAY.format(more=""),
    "day_vs_baseline_boro": _DAY.format(more="AND Boro = 'Queens'"),
    "impact_type_hour_matrix": f"""
        SELECT event_type, {', '.join(_r(f'avg(pct) FILTER (WHERE hora_entera = {h})', f'h{h}') for h in range(24))}
        FROM tem WHERE event_type IS NOT NULL GROUP BY 1""",
    "box_stats_by_type": f"""
        SELECT event_type, {_r('any_value(q1)', 'q1')}, {_r('any_value(median)', 'median')}, {_r('any_value(q3)', 'q3')},
               {_r('least(any_value(q1), min(pct) FILTER (WHERE pct >= q1 - 1.5 * (q3 - q1)))', 'whisker_lo')},
               {_r('greatest(any_value(q3), max(pct) FILTER (WHERE pct <= q3 + 1.5 * (q3 - q1)))', 'whisker_hi')},
               count(*) FILTER (WHERE pct < q1 - 1.5 * (q3 - q1) OR pct > q3 + 1.5 * (q3 - q1)) AS n_outliers
        FROM tem JOIN boxes USING (event_type) WHERE pct IS NOT NULL GROUP BY 1""",
    "kde_event_vs_none": f"""
        SELECT has_event, {_r('any_value(x)', 'x')},
               {_r('sum(n * exp(-pow((x - pct) / bw, 2) / 2)) / any_value(n_all * bw * sqrt(2 * pi()))', 'density')}
        FROM kde_grid JOIN kde_rows USING (has_event) GROUP BY has_event, i""",
    "kde_binned": f"""
        SELECT has_event, {_r('any_value(x)', 'x')},
               {_r('sum(w * exp(-pow((x - lo - edge * (hi - lo) / 1024) / bw, 2) / 2)) / any_value(n_all * bw * sqrt(2 * pi()))', 'density')},
               {_r('any_value(pow((hi - lo) / 1024, 2) / 8 / sqrt(2 * pi()) / pow(bw, 3))', 'error_bound')}
        FROM kde_grid JOIN kde_bins USING (has_event) GROUP BY has_event, i""",
    "event_hours_at_counts": """
        SELECT e.* FROM evh e SEMI JOIN features f ON f.timestamp = e.timestamp AND f.Boro = e.Boro""",
    "traffic_event_spread": f"SELECT {_MATCHED} FROM te",
    "flatten_mlb_documents": """
        SELECT venue, start_time_ny, CASE WHEN s_suppkey % 11 <> 3 THEN start_time_ny + to_minutes(minutes) END AS end_time_ny
        FROM games WHERE s_suppkey % 11 NOT IN (7, 9)""",
    "sql_expand_events": "SELECT * FROM evh",
    "sql_traffic_features": f"""
        SELECT SegmentID, Vol, Boro, street, 'West End' AS fromSt, HH AS hora_entera, {_PART_OF_DAY},
               {_SEGMENT.format(h='HH')} AS segmento,
               {_r('sin(2 * pi() * HH / 24)', 'hour_sin')}, {_r('cos(2 * pi() * HH / 24)', 'hour_cos')}
        FROM b_traffic""",
    "key_types": """
        SELECT 'fhv' AS source, 'pulocationid' AS "column", 'string' AS type, count(*) AS n_rows,
               count(*) FILTER (WHERE pulocationid IS NULL) AS n_null, CAST(0 AS BIGINT) AS n_unreadable, true AS differs FROM b_fhv
        UNION ALL SELECT 'ylc', 'pulocationid', 'int', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), false FROM b_ylc
        UNION ALL SELECT 'lookup', 'LocationID', 'int', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), false FROM lookup""",
    "profile_merged": _per_column(
        f"""SELECT '{{c}}' AS "column", count({{c}}) AS count, count(*) - count({{c}}) AS n_null, {_r('avg({c})', 'mean')},
            {_r('stddev_samp({c})', 'std')}, {_r('min({c})', 'min')}, {_r('max({c})', 'max')} FROM b_ylc""",
        _NUMERIC,
    ),
    "profile_merged_codes": _per_column(
        """SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS n_distinct, CAST(min({c}) AS DOUBLE) AS min,
           CAST(max({c}) AS DOUBLE) AS max FROM b_ylc""",
        ["vendorid", "pulocationid", "dolocationid", "payment_type"],
    ),
    "sink_days": f"SELECT {_HOURLY} FROM hourly",
    "sink_runs": "SELECT pickup AS pickup_datetime, pulocationid FROM services",
    "stream_zone_demand": """
        SELECT date_trunc('hour', pickup) AS datetime_hour, CAST(CAST(pulocationid AS BIGINT) AS VARCHAR) AS pulocationid, count(*) AS FHV
        FROM b_fhv WHERE pickup IS NOT NULL GROUP BY ALL""",
    "demand_by_hour_service": "SELECT hora_entera, tipo_servicio, count(*) AS viajes FROM titled GROUP BY ALL",
    "demand_with_borough": "SELECT * FROM mapped",
    "city_rhythm": f"""
        SELECT hora_entera, {_r('vol_mean', 'vol_mean')}, trips_fhv, trips_ylc
        FROM (SELECT hora_entera, avg(Vol) AS vol_mean FROM features GROUP BY 1)
        FULL JOIN (SELECT hora_entera, count(*) FILTER (WHERE tipo_servicio = 'Uber/FHV') AS trips_fhv,
                          count(*) FILTER (WHERE tipo_servicio = 'Taxi Amarillo') AS trips_ylc FROM titled GROUP BY 1)
        USING (hora_entera)""",
    "borough_share_detailed": f"""
        SELECT Borough, {_r('share', 'Porcentaje')}, 'Tráfico' AS Tipo FROM traffic_share WHERE Borough <> 'Unknown'
        UNION ALL
        SELECT Borough, {_r('100.0::DOUBLE * count(*) / any_value(n_all)', 'Porcentaje')}, tipo_servicio
        FROM mapped JOIN (SELECT tipo_servicio, count(*) AS n_all FROM mapped GROUP BY 1) USING (tipo_servicio)
        WHERE Borough <> 'Unknown' GROUP BY Borough, tipo_servicio""",
    "borough_share_total": f"""
        SELECT Borough, {_r('share', 'Porcentaje')}, 'Tráfico (% del total)' AS Tipo FROM traffic_share WHERE Borough <> 'Unknown'
        UNION ALL
        SELECT Borough, {_r('100.0::DOUBLE * count(*) / (SELECT count(*) FROM mapped WHERE Borough IS NOT NULL)', 'Porcentaje')},
               'Demanda Total (% del total)'
        FROM mapped WHERE Borough <> 'Unknown' GROUP BY Borough""",
    "features_zone_hour": f"""
        SELECT LocationID, zone, pickup_hour, time, FHV, YLC, ratio, {_r('fill_opacity', 'fill_opacity')} FROM slider""",
    "zone_features_full": f"""
        SELECT CASE WHEN LocationID % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS shape,
               CAST(CASE WHEN LocationID % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS parts, LocationID, zone,
               {_boro('n_regionkey')} AS borough, CASE WHEN LocationID % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone,
               pickup_hour, FHV, YLC
        FROM zone_slots JOIN nation ON n_nationkey = LocationID""",
    "profile_schema": """
        SELECT (SELECT count(*) FROM events) AS n_rows, CAST(14 AS INTEGER) AS n_columns, c[1] AS "column", c[2] AS type
        FROM (SELECT unnest([['vendorid', 'int'], ['tpep_pickup_datetime', 'string'], ['tpep_dropoff_datetime', 'timestamp_ntz'],
            ['passenger_count', 'double'], ['trip_distance', 'string'], ['pulocationid', 'int'], ['dolocationid', 'int'],
            ['payment_type', 'int'], ['fare_amount', 'double'], ['extra', 'double'], ['tip_amount', 'double'],
            ['tolls_amount', 'double'], ['congestion_surcharge', 'double'], ['total_amount', 'double']]) AS c)""",
    "profile_numeric": _per_column(
        f"""SELECT '{{c}}' AS "column", count({{c}}) AS count, {_r('avg({c})', 'mean')}, {_r('stddev_samp({c})', 'std')},
            {_r('min({c})', 'min')}, {_r('quantile_cont({c}, 0.25)', 'p25')}, {_r('quantile_cont({c}, 0.5)', 'p50')},
            {_r('quantile_cont({c}, 0.75)', 'p75')}, {_r('max({c})', 'max')} FROM b_ylc""",
        _NUMERIC,
    ),
    "profile_nulls": """
        SELECT 'pulocationid' AS "column", count(*) FILTER (WHERE pulocationid IS NULL) AS n_null FROM b_fhv
        UNION ALL SELECT 'tolls', count(*) FILTER (WHERE tolls IS NULL) FROM b_fhv
        UNION ALL SELECT 'driver_pay', count(*) FILTER (WHERE driver_pay IS NULL) FROM b_fhv
        UNION ALL SELECT unnest(['pickup_datetime', 'dropoff_datetime', 'dolocationid', 'trip_miles', 'base_passenger_fare',
                                 'tips']), CAST(0 AS BIGINT)""",
    "profile_distinct": _per_column(
        """SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM b_ylc""",
        ["vendorid", "pulocationid", "dolocationid", "payment_type"],
    ),
    "value_counts": """
        SELECT CAST(CAST(pulocationid AS BIGINT) AS VARCHAR) AS value, count(*) AS n FROM b_fhv GROUP BY 1""",
    "audit_zone_join": """
        SELECT Borough, count(*) AS n, any_value(u) AS n_unmatched, any_value(t) AS n_total,
               any_value(round(CAST(100 AS DOUBLE) * u / t, 1)) AS pct_unmatched
        FROM mapped, (SELECT count(*) FILTER (WHERE Borough IS NULL) AS u, count(*) AS t FROM mapped) GROUP BY 1""",
    "scan_csv": f"""
        SELECT vendorid, pickup AS tpep_pickup_datetime, dropoff AS tpep_dropoff_datetime, pulocationid, dolocationid, payment_type,
               {', '.join(_r(c, c) for c in _NUMERIC)}
        FROM b_ylc""",
    "scan_parquet": f"SELECT event_id, ts, {_r('value', 'value')} FROM events",
    "scan_json_pages": """
        SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS event_type, CAST(NULL AS VARCHAR) AS event_borough,
               ts AS start_time
        FROM events""",
    "sample_pages": f"""
        SELECT pickup AS tpep_pickup_datetime, vendorid, pulocationid, dolocationid, payment_type, {', '.join(_r(c, c) for c in _NUMERIC)}
        FROM b_ylc WHERE year(pickup) = 2024 AND day(pickup) <= 7""",
    "sample_first_week": f"""
        SELECT event_id, ts, {_r('value', 'value')} FROM events WHERE year(ts) = 2024 AND day(ts) <= 7""",
    "compact_parquet": _CLEAN_FHV,
    "sink_csv": "SELECT pickup AS pickup_datetime, pulocationid FROM services",
    "sink_parquet": f"SELECT {_HOURLY} FROM hourly",
    "features_json": f"""
        SELECT 'Feature' AS type, CAST(4 AS INTEGER) AS corners, LocationID, time, 'black' AS color, CAST(0.3 AS DOUBLE) AS weight,
               '#08306b' AS fillColor, {_r('fill_opacity', 'fillOpacity')}, zone, pickup_hour, FHV, YLC, round(ratio, 2) AS ratio
        FROM slider""",
    "stream_clean_fhv": _CLEAN_FHV,
    "stream_hourly_demand": """
        SELECT date_trunc('hour', pickup) AS datetime_hour, count(*) AS FHV FROM b_fhv
        WHERE pickup IS NOT NULL GROUP BY 1""",
}


def _needed(sql: str, found: dict[str, str]) -> None:
    """Collect the named subqueries ``sql`` mentions, dependencies first."""
    for word in dict.fromkeys(re.findall(r"\b\w+\b", sql)):
        if word in _CTE and word not in found:
            _needed(_CTE[word], found)
            found[word] = _CTE[word]


def statement(key: str) -> str:
    found: dict[str, str] = {}
    _needed(_SELECT[key], found)
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in found.items())
    return f"WITH {ctes}\n{_SELECT[key]}" if found else _SELECT[key]


def statements() -> dict[str, str]:
    return {key: statement(key) for key in _SELECT}
