"""Hand-computed fixtures for the jobs."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from metropulse.operators import events as ev
from metropulse.operators import impact, quality, spatial, traffic, trips, weather
from metropulse.sources import readers, schemas, writers
from metropulse.streaming import trips as streams

YLC_DDL = """vendorid int, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count double,
    trip_distance string, pulocationid int, fare_amount double, total_amount double"""


def at(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_clean_ylc(spark):
    start, end = "2023-01-02T08:00:00.000", "2023-01-02T08:10:30.000"
    raw = spark.createDataFrame(
        [
            (1, start, end, 1.0, "2.0", 7, 10.0, 15.0),
            (2, "x", end, 1.0, "2", 7, 10.0, 15.0),
            (3, start, end, 1.0, "0", 7, 10.0, 15.0),
            (4, start, end, 1.0, "2", 7, 10.0, 0.0),
            (5, start, end, 0.0, "2", 7, 10.0, 15.0),
            (6, start, end, None, "2", 7, 10.0, 15.0),
            (7, start, end, 1.0, "2", 7, 10.0, float("nan")),
            (8, start, start, 1.0, "2", 7, 10.0, 15.0),
            (9, end, start, 1.0, "2", 7, 10.0, 15.0),
            (10, start, "2023-01-02T08:00:00.200", 1.0, "2", 7, 10.0, 15.0),
        ],
        YLC_DDL,
    )
    kept = trips.clean_ylc(raw).collect()
    assert [r.vendorid for r in kept] == [1]
    assert (kept[0].trip_duration_min, kept[0].pickup_hour, kept[0].pickup_weekday, kept[0].revenue_per_mile) == (
        10.5,
        8,
        0,
        7.5,
    )


def test_clean_fhv(spark):
    start, end = "2023-01-01T00:00:00.000", "2023-01-01T00:00:00.500"
    raw = spark.createDataFrame(
        [
            (start, end, "7", "8", "0", "0", "0", "0", "0"),
            (start, end, "7", "8", "1", "abc", "0", "0", "1"),
            (start, end, "7", "8", "1", None, "0", "0", "1"),
            (start, end, None, "8", "1", "1", "abc", "0", "1"),
            (start, end, "7", "8", "1", "1", "0", "0", "-0.01"),
            (start, "never", "7", "8", "1", "1", "0", "0", "1"),
        ],
        schemas.RAW_FHV,
    )
    kept = trips.clean_fhv(raw).orderBy("trip_miles").collect()
    assert [(r.trip_miles, r.pulocationid, r.tolls) for r in kept] == [(0.0, 7.0, 0.0), (1.0, None, None)]
    assert kept[0].trip_duration_min == pytest.approx(0.5 / 60)


@pytest.fixture(scope="module")
def demand(spark):
    fhv = spark.createDataFrame(
        [("2023-01-01 08:05", 7), ("2023-01-01 08:40", 7), ("2023-01-01 09:00", 7), ("2023-01-01 09:00", None)],
        "pickup_datetime string, pulocationid int",
    )
    ylc = spark.createDataFrame(
        [("2023-01-01 08:59", 7), ("2023-01-01 08:00", 9)], "tpep_pickup_datetime string, pulocationid int"
    )
    return trips.zone_hour(trips.normalize_trips(fhv, ylc))


def test_zone_hour(demand):
    assert rows(demand, "pickup_hour", "LocationID") == [
        (7, 8, 2, 1, 3, 0.666667, 1.0),
        (9, 8, 0, 1, 1, 0.0, 0.0),
        (7, 9, 1, 0, 1, 1.0, 1.0),
    ]


def test_segments(demand):
    segments = trips.segment_zone(demand)
    assert rows(segments.where("LocationID = 7")) == [("Hora pico mañana", 7, 3, 1, 0.75)]
    assert rows(trips.segment_max(segments)) == [("Hora pico mañana", 3.0, 1.0, 1.0)]
    entry = trips.segment_map(segments).first()
    assert entry.zonas["7"].asDict() == {"FHV": 3, "YLC": 1, "market_share": 0.75}


def test_slider_features(spark, demand):
    zones = spark.createDataFrame([(7, "A"), (8, "B")], "locationid int, zone string")
    shown = spatial.features_zone_hour(demand, zones, "FHV")
    assert shown.count() == 48
    at_eight = {r.LocationID: r for r in shown.where("pickup_hour = 8").collect()}
    assert at_eight[7].fill_opacity == pytest.approx(2 / 3)
    assert (at_eight[8].FHV, at_eight[8].ratio, at_eight[8].time) == (0, 0.0, "2023-01-01T08:00:00")
    document = spatial.feature_json(shown).first().value
    assert '"type":"Feature"' in document and '"fillColor":"#08306b"' in document
    with pytest.raises(ValueError):
        spatial.features_zone_hour(demand, zones.select("zone"))
    with pytest.raises(ValueError):
        spatial.features_zone_hour(demand, zones, "total")


@pytest.fixture(scope="module")
def hours(spark):
    """Three hours: wet, dry, and one without weather; the last two equal in every value."""
    trip = spark.createDataFrame(
        [(h, s) for h, n in (("08", 2), ("09", 1), ("10", 1)) for s in ["YLC"] * n], "h string, tipo_servicio string"
    )
    trip = trip.select(F.concat(F.lit("2023-01-01 "), "h", F.lit(":00")).cast("timestamp_ntz").alias("datetime_hour"), "tipo_servicio")
    sky = spark.createDataFrame(
        [("2023-01-01 08:00:00+00:00", 3.0, 1.0, 1.0, 0.0, 0.0), ("2023-01-01 09:00:00+00:00", 0.0, 0.0, 0.0, 0.0, 0.0)],
        "date string, temperature_2m double, precipitation double, rain double, snowfall double, snow_depth double",
    )
    return trips.hourly_mobility(trip), sky


def test_hourly_weather(hours):
    mobility, sky = hours
    every = weather.hourly_weather(mobility, sky, dedup_values=False)
    assert [(r.YLC, r.FHV, r.precipitation) for r in every.orderBy("datetime_hour").collect()] == [
        (2, 0, 1.0),
        (1, 0, 0.0),
        (1, 0, 0.0),
    ]
    collapsed = weather.hourly_weather(mobility, sky)
    assert [r.datetime_hour.hour for r in collapsed.orderBy("datetime_hour").collect()] == [8, 9]
    shifted = weather.hourly_weather(mobility, sky, "America/New_York", dedup_values=False)
    assert {r.temperature_2m for r in shifted.collect()} == {0.0}


def test_single_pass_counts_equal_the_outer_join(spark):
    stamps = [("FHV", 8), ("FHV", 8), ("YLC", 8), ("YLC", 9), ("FHV", 10)]
    trip = spark.createDataFrame(stamps, "tipo_servicio string, h int")
    trip = trip.select("tipo_servicio", F.try_make_timestamp_ntz(F.lit(2023), F.lit(1), F.lit(1), "h", F.lit(0), F.lit(0)).alias("datetime_hour"))
    taxi = trip.where("tipo_servicio = 'YLC'").groupBy("datetime_hour").agg(F.count("*").alias("YLC"))
    hire = trip.where("tipo_servicio = 'FHV'").groupBy("datetime_hour").agg(F.count("*").alias("FHV"))
    joined = taxi.join(hire, "datetime_hour", "full").fillna(0)
    assert rows(trips.hourly_mobility(trip).select("datetime_hour", "YLC", "FHV"), "datetime_hour") == rows(joined, "datetime_hour")


def test_rain_impact(spark):
    hourly = spark.createDataFrame(
        [(8, 1, 9, 0.1, 1.0), (12, 1, 13, 0.1, 2.0), (20, 1, 21, 0.1, 0.0), (20, 1, 21, 0.1, 0.0)],
        "YLC int, FHV int, total int, market_share double, precipitation double",
    )
    found = dict(rows(weather.rain_impact(hourly)))
    assert found["YLC"] == -50.0 and len(found) == 4
    dry = dict(rows(weather.rain_impact(hourly.where("precipitation = 0"))))
    assert dry["YLC"] is None


def test_weather_series(spark):
    response = spark.createDataFrame(
        [(0, 7200, 3600, *[[float(v), v + 1.0] for v in range(5)])], schemas.WEATHER_RESPONSE
    )
    assert rows(weather.weather_series(response).select("date", "temperature_2m", "snow_depth"), "date") == [
        (at("1970-01-01"), 0.0, 4.0),
        (at("1970-01-01T01:00"), 1.0, 5.0),
    ]


RAW_TRAFFIC = "Yr int, M int, D int, HH int, MM int, Vol bigint, SegmentID bigint, WktGeom string, Boro string, street string"


def test_traffic_features(spark):
    point = "POINT (982586.6718892078 199515.3160098472)"
    raw = spark.createDataFrame(
        [
            (2023, 1, 2, 12, 15, 10, 1, point, " BRONX ", " o'brien 42ND-st "),
            (2023, 1, 2, 13, 15, 99, 1, point, "bronx", "x"),
            (2022, 1, 2, 12, 15, 10, 1, point, "bronx", "x"),
            (2023, 13, 2, 12, 15, 10, 1, point, "bronx", "x"),
            (2023, 1, 2, 12, 15, -1, 1, point, "bronx", "x"),
            (2023, 1, 2, 12, 15, None, 1, point, "bronx", "x"),
            (2023, 1, 2, 12, 15, 10, 1, "POINT(1 2)", "bronx", "x"),
            (2023, 1, 2, 12, 15, 10, 1, None, "bronx", "x"),
        ],
        RAW_TRAFFIC,
    )
    made = traffic.traffic_features(raw)
    assert made.columns == [
        "timestamp",
        "mes_nombre",
        "dia_semana",
        "hora_entera",
        "momento_dia",
        "Vol",
        "latitude",
        "longitude",
        "Boro",
        "street",
        "SegmentID",
        "hour_sin",
        "hour_cos",
        "Boro_Bronx",
    ]
    (row,) = made.collect()
    assert (row.timestamp, row.mes_nombre, row.dia_semana, row.momento_dia) == (
        at("2023-01-02T12:15"),
        "January",
        "Monday",
        "Tarde",
    )
    assert (row.Boro, row.street, row.Boro_Bronx) == ("Bronx", "O'Brien 42Nd-St", 1)
    assert row.hour_sin == pytest.approx(0, abs=1e-12) and row.hour_cos == pytest.approx(-1)


def test_traffic_profiles(spark):
    made = spark.createDataFrame(
        [(1, 8, "A", "Bronx", 40.7, -74.0, 1), (1, 8, "A", "Bronx", 40.7, -74.0, 2), (2, 8, "B", None, 40.8, -74.0, 9)],
        "SegmentID int, hora_entera int, street string, Boro string, latitude double, longitude double, Vol int",
    )
    assert rows(traffic.traffic_segment_hour(made)) == [(1, 8, "A", "Bronx", 40.7, -74.0, 2.0)]
    hot = traffic.traffic_hotspots(made)
    assert rows(hot) == [(40.8, -74.0, 9.0)]
    assert rows(traffic.heat_points(hot)) == [([40.8, -74.0, 9.0],)]
    assert rows(traffic.traffic_borough_hour(made)) == [(8, "Bronx", 1.5)]


EVENT_DDL = "event_id bigint, event_name string, event_type string, event_borough string, start_time timestamp_ntz, end_time timestamp_ntz"


def events(spark, *spans):
    made = [(i, f"E{i}", "Parade", "Bronx", a and at(a), b and at(b)) for i, (a, b) in enumerate(spans, 1)]
    return spark.createDataFrame(made, EVENT_DDL)


def test_event_hours(spark):
    made = events(
        spark,
        ("2023-01-02T10:30", "2023-01-02T12:29"),
        ("2023-01-02T10:00", "2023-01-02T12:00"),
        ("2023-01-02T10:00", "2023-01-02T09:00"),
        ("2023-01-02T10:00", None),
    )
    hourly = ev.expand_events_hourly(made)
    assert [(r.event_id, r.timestamp.isoformat()[11:16]) for r in hourly.orderBy("event_id", "timestamp").collect()] == [
        (1, "10:30"),
        (1, "11:30"),
        (2, "10:00"),
        (2, "11:00"),
        (2, "12:00"),
    ]


def traffic_rows(spark, cells):
    made = spark.createDataFrame([(at(t), b, v) for t, b, v in cells], "timestamp timestamp_ntz, Boro string, Vol bigint")
    return made.withColumns(traffic.time_labels(F.col("timestamp")))


def test_baseline_and_matches(spark):
    made = traffic_rows(
        spark,
        [("2023-01-02T10:00", "Bronx", 10), ("2023-01-02T10:15", "Bronx", 20), ("2023-01-09T10:00", "Bronx", 30)],
    )
    based = ev.traffic_baseline(made)
    assert {r.baseline_vol for r in based.collect()} == {20.0}
    two = events(spark, ("2023-01-02T10:00", "2023-01-02T10:00"), ("2023-01-02T10:00", "2023-01-02T10:30"))
    met = ev.traffic_event_impact(based, ev.expand_events_hourly(two))
    assert [(r.timestamp.minute, r.event_id, r.pct_change_vs_baseline) for r in met.orderBy("timestamp", "event_id").collect()] == [
        (0, 1, -50.0),
        (0, 2, -50.0),
        (15, None, 0.0),
        (0, None, 50.0),
    ]


def test_games(spark, tmp_path):
    document = """{"dates": [{"games": [
        {"gameDate": "2023-04-01T17:05:00Z", "venue": {"name": "Yankee Stadium"}, "gameInfo": {"gameDurationMinutes": 150}},
        {"gameDate": "2023-04-01T17:05:00Z", "venue": {"name": "Fenway Park"}, "gameInfo": {"gameDurationMinutes": 150}},
        {"gameDate": "2023-04-08T17:10:00Z", "venue": {"name": "Citi Field"}, "gameInfo": {"gameDurationMinutes": 0}},
        {"gameDate": "2023-04-02T23:10:00Z", "venue": {"name": "Citi Field"}}]}]}"""
    (tmp_path / "schedule.json").write_text(document)
    games = ev.flatten_mlb_schedule(readers.read_schedule(spark, str(tmp_path)))
    assert rows(games, "start_time_ny") == [
        ("Yankee Stadium", at("2023-04-01T13:05"), at("2023-04-01T15:35")),
        ("Citi Field", at("2023-04-02T19:10"), None),
        ("Citi Field", at("2023-04-08T13:10"), None),
    ]
    week = ev.mlb_first_week(games)
    assert week.count() == 2
    as_events = ev.mlb_as_events(week, 100)
    assert [(r.event_id, r.event_name, r.event_borough) for r in as_events.orderBy("event_id").collect()] == [
        (101, "Yankee Stadium MLB Game", "Bronx"),
        (102, "Citi Field MLB Game", "Queens"),
    ]
    assert ev.expand_events_hourly(as_events).count() == 3


def test_games_fill_missing_fields_one_by_one(spark):
    made = traffic_rows(spark, [(f"2023-04-01T13:{m:02d}", "Bronx", 10) for m in (0, 15, 30, 45)])
    permitted = spark.createDataFrame(
        [(1, None, None, "Bronx", at("2023-04-01T13:15"), at("2023-04-01T13:15")), (2, "Walk", "Parade", "Bronx", at("2023-04-01T13:30"), at("2023-04-01T13:30"))],
        EVENT_DDL,
    )
    game = spark.createDataFrame([(9, "Yankee Stadium MLB Game", "MLB", "Bronx", at("2023-04-01T13:05"), at("2023-04-01T13:30"))], EVENT_DDL)
    met = ev.traffic_event_impact(ev.traffic_baseline(made), ev.expand_events_hourly(permitted))
    full = ev.traffic_events_mlb(met, ev.expand_events_hourly(game))
    assert {r.timestamp for r in full.collect()} == {at("2023-04-01T13:00")}
    assert sorted((r.event_id, r.event_type, r.event_name) for r in full.collect()) == [
        (1, "MLB", "Yankee Stadium MLB Game"),
        (2, "Parade", "Walk"),
        (9, "MLB", "Yankee Stadium MLB Game"),
        (9, "MLB", "Yankee Stadium MLB Game"),
    ]


IMPACT_DDL = "event_id bigint, event_name string, event_type string, hora_entera int, pct_change_vs_baseline double"


def test_event_reports(spark):
    made = spark.createDataFrame(
        [(1, "A", "Parade", 10, -50.0), (1, "A", "Parade", 10, 50.0), (1, "A", "Parade", 11, None), (2, None, None, 10, 5.0), (None, None, None, 10, 7.0)],
        IMPACT_DDL,
    )
    assert rows(impact.impact_by_type(made)) == [("Parade", 0.0, 0.0, 50.0, 2)]
    summary = impact.impact_by_event(made)
    assert rows(summary.select("event_id", "count", "mean_impact", "median_impact", "max_impact", "event_name"), "event_id") == [
        (1, 3, 0.0, 0.0, 50.0, "A"),
        (2, 1, 5.0, 5.0, 5.0, None),
    ]
    assert [r.event_id for r in impact.top_events(summary, 1).collect()] == [1]
    assert [r.event_id for r in impact.extreme_events(summary, 2, 2).collect()] == [2, 2, 1, 1]
    (wide,) = impact.impact_type_hour_matrix(made).collect()
    assert (wide.h10, wide.h11, wide.h23) == (0.0, None, None)


def test_box_statistics(spark):
    made = spark.createDataFrame([(1, "A", "Parade", 1, float(v)) for v in [1, 2, 3, 4, 100]], IMPACT_DDL)
    assert rows(impact.box_stats_by_type(made)) == [("Parade", 2.0, 3.0, 4.0, 1.0, 4.0, 1)]


@pytest.mark.parametrize("outliers", [[], [-9e5, 1e6]])
def test_density(spark, outliers):
    """Against the textbook sum; with far outliers many grid points are out of reach of every kernel."""
    sample = [float(v) for v in [0, 1, 1, 3, 7, 8, 8, 8] * 100] + outliers
    made = spark.createDataFrame([(None, None, None, 1, v) for v in sample], IMPACT_DDL)
    curve = impact.kde_event_vs_none(made).orderBy("x").collect()
    assert len(curve) == 200
    x, y = (np.array([r[c] for r in curve]) for c in ("x", "density"))
    if not outliers:
        assert np.trapezoid(y, x) == pytest.approx(1, abs=5e-3)
    bw = np.std(sample, ddof=1) * len(sample) ** -0.2
    want = [np.mean(np.exp(-(((p - np.array(sample)) / bw) ** 2) / 2)) / bw / np.sqrt(2 * np.pi) for p in x]
    assert np.allclose(y, want)
    assert x[0] == pytest.approx(min(sample) - 3 * bw) and x[-1] == pytest.approx(max(sample) + 3 * bw)


def test_day_against_baseline(spark):
    made = traffic_rows(spark, [("2023-07-04T10:00", "Bronx", 10), ("2023-07-04T10:15", "Queens", 30), ("2023-07-05T10:00", "Bronx", 99)])
    based = ev.traffic_baseline(made)
    assert rows(impact.day_vs_baseline(based, "2023-07-04")) == [(10, 20.0, 20.0)]
    assert rows(impact.day_vs_baseline(based, dt.date(2023, 7, 4), "Queens")) == [(10, 30.0, 30.0)]


def test_shares_use_two_denominators(spark):
    lookup = spark.createDataFrame([(1, "Manhattan"), (264, "Unknown"), (265, None)], "LocationID int, Borough string")
    trip = spark.createDataFrame([(1,), (1,), (264,), (265,)], "pulocationid int").withColumns(
        {"tipo_servicio": F.lit("Taxi Amarillo"), "hora_entera": F.lit(8)}
    )
    counts = spark.createDataFrame([("Manhattan", 8, 30), ("Queens", 8, 10)], "Boro string, hora_entera int, Vol int")
    detailed = {(r.Borough, r.Tipo): r.Porcentaje for r in spatial.borough_share_detailed(counts, trip, lookup).collect()}
    assert detailed == {("Manhattan", "Tráfico"): 75.0, ("Queens", "Tráfico"): 25.0, ("Manhattan", "Taxi Amarillo"): 50.0}
    total = {(r.Borough, r.Tipo): round(r.Porcentaje, 2) for r in spatial.borough_share_total(counts, trip, lookup).collect()}
    assert total[("Manhattan", "Demanda Total (% del total)")] == 66.67
    assert rows(spatial.city_rhythm(counts, trip)) == [(8, 20.0, 0, 4)]
    audit = quality.audit_zone_join(trip.limit(0), trip, lookup).collect()
    assert {(r.n_unmatched, r.n_total, r.pct_unmatched) for r in audit} == {(1, 4, 25.0)}
    assert quality.audit_zone_join(trip, trip, lookup).first().n_total == 8


def test_profiles(spark):
    made = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (4.0, None), (None, "c")], "x double, t string")
    (row,) = quality.profile_numeric(made, ["x"]).collect()
    assert (row["count"], row["min"], row.p25, row.p50, row.p75, row["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    assert rows(quality.profile_schema(made), "column") == [(4, 2, "t", "string"), (4, 2, "x", "double")]


def test_longest_trips(spark):
    raw = spark.createDataFrame([(str(d), 1.0, 2.0) for d in range(8)] + [("far", 1.0, 2.0)], "trip_distance string, fare_amount double, total_amount double")
    assert [r.trip_distance for r in trips.top5_longest_trips(raw).collect()] == [7.0, 6.0, 5.0, 4.0, 3.0]


def test_appended_csv_reads_as_one_table(spark, tmp_path):
    path = str(tmp_path / "out")
    one = spark.createDataFrame([("a", at("2023-01-01T00:00:00.123456"))], "t string, ts timestamp_ntz")
    writers.write_csv(one, path)
    writers.write_csv(one, path, "append")
    assert rows(readers.read_csv(spark, path, "t string, ts timestamp_ntz")) == rows(one) * 2


def test_compaction(spark, tmp_path):
    source, target = str(tmp_path / "parts"), str(tmp_path / "one")
    spark.range(100).repartition(10).write.parquet(source)
    assert writers.compact_parquet(spark, source, target, files=1).count() == 100
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1


def test_streaming_resumes_and_equals_batch(spark, tmp_path):
    landing, target, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))
    line = ("2023-01-01T00:00:00", "2023-01-01T00:10:00", "7", "8", "1", "1", "0", "0")
    first = spark.createDataFrame([(*line, "1"), (*line, "-1")], schemas.RAW_FHV)
    second = spark.createDataFrame([(*line, "2")], schemas.RAW_FHV)
    for landed in (first, second):
        writers.write_csv(landed, landing, "append")
        stream = streams.stream_fhv(spark, landing, schemas.RAW_FHV, "csv", files_per_batch=1)
        streams.stream_clean_fhv(stream, target, progress)
    batch = trips.clean_fhv(first.unionByName(second))
    assert rows(spark.read.parquet(target), "driver_pay") == rows(batch, "driver_pay")
