"""Null, NaN, rounding, calendar and text rules on inline rows."""

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metropulse.functions import geo, labels, times, values
from metropulse.operators import events as ev
from metropulse.operators import quality, traffic, trips
from metropulse.sources import readers, schemas


def column(spark, cells, kind, expr):
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr).collect()]


def test_null_keys_leave_groups(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert [r.k for r in values.group_known(df, ["k"]).count().collect()] == ["a"]


def test_number_is_lenient_and_has_no_nan(spark):
    got = column(spark, ["1.5", "abc", "NaN", "", None, "-0.01"], "string", values.number("v"))
    assert got == [1.5, None, None, None, None, -0.01]
    assert column(spark, [float("nan"), 2.0], "double", values.number("v")) == [None, 2.0]


def test_moment_is_lenient_and_drops_the_zone(spark):
    got = column(
        spark,
        ["2023-01-02T08:00:00.000", "x", "2023-04-01 13:05:00-04:00", "01/02/2023 08:30:00 PM"],
        "string",
        values.moment("v", ev.EXPORT_TIME),
    )
    assert got == [dt.datetime(2023, 1, 2, 8), None, dt.datetime(2023, 4, 1, 13, 5), dt.datetime(2023, 1, 2, 20, 30)]


def test_zero_base_gives_no_change(spark):
    change = values.percent_over(F.col("v"), F.lit(0.0))
    assert column(spark, [1.0, 0.0], "double", change) == [None, None]


def test_rounding_is_half_to_even(spark):
    assert column(spark, [0.5, 1.5, 2.5, -0.5], "double", values.round_even(F.col("v"), 0)) == [0.0, 2.0, 2.0, -0.0]
    assert column(spark, [1.005, 0.125], "double", values.round_even(F.col("v"), 2)) == [1.0, 0.12]


def test_hour_floor_and_minutes_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 01:59:30.25' a, timestamp_ntz'2024-03-10 03:00:00.25' b")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = df.select(times.floor_hour(F.col("b")), times.minutes_between(F.col("a"), F.col("b"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (dt.datetime(2024, 3, 10, 3), 60.5)


def test_monday_is_zero_and_names_are_long(spark):
    ts = F.col("v").cast("timestamp_ntz")
    assert column(spark, ["2023-01-02 00:00:00"], "string", F.weekday(ts)) == [0]
    names = traffic.time_labels(ts)
    assert column(spark, ["2023-01-02 00:00:00"], "string", names["dia_semana"]) == ["Monday"]
    assert column(spark, ["2023-01-02 00:00:00"], "string", names["mes_nombre"]) == ["January"]


@pytest.mark.parametrize(
    "text",
    [" o'brien 42ND-st ", "\tMIDDLE  east\n", "'tis", "a1b2", "", "mcdonald's AVE/5TH st.", "ÉCOLE ñandú", "(bronx) 3RD"],
)
def test_title_case_is_pythons(spark, text):
    assert column(spark, [text], "string", labels.title_case(F.col("v"))) == [text.strip().title()]


def test_title_case_keeps_null(spark):
    assert column(spark, [None], "string", labels.title_case(F.col("v"))) == [None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abzAZ '-/.19é", max_size=12), min_size=1, max_size=30))
def test_title_case_property(spark, texts):
    assert column(spark, texts, "string", labels.title_case(F.col("v"))) == [
        t.strip(" \t\n\r\f\v").title() for t in texts
    ]


def test_hour_buckets(spark):
    hours = [5, 6, 11, 12, 16, 17, 21, 22]
    assert column(spark, hours, "int", labels.part_of_day(F.col("v"))) == (
        ["Madrugada", "Mañana", "Mañana", "Tarde", "Tarde", "Noche", "Noche", "Madrugada"]
    )
    assert column(spark, [4, 5, 8, 11, 16, 21], "int", labels.map_segment(F.col("v"))) == [
        "Noche / Madrugada",
        "Primera mañana",
        "Hora pico mañana",
        "Mediodía",
        "Regreso a casa",
        "Noche / Madrugada",
    ]


def test_projection_of_a_known_point(spark):
    df = spark.createDataFrame(
        [("POINT (982586.6718892078 199515.3160098472)",), ("POINT(1 2)",), ("bad",), (None,)], "WktGeom string"
    )
    rows = traffic.geo_to_latlon(df).collect()
    assert rows[0].longitude == pytest.approx(-74.006, abs=1e-6)
    assert rows[0].latitude == pytest.approx(40.7143, abs=1e-6)
    assert [r.latitude for r in rows[1:]] == [None, None, None]


def test_projection_round_trip(spark):
    places = [(-74.25 + 0.05 * i, 40.5 + 0.04 * j) for i in range(12) for j in range(12)]
    rows = [(lon, lat, *geo.feet_xy(lon, lat)) for lon, lat in places]
    df = spark.createDataFrame(rows, "lon double, lat double, x double, y double")
    longitude, latitude = geo.lon_lat(F.col("x"), F.col("y"))
    worst = df.select(F.max(F.greatest(F.abs(longitude - F.col("lon")), F.abs(latitude - F.col("lat"))))).first()[0]
    assert worst < 1e-9


def test_excluded_types_keep_unknown_type(spark):
    raw = spark.createDataFrame(
        [("1", t) for t in ("Sport - Youth", "Sport - Adult", "Special Event", None, "Parade")],
        "`Event ID` string, `Event Type` string",
    ).withColumns({h: F.lit(None).cast("string") for h in ("Event Name", "Event Borough", "Start Date/Time", "End Date/Time", "Event Agency")})
    cleaned = ev.clean_events(raw)
    assert {r.event_type for r in cleaned.collect()} == {None, "Parade"}
    assert "Event Agency" not in cleaned.columns


def test_month_thirteen_and_other_years(spark):
    raw = spark.createDataFrame(
        [(2022, 1, 1, 0, 0), (2023, 13, 1, 0, 0), (2024, 2, 29, 23, 45)], "Yr int, M int, D int, HH int, MM int"
    )
    assert [r.timestamp for r in traffic.traffic_time(raw).orderBy("Yr").collect()] == [
        None,
        dt.datetime(2024, 2, 29, 23, 45),
    ]


def test_quantile_interpolates_and_the_limit_is_strict(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, -5, None]], "Vol bigint")
    assert sorted(r.Vol for r in traffic.traffic_outlier_filter(df, 0.9995).collect()) == [1, 2, 3]
    same = spark.createDataFrame([(7,)] * 4, "Vol bigint")
    assert traffic.traffic_outlier_filter(same).count() == 0


def test_one_hot_columns_come_from_the_data(spark):
    df = spark.createDataFrame([("Bronx",), ("Queens",), (None,)], "Boro string")
    hot = traffic.onehot_borough(df)
    assert hot.columns == ["Boro", "Boro_Bronx", "Boro_Queens"]
    assert {tuple(r) for r in hot.collect()} == {("Bronx", 1, 0), ("Queens", 0, 1), (None, 0, 0)}
    assert dict(hot.dtypes)["Boro_Bronx"] == "tinyint"


def test_missing_columns_are_an_error(spark):
    good = spark.createDataFrame([("2023-01-01", "1")], "pickup_datetime string, pulocationid string")
    with pytest.raises(ValueError, match="FHV"):
        trips.normalize_trips(good.drop("pulocationid"), good)
    with pytest.raises(ValueError, match="YLC"):
        trips.normalize_trips(good, good.drop("pickup_datetime"))


def test_lookup_text_for_missing(spark, tmp_path):
    file = tmp_path / "lookup.csv"
    file.write_text('LocationID,Borough,Zone,service_zone\n1,Manhattan,A,Yellow\n264,Unknown,N/A,N/A\n265,N/A,B,N/A\n')
    rows = {r.LocationID: r.Borough for r in readers.read_zone_lookup(spark, str(file)).collect()}
    assert rows == {1: "Manhattan", 264: "Unknown", 265: None}


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None), (None, "b")], "x double, t string")
    assert {r["column"]: r.n_null for r in quality.profile_nulls(df).collect()} == {"x": 2, "t": 1}
    assert {r["column"]: r.n_distinct for r in quality.profile_distinct(df, ["t"]).collect()} == {"t": 2}


def test_value_counts_null_handling(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "t string")
    assert [tuple(r) for r in quality.value_counts(df, "t").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.value_counts(df, "t", keep_null=True).collect()] == [("a", 2), (None, 1)]


def test_rows_are_counted_on_the_way(spark):
    df, seen = quality.counted(spark.range(5).where("id > 1"), "kept")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 3


def test_json_pages_fill_absent_keys(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"event_id": "1", "event_type": "Parade"}, {"event_id": "2"}]')
    (tmp_path / "2.json").write_text('[{"event_id": "3", "event_name": "x"}]')
    rows = readers.read_json_pages(spark, str(tmp_path), schemas.RAW_EVENT_PAGES).collect()
    assert {(r.event_id, r.event_type, r.event_name) for r in rows} == {
        ("1", "Parade", None),
        ("2", None, None),
        ("3", None, "x"),
    }


def test_first_week_sample(spark):
    days = ["2023-01-01", "2023-01-07 23:59:59", "2023-01-08", "2023-12-07", "2024-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(values.moment("d").alias("ts"))
    kept = readers.sample_first_week(df, "ts").collect()
    assert sorted(r.ts.isoformat() for r in kept) == ["2023-01-01T00:00:00", "2023-01-07T23:59:59", "2023-12-07T00:00:00"]
    assert readers.first_days(df, "ts").count() == 4


def test_density_constants():
    assert math.isclose(geo.CONE, 0.65408, abs_tol=1e-4)
