"""The file-to-file jobs, chained from landed files to reports."""

import pytest
from pyspark.sql import functions as F

from metropulse.operators import events as ev
from metropulse.plans import jobs
from metropulse.plans.bridge import Feeds
from metropulse.plans.views import publish
from metropulse.sources import readers, schemas
from metropulse.sources.writers import write_csv
from metropulse.streaming import trips as streams
from test_oracle import SF_DIR


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landed"))
    feeds = Feeds(spark, SF_DIR)
    for name, df in {"fhv": feeds.fhv_raw, "ylc": feeds.ylc_raw, "games": feeds.games, "sky": feeds.weather_raw.withColumn("date", F.concat(F.col("date").cast("string"), F.lit("+00:00")))}.items():
        write_csv(df, f"{root}/{name}")
    write_csv(feeds.traffic_raw.select(F.lit(1).alias("RequestID"), "*"), f"{root}/traffic")
    names = [f.strip().split("`")[1] for f in schemas.RAW_EVENTS.split(",")]
    padded = feeds.events_raw.withColumns({n: F.lit(None).cast("string") for n in names if n not in feeds.events_raw.columns})
    write_csv(padded.select(*[F.col(f"`{n}`") for n in names]), f"{root}/events")
    write_csv(feeds.lookup.select("LocationID", "Borough", "Zone", "service_zone"), f"{root}/lookup")
    feeds.zones.write.parquet(f"{root}/zones")
    feeds.schedule.select(F.to_json(F.struct("dates")).alias("value")).limit(1).write.text(f"{root}/schedule")
    return root, feeds


def same(left, right):
    columns = sorted(left.columns)
    return sorted(map(str, left.select(columns).collect())) == sorted(map(str, right.select(columns).collect()))


def test_steps_in_order(spark, landed):
    root, feeds = landed

    def step(name, **arguments):
        jobs.run(spark, name, [f"{k}={v}" for k, v in arguments.items()])

    clean = {s: f"{root}/clean-{s}" for s in ("fhv", "ylc")}
    step("clean_fhv", raw=f"{root}/fhv", out=clean["fhv"])
    step("clean_ylc", raw=f"{root}/ylc", out=clean["ylc"])
    assert same(spark.read.parquet(clean["fhv"]).drop("pickup_date"), feeds.fhv)

    step("zone_hour", **clean, out=f"{root}/zone-hour")
    assert same(spark.read.parquet(f"{root}/zone-hour"), feeds.zone_hour)

    step("hourly_aggregate", **clean, sky=f"{root}/sky", out=f"{root}/hourly")
    assert same(spark.read.parquet(f"{root}/hourly"), feeds.hourly)
    step("rain_impact", hourly=f"{root}/hourly", out=f"{root}/rain")
    assert spark.read.option("header", True).csv(f"{root}/rain").count() == 4

    step("traffic_features", raw=f"{root}/traffic", out=f"{root}/features")
    assert same(spark.read.parquet(f"{root}/features"), feeds.features)
    step("traffic_reports", features=f"{root}/features", out=f"{root}/traffic-reports")

    step("mlb_games", schedule=f"{root}/schedule", out=f"{root}/first-game")
    step("traffic_events", features=f"{root}/features", events=f"{root}/events", games=f"{root}/games", out=f"{root}/matched")
    assert spark.read.parquet(f"{root}/matched").count() == feeds.traffic_events_mlb.count()
    step("event_reports", traffic_events=f"{root}/matched", out=f"{root}/reports", days="2024-01-05")
    assert spark.read.option("header", True).csv(f"{root}/reports/day_2024-01-05").count() > 0

    step("borough_reports", features=f"{root}/features", **clean, lookup=f"{root}/lookup", out=f"{root}/boroughs")
    step("map_data", zone_hours=f"{root}/zone-hour", zones=f"{root}/zones", out=f"{root}/maps")
    assert spark.read.text(f"{root}/maps/slider").count() == 25 * 24
    assert spark.read.text(f"{root}/maps/segments").count() == 5


def test_landing_steps(spark, tmp_path):
    pages, out = tmp_path / "pages", str(tmp_path / "out")
    pages.mkdir()
    (pages / "1.json").write_text(
        '[{"pickup_datetime": "2023-02-07T23:59:00.000", "trip_miles": "1.5", "ignored": "x"},'
        ' {"pickup_datetime": "2023-02-08T00:00:00.000"}, {"pickup_datetime": "x"}]'
    )
    for _ in range(2):
        jobs.run(spark, "sample_fhv", [f"pages={pages}", f"out={out}"])
    kept = spark.read.option("header", True).csv(out).collect()
    assert [(r.pickup_datetime, r.trip_miles, r.tips) for r in kept] == [("2023-02-07T23:59:00.000", "1.5", None)] * 2
    assert len(kept[0]) == 9

    responses = tmp_path / "responses"
    responses.mkdir()
    arrays = ", ".join(f'"{v}": [1, 2]' for v in ("temperature_2m", "precipitation", "rain", "snowfall", "snow_depth"))
    (responses / "1.json").write_text(f'{{"time_start": 604800, "time_end": 612000, "interval_s": 3600, {arrays}}}')
    (responses / "2.json").write_text(f'{{"time_start": 0, "time_end": 7200, "interval_s": 3600, {arrays}}}')
    jobs.run(spark, "weather_hours", [f"responses={responses}", f"out={tmp_path}/sky"])
    assert [r.date[:16] for r in spark.read.option("header", True).csv(f"{tmp_path}/sky").collect()] == [
        "1970-01-01T00:00",
        "1970-01-01T01:00",
    ]

    events = tmp_path / "events"
    events.mkdir()
    (events / "1.json").write_text('[{"event_id": "1", "start_date_time": "2023-01-01T10:00:00", "end_date_time": "x"}]')
    jobs.run(spark, "land_events", [f"pages={events}", f"out={tmp_path}/landed"])
    (event,) = spark.read.option("header", True).csv(f"{tmp_path}/landed").collect()
    assert (event.start_date_time[:16], event.end_date_time) == ("2023-01-01T10:00", None)


def test_results_by_name(spark):
    publish({"numbers": spark.range(3)})
    assert spark.sql("select sum(id) from numbers").first()[0] == 3


def test_wrong_arguments_are_named(spark):
    with pytest.raises(SystemExit, match="unknown job"):
        jobs.run(spark, "nothing", [])
    with pytest.raises(SystemExit, match="missing"):
        jobs.run(spark, "zone_hour", ["fhv=a"])


def test_csv_is_read_by_name(spark, tmp_path):
    folder = tmp_path / "named"
    folder.mkdir()
    (folder / "a.csv").write_text("extra,B,a\nx,2,1\ny,bad,3\n")
    got = sorted(tuple(r) for r in readers.read_csv(spark, str(folder), "a STRING, b INT").collect())
    assert got == [("1", 2), ("3", None)]
    with pytest.raises(ValueError, match="no column"):
        readers.read_csv(spark, str(folder), "a STRING, c INT")
    assert readers.read_csv(spark, str(folder), "a STRING, c INT", optional=["c"]).where("c is null").count() == 2


def test_hours_of_late_files_are_complete(spark, tmp_path):
    landing, target, progress = (str(tmp_path / d) for d in ("landing", "hours", "progress"))
    for day in ("2023-01-03", "2023-01-01", "2023-01-02"):
        trip = spark.createDataFrame([(f"{day}T05:59:00",), (f"{day}T06:00:00",)], "pickup_datetime string")
        trip.coalesce(1).write.mode("append").parquet(landing)
    stream = streams.stream_fhv(spark, landing, "pickup_datetime string", files_per_batch=1)
    assert streams.stream_hourly_demand(stream, target, progress).where("FHV = 1").count() == 6


def test_hours_outside_the_counts_are_not_made(spark):
    made = spark.createDataFrame([(1, "2023-01-01T00:30:00", "9999-01-01T00:00:00"), (2, "2023-01-01T00:30:00", None)], "event_id int, s string, e string")
    made = made.selectExpr("event_id", "cast(s as timestamp_ntz) start_time", "cast(e as timestamp_ntz) end_time", "'x' event_type", "'n' event_name", "'Bronx' event_borough")
    first, last = (F.lit(t).cast("timestamp_ntz") for t in ("2023-01-02T00:00:00", "2023-01-02T03:00:00"))
    got = sorted(r.timestamp.isoformat() for r in ev.expand_events_hourly(made, first, last).collect())
    assert got == ["2023-01-02T00:30:00", "2023-01-02T01:30:00", "2023-01-02T02:30:00"]
