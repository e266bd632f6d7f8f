"""The processing steps as file-to-file jobs.

Each job reads the files of the steps before it, builds one lazy plan and writes one dataset, so steps can be
scheduled and rerun on their own: ``spark-submit run_job.py zone_hour fhv=... ylc=... out=...``.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metropulse.functions.times import floor_hour
from metropulse.functions.values import moment
from metropulse.operators import events as ev
from metropulse.operators import impact, spatial, traffic, trips, weather
from metropulse.operators.staging import settle
from metropulse.plans.audit import audited, watched
from metropulse.session import pin
from metropulse.sources import readers, schemas
from metropulse.sources.writers import append_run, write_csv, write_days, write_json_lines, write_parquet

JOBS: dict[str, Callable[..., None]] = {}


def job(step: Callable[..., None]) -> Callable[..., None]:
    JOBS[step.__name__] = step
    return step


def run(spark: SparkSession, name: str, arguments: Sequence[str]) -> None:
    """Run a job with ``key=value`` arguments. ``audit=path`` appends the rows it read and wrote to the table there."""
    if name not in JOBS:
        raise SystemExit(f"unknown job '{name}'; known: {', '.join(JOBS)}")
    given = dict(a.split("=", 1) for a in arguments)
    path = given.pop("audit", None)
    wanted = inspect.signature(JOBS[name]).parameters
    missing = [p for p, v in wanted.items() if p != "spark" and v.default is v.empty and p not in given]
    if missing or set(given) - set(wanted):
        raise SystemExit(f"{name} takes {', '.join(p for p in wanted if p != 'spark')}; missing {missing}")
    with audited(spark, name, path):
        JOBS[name](pin(spark), **given)


def _parquet(spark: SparkSession, path: str) -> DataFrame:
    return watched(readers.read_parquet(spark, path), "in", path)


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return watched(readers.read_csv(spark, path, schema), "in", path)


def _pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return watched(readers.read_json_pages(spark, path, schema), "in", path)


def _to_csv(df: DataFrame, path: str) -> None:
    write_csv(watched(df, "out", path), path)


def _to_parquet(df: DataFrame, path: str) -> None:
    write_parquet(watched(df, "out", path), path)


def _by_day(df: DataFrame, stamp: str, out: str) -> None:
    """Days found in ``df`` replace those in ``out``; other days stay."""
    write_days(watched(df, "out", out).withColumn("pickup_date", F.to_date(stamp)), out, ["pickup_date"])


def _sample(spark: SparkSession, pages: str, schema: str, stamp: str, out: str, year: str, run: str) -> None:
    """Append the sample; as the named ``run`` it takes the place of what that run appended before."""
    landed = readers.read_json_pages(spark, pages, schema)  # not counted, so that the weeks reach the scan
    wanted = watched(readers.sample_first_week(landed, stamp, int(year)), "out", out)
    if run:
        append_run(wanted, out, run)
    else:
        write_csv(wanted, out, "append")


@job
def sample_fhv(spark: SparkSession, pages: str, out: str, year: str = "2023", run: str = "") -> None:
    """First week of every month from landed for-hire pages, appended to a CSV dataset."""
    _sample(spark, pages, schemas.RAW_FHV, "pickup_datetime", out, year, run)


@job
def sample_ylc(spark: SparkSession, pages: str, out: str, year: str = "2023", run: str = "") -> None:
    _sample(spark, pages, schemas.RAW_YLC, "tpep_pickup_datetime", out, year, run)


@job
def land_events(spark: SparkSession, pages: str, out: str) -> None:
    """Landed event pages as one CSV dataset; unreadable times become empty."""
    landed = _pages(spark, pages, schemas.RAW_EVENT_PAGES)
    _to_csv(landed.withColumns({c: moment(c) for c in ("start_date_time", "end_date_time")}), out)


@job
def weather_hours(spark: SparkSession, responses: str, out: str, days: str = "7") -> None:
    """Hourly weather of the first days of each month from landed responses."""
    series = weather.weather_series(_pages(spark, responses, schemas.WEATHER_RESPONSE))
    _to_csv(readers.first_days(series, "date", int(days)).orderBy("date"), out)


@job
def clean_fhv(spark: SparkSession, raw: str, out: str) -> None:
    """Landed for-hire CSV to clean trips partitioned by day."""
    _by_day(trips.clean_fhv(_csv(spark, raw, schemas.RAW_FHV)), "pickup_datetime", out)


@job
def clean_ylc(spark: SparkSession, raw: str, out: str) -> None:
    """Landed taxi CSV to clean trips partitioned by day."""
    _by_day(trips.clean_ylc(_csv(spark, raw, schemas.RAW_YLC)), "tpep_pickup_datetime", out)


@job
def zone_hour(spark: SparkSession, fhv: str, ylc: str, out: str) -> None:
    demand = trips.normalize_trips(_parquet(spark, fhv), _parquet(spark, ylc))
    _to_parquet(trips.zone_hour(demand).orderBy("pickup_hour", "LocationID"), out)


@job
def hourly_aggregate(spark: SparkSession, fhv: str, ylc: str, sky: str, out: str) -> None:
    both = trips.prepare_hourly(_parquet(spark, ylc), _parquet(spark, fhv))
    conditions = _csv(spark, sky, schemas.RAW_WEATHER)
    _to_parquet(weather.hourly_weather(trips.hourly_mobility(both), conditions).orderBy("datetime_hour"), out)


@job
def rain_impact(spark: SparkSession, hourly: str, out: str) -> None:
    _to_csv(weather.rain_impact(_parquet(spark, hourly)), out)


@job
def mlb_games(spark: SparkSession, schedule: str, out: str) -> None:
    _to_csv(ev.flatten_mlb_schedule(readers.read_schedule(spark, schedule)).orderBy("start_time_ny"), out)


@job
def traffic_features(spark: SparkSession, raw: str, out: str) -> None:
    counts = _csv(spark, raw, schemas.RAW_TRAFFIC)
    _to_parquet(traffic.traffic_features(counts, traffic.BOROUGHS), out)


@job
def traffic_events(spark: SparkSession, features: str, events: str, games: str, out: str) -> None:
    """Traffic with its baseline, the permitted events (export CSV) and the first-week games."""
    permitted = ev.clean_events(_csv(spark, events, schemas.RAW_EVENTS))
    home = ev.mlb_first_week(_csv(spark, games, schemas.RAW_GAMES))
    based = ev.traffic_baseline(_parquet(spark, features))
    counts = _parquet(spark, features)
    hours = counts.withColumn("timestamp", floor_hour(F.col("timestamp")))
    met = ev.traffic_event_impact(based, ev.event_hours_at(counts, permitted))
    numbered = ev.mlb_as_events(home, ev.largest_event_id(permitted))
    _to_parquet(ev.traffic_events_mlb(met, ev.event_hours_at(hours, numbered, whole_hours=True)), out)


@job
def event_reports(spark: SparkSession, traffic_events: str, out: str, days: str = "2023-11-05,2023-02-04,2023-07-04") -> None:
    """All event reports as CSV directories under ``out``; ``days`` are compared with their baseline."""
    rows = _parquet(spark, traffic_events)
    # The matched table is read once per grain: equal rows of a cell and event collapse to one with a count, and the event
    # summary, which three reports show, is written once.
    grain = ["timestamp", "Boro", "hora_entera", "Vol", "baseline_vol", *ev.EVENT_FIELDS, impact.CHANGE]
    rows = settle(rows.groupBy(*grain).agg(F.count(F.lit(1)).alias("n")), "report-cells").df
    summary = settle(impact.impact_by_event(rows, "n"), "report-events").df
    reports = {
        "by_type": impact.impact_by_type(rows, weight="n").orderBy(F.desc_nulls_last("mean")),
        "by_event": summary,
        "top": impact.top_events(summary),
        "extremes": impact.extreme_events(summary),
        "type_by_hour": impact.impact_type_hour_matrix(rows, weight="n"),
        "box": impact.box_stats_by_type(rows, weight="n"),
        "density": impact.kde_event_vs_none(rows, weight="n"),
        **{f"day_{d}": impact.day_vs_baseline(rows, d, weight="n").orderBy("hora_entera") for d in days.split(",")},
    }
    for name, report in reports.items():
        _to_csv(report, f"{out}/{name}")


@job
def traffic_reports(spark: SparkSession, features: str, out: str) -> None:
    rows = _parquet(spark, features)
    _to_csv(traffic.traffic_segment_hour(rows).orderBy("hora_entera"), f"{out}/segment_hour")
    _to_csv(traffic.traffic_hotspots(rows), f"{out}/hotspots")
    _to_csv(traffic.traffic_borough_hour(rows).orderBy("hora_entera", "Boro"), f"{out}/borough_hour")


@job
def borough_reports(spark: SparkSession, features: str, fhv: str, ylc: str, lookup: str, out: str) -> None:
    counts = _parquet(spark, features)
    demand = trips.titled_trips(_parquet(spark, fhv), _parquet(spark, ylc))
    zones = readers.read_zone_lookup(spark, lookup)
    _to_csv(spatial.city_rhythm(counts, demand).orderBy("hora_entera"), f"{out}/rhythm")
    _to_csv(spatial.borough_share_detailed(counts, demand, zones), f"{out}/share_detailed")
    _to_csv(spatial.borough_share_total(counts, demand, zones), f"{out}/share_total")


@job
def map_data(spark: SparkSession, zone_hours: str, zones: str, out: str, metric: str = "ratio") -> None:
    """JSON lines for the two maps: slider features, and measures per day segment. ``zones`` is a Parquet table."""
    demand = _parquet(spark, zone_hours)
    slider = spatial.features_zone_hour(demand, _parquet(spark, zones), metric)
    segments = trips.segment_zone(demand)
    write_json_lines(spatial.feature_json(slider), f"{out}/slider")
    for name, table in (("segments", trips.segment_map(segments)), ("scales", trips.segment_max(segments))):
        write_json_lines(table.select(F.to_json(F.struct("*")).alias("value")), f"{out}/{name}")
