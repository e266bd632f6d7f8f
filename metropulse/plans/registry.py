"""Registered queries: every operator over the benchmark tables, with floats rounded for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metropulse.functions import labels
from metropulse.functions.values import moment, number, round_even
from metropulse.operators import events as ev
from metropulse.operators import impact, quality, sketches, spatial, traffic, trips, weather
from metropulse.operators.staging import salted_join, settle, shared_folder
from metropulse.plans.bridge import YEAR, Feeds
from metropulse.plans.sqlfunctions import register_functions
from metropulse.session import pin
from metropulse.sources import pages, readers, schemas, writers
from metropulse.streaming import trips as streams

Query = Callable[[SparkSession, str], DataFrame]
DAY = f"{YEAR}-01-05"

_queries: dict[str, Query] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floats so that two engines' summation orders agree; adding zero removes a negative zero."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: round_even(F.col(c), digits) + 0.0 for c in floats}) if floats else df


def registered(job: Callable[[Feeds], DataFrame]) -> Callable[[Feeds], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(job(Feeds(pin(spark), sf_dir)))

    _queries[job.__name__] = query
    return job


def queries() -> dict[str, Query]:
    return dict(_queries)


# Trips -------------------------------------------------------------------------------------------------------


@registered
def clean_ylc(f: Feeds) -> DataFrame:
    return f.ylc


@registered
def clean_fhv(f: Feeds) -> DataFrame:
    return f.fhv


@registered
def normalize_trips(f: Feeds) -> DataFrame:
    return f.trips


@registered
def trips_zone_hour_service(f: Feeds) -> DataFrame:
    return trips.trips_zone_hour_service(f.trips)


@registered
def zone_hour(f: Feeds) -> DataFrame:
    return f.zone_hour


@registered
def prepare_hourly(f: Feeds) -> DataFrame:
    return trips.prepare_hourly(f.ylc, f.fhv)


@registered
def hourly_mobility(f: Feeds) -> DataFrame:
    return f.mobility


@registered
def segment_zone(f: Feeds) -> DataFrame:
    return trips.segment_zone(f.zone_hour)


@registered
def segment_max(f: Feeds) -> DataFrame:
    return trips.segment_max(trips.segment_zone(f.zone_hour))


@registered
def segment_map(f: Feeds) -> DataFrame:
    """The map per segment, listed entry by entry."""
    maps = trips.segment_map(trips.segment_zone(f.zone_hour))
    return maps.select("segmento", F.explode("zonas").alias("zona", "m")).select("segmento", "zona", "m.*")


@registered
def top5_longest_trips(f: Feeds) -> DataFrame:
    return trips.top5_longest_trips(f.ylc_raw)


# Weather -----------------------------------------------------------------------------------------------------


@registered
def weather_series(f: Feeds) -> DataFrame:
    return weather.weather_series(f.weather_responses)


@registered
def hourly_weather(f: Feeds) -> DataFrame:
    return f.hourly


@registered
def hourly_weather_local(f: Feeds) -> DataFrame:
    """Weather shifted to local time and every hour kept."""
    return weather.hourly_weather(f.mobility, f.weather_raw, ev.LOCAL_ZONE, dedup_values=False)


@registered
def rain_impact(f: Feeds) -> DataFrame:
    return weather.rain_impact(f.hourly)


# Traffic -----------------------------------------------------------------------------------------------------


@registered
def traffic_time(f: Feeds) -> DataFrame:
    timed = traffic.traffic_time(f.traffic_raw)
    return timed.select("SegmentID", "Vol", "timestamp").withColumns(traffic.time_labels(F.col("timestamp")))


@registered
def traffic_time_text(f: Feeds) -> DataFrame:
    return traffic.traffic_time(f.traffic_text).select("SegmentID", "Vol", "timestamp")


@registered
def wkt_point(f: Feeds) -> DataFrame:
    return traffic.wkt_point(f.traffic_raw).select("SegmentID", "WktGeom", "x", "y")


@registered
def geo_to_latlon(f: Feeds) -> DataFrame:
    return traffic.geo_to_latlon(f.traffic_raw).select("SegmentID", "WktGeom", "longitude", "latitude")


@registered
def bucket_part_of_day(f: Feeds) -> DataFrame:
    return f.traffic_raw.select("SegmentID", "HH", labels.part_of_day(F.col("HH")).alias("momento_dia"))


@registered
def title_case(f: Feeds) -> DataFrame:
    return f.traffic_raw.select(
        "SegmentID",
        "Boro",
        "street",
        labels.title_case(F.col("Boro")).alias("boro_title"),
        labels.title_case(F.col("street")).alias("street_title"),
    )


@registered
def traffic_outlier_filter(f: Feeds) -> DataFrame:
    return traffic.traffic_outlier_filter(f.traffic_raw).select("SegmentID", "Yr", "M", "D", "HH", "MM", "Vol")


@registered
def traffic_features(f: Feeds) -> DataFrame:
    return f.features


@registered
def onehot_borough(f: Feeds) -> DataFrame:
    """Columns found from the data instead of given."""
    titled = f.traffic_raw.select("SegmentID", labels.title_case(F.col("Boro")).alias("Boro"))
    return traffic.onehot_borough(titled)


@registered
def traffic_segment_hour(f: Feeds) -> DataFrame:
    return traffic.traffic_segment_hour(f.features)


@registered
def traffic_hotspots(f: Feeds) -> DataFrame:
    return traffic.traffic_hotspots(f.saved_features)


@registered
def traffic_borough_hour(f: Feeds) -> DataFrame:
    return traffic.traffic_borough_hour(f.features)


# Events ------------------------------------------------------------------------------------------------------


@registered
def clean_events(f: Feeds) -> DataFrame:
    return f.events


@registered
def expand_events_hourly(f: Feeds) -> DataFrame:
    return f.events_hourly


_TRAFFIC_KEYS = ["timestamp", "SegmentID", "Boro", "dia_semana", "hora_entera", "Vol", "latitude", "longitude"]


@registered
def traffic_baseline(f: Feeds) -> DataFrame:
    return f.baseline.select(*_TRAFFIC_KEYS, "baseline_vol")


@registered
def traffic_event_impact(f: Feeds) -> DataFrame:
    return f.traffic_event_impact.select(*_TRAFFIC_KEYS, "baseline_vol", *ev.EVENT_FIELDS, impact.CHANGE)


@registered
def flatten_mlb_schedule(f: Feeds) -> DataFrame:
    """Through files: schedules land as JSON lines and are scanned with the nested schema."""
    landing = shared_folder(f.spark, "schedule")
    writers.write_json_lines(f.schedule.select(F.to_json(F.struct("dates")).alias("value")), landing)
    return ev.flatten_mlb_schedule(readers.read_schedule(f.spark, landing, one_per_line=True))


@registered
def mlb_first_week(f: Feeds) -> DataFrame:
    return ev.mlb_first_week(f.games)


@registered
def mlb_as_events(f: Feeds) -> DataFrame:
    return ev.mlb_as_events(f.games, ev.largest_event_id(f.events))


@registered
def traffic_events_mlb(f: Feeds) -> DataFrame:
    return f.traffic_events_mlb.select(*_TRAFFIC_KEYS, "baseline_vol", *ev.EVENT_FIELDS, impact.CHANGE)


@registered
def distinct_event_types(f: Feeds) -> DataFrame:
    return ev.distinct_event_types(f.matches("event_type"), "n")


@registered
def event_hours_at_counts(f: Feeds) -> DataFrame:
    """Event hours that meet a count, found by interval instead of by making every hour."""
    return ev.event_hours_at(f.features, f.events)


@registered
def traffic_event_spread(f: Feeds) -> DataFrame:
    """The match beyond the broadcast limit: hours and boroughs with many counts are spread, others shuffled as they are."""
    hours = settle(ev.event_hours_at(f.saved_features, f.events), "hours")
    met = salted_join(f.baseline, hours, ["timestamp", "Boro"], "left", hot_rows=64)
    return ev.with_change(met).select(*_TRAFFIC_KEYS, "baseline_vol", *ev.EVENT_FIELDS, impact.CHANGE)


@registered
def flatten_mlb_documents(f: Feeds) -> DataFrame:
    """Schedules whose cells drift: durations in words or as text, venues as text, documents without games."""
    drifting = f.schedule.select(F.to_json(F.struct("dates")).alias("value"), "s_suppkey")
    value, key = F.col("value"), F.col("s_suppkey")
    lasts = r'"gameDurationMinutes":(\d+)'
    drift = (
        F.when(key % 11 == 3, F.regexp_replace(value, lasts, '"gameDurationMinutes":"about 3 hours"'))
        .when(key % 11 == 5, F.regexp_replace(value, lasts, '"gameDurationMinutes":"$1"'))
        .when(key % 11 == 7, F.regexp_replace(value, r'"venue":\{"name":"([^"]*)"\}', '"venue":"$1"'))
        .when(key % 11 == 9, F.lit('{"dates":"none"}'))
        .otherwise(value)
    )
    landing = shared_folder(f.spark, "drifting")
    writers.write_json_lines(drifting.select(drift.alias("value")), landing)
    return ev.flatten_mlb_documents(f.spark.read.text(landing))


@registered
def sql_expand_events(f: Feeds) -> DataFrame:
    """The hourly expansion in SQL alone."""
    register_functions(f.spark)
    return f.spark.sql(
        "SELECT h.timestamp, e.event_borough AS Boro, e.event_type, e.event_id, e.event_name "
        "FROM {events} e, LATERAL event_hours(e.start_time, e.end_time) h",
        events=f.events,
    )


@registered
def sql_traffic_features(f: Feeds) -> DataFrame:
    """The row rules of the traffic features in SQL alone."""
    register_functions(f.spark)
    return f.spark.sql(
        "SELECT SegmentID, Vol, title_text(Boro) AS Boro, title_text(street) AS street, title_text(fromSt) AS fromSt, "
        "HH AS hora_entera, part_of_day(HH) AS momento_dia, map_segment(HH) AS segmento, "
        "cyclic_sin(HH) AS hour_sin, cyclic_cos(HH) AS hour_cos FROM {counts}",
        counts=f.traffic_raw,
    )


# Impact reports: same figures as over the matched rows, from weighted cells ---------------------------------


@registered
def impact_by_type(f: Feeds) -> DataFrame:
    return impact.impact_by_type(f.matches("event_type"), "n")


def _by_event(f: Feeds) -> DataFrame:
    return impact.impact_by_event(f.matches("event_id", "event_name"), "n")


@registered
def impact_by_event(f: Feeds) -> DataFrame:
    return _by_event(f)


@registered
def top_events(f: Feeds) -> DataFrame:
    return impact.top_events(_by_event(f))


@registered
def extreme_events(f: Feeds) -> DataFrame:
    return impact.extreme_events(_by_event(f))


@registered
def day_vs_baseline(f: Feeds) -> DataFrame:
    return impact.day_vs_baseline(f.matches(), DAY, weight="n")


@registered
def day_vs_baseline_boro(f: Feeds) -> DataFrame:
    return impact.day_vs_baseline(f.matches(), DAY, "Queens", weight="n")


@registered
def impact_type_hour_matrix(f: Feeds) -> DataFrame:
    return impact.impact_type_hour_matrix(f.matches("event_type"), "n")


@registered
def box_stats_by_type(f: Feeds) -> DataFrame:
    return impact.box_stats_by_type(f.matches("event_type"), "n")


@registered
def kde_event_vs_none(f: Feeds) -> DataFrame:
    return impact.kde_event_vs_none(f.matches("event_type"), "n")


@registered
def kde_binned(f: Feeds) -> DataFrame:
    return impact.kde_binned(f.matches("event_type"), "n", bins=1024)


# Space -------------------------------------------------------------------------------------------------------


@registered
def demand_by_hour_service(f: Feeds) -> DataFrame:
    return spatial.demand_by_hour_service(f.titled)


@registered
def demand_with_borough(f: Feeds) -> DataFrame:
    return spatial.demand_with_borough(f.titled, f.lookup)


@registered
def city_rhythm(f: Feeds) -> DataFrame:
    return spatial.city_rhythm(f.features, f.titled)


@registered
def borough_share_detailed(f: Feeds) -> DataFrame:
    return spatial.borough_share_detailed(f.features, f.titled, f.lookup)


@registered
def borough_share_total(f: Feeds) -> DataFrame:
    return spatial.borough_share_total(f.features, f.titled, f.lookup)


@registered
def features_zone_hour(f: Feeds) -> DataFrame:
    return spatial.features_zone_hour(f.zone_hour, f.zones).drop("geometry")


@registered
def zone_features_full(f: Feeds) -> DataFrame:
    """All zone columns and geometries of one or several parts, through map features and back."""
    target = shared_folder(f.spark, "zones")
    writers.write_json_lines(spatial.feature_json(spatial.features_zone_hour(f.zone_hour, f.zones_full)), target)
    popup = "zone: string, borough: string, service_zone: string, pickup_hour: int, FHV: bigint, YLC: bigint"
    inner = f"LocationID: bigint, popup: struct<{popup}>"
    read = f.spark.read.schema(f"geometry struct<type: string, coordinates: variant>, properties struct<{inner}>").json(target)
    parts = F.size(F.variant_get("geometry.coordinates", "$", "array<variant>")).alias("parts")
    return read.select(F.col("geometry.type").alias("shape"), parts, "properties.LocationID", "properties.popup.*")


# Quality -----------------------------------------------------------------------------------------------------


@registered
def profile_schema(f: Feeds) -> DataFrame:
    return quality.profile_schema(f.ylc_raw)


@registered
def profile_numeric(f: Feeds) -> DataFrame:
    return quality.profile_numeric(f.ylc_raw, trips.YLC_NUMBERS)


@registered
def profile_nulls(f: Feeds) -> DataFrame:
    return quality.profile_nulls(f.fhv_raw)


@registered
def profile_distinct(f: Feeds) -> DataFrame:
    return quality.profile_distinct(f.ylc_raw, ["vendorid", "pulocationid", "dolocationid", "payment_type"])


@registered
def value_counts(f: Feeds) -> DataFrame:
    return quality.value_counts(f.fhv_raw, "pulocationid", keep_null=True)


@registered
def audit_zone_join(f: Feeds) -> DataFrame:
    return quality.audit_zone_join(f.fhv, f.ylc, f.lookup)


@registered
def key_types(f: Feeds) -> DataFrame:
    """The zone key as each source has it."""
    sources = {"fhv": (f.fhv_raw, "PULocationID"), "ylc": (f.ylc_raw, "PULocationID"), "lookup": (f.lookup, "locationid")}
    return quality.key_types(sources)


def _kept_profile(f: Feeds, columns: list[str]) -> DataFrame:
    """Sketches kept by day, the days landed in two runs, one of them twice."""
    target = shared_folder(f.spark, "profile")
    day = F.to_date("tpep_dropoff_datetime")
    odd = F.dayofmonth("tpep_dropoff_datetime") % 2 == 1
    for landed in (f.ylc_raw.where(odd), f.ylc_raw.where(~odd), f.ylc_raw.where(odd)):
        sketches.update_profile(landed, columns, day, target)
    return sketches.read_profile(f.spark, target)


@registered
def profile_merged(f: Feeds) -> DataFrame:
    return _kept_profile(f, trips.YLC_NUMBERS).select("column", "count", "n_null", "mean", "std", "min", "max")


@registered
def profile_merged_codes(f: Feeds) -> DataFrame:
    """Distinct codes, few enough for an exact sketch."""
    return _kept_profile(f, trips.YLC_CODES).select("column", "count", "n_distinct", "min", "max")


# Sources and sinks: each goes through files in the shared folder ---------------------------------------------


@registered
def scan_csv(f: Feeds) -> DataFrame:
    landing = shared_folder(f.spark, "csv")
    writers.write_csv(f.ylc_raw, landing)
    raw = readers.read_csv(f.spark, landing, schemas.RAW_YLC)
    numbers = [number(c).alias(c) for c in trips.YLC_NUMBERS]
    stamps = [moment(c).alias(c) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")]
    codes = {c: F.col(c).try_cast("int").alias(c) for c in trips.YLC_CODES}
    return raw.select(codes["vendorid"], *stamps, codes["pulocationid"], codes["dolocationid"], codes["payment_type"], *numbers)


@registered
def scan_parquet(f: Feeds) -> DataFrame:
    return readers.read_parquet(f.spark, f"{f.sf_dir}/events.parquet", ["event_id", "ts", "value"])


@registered
def scan_json_pages(f: Feeds) -> DataFrame:
    """Pages of 50,000 rows, each a file holding one array."""
    landing = shared_folder(f.spark, "pages")
    rows = f.table("events").selectExpr(
        "event_id div 50000 page",
        "cast(event_id as string) event_id",
        "case when event_id % 3 = 0 then null else event_type end event_type",
        "cast(ts as string) start_date_time",
    )
    item = F.struct("event_id", "event_type", "start_date_time")
    pages = rows.groupBy("page").agg(F.to_json(F.collect_list(item)).alias("value"))
    pages.write.partitionBy("page").text(landing)
    read = readers.read_json_pages(f.spark, f"{landing}/page=*", schemas.RAW_EVENT_PAGES)
    return read.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        "event_type",
        "event_borough",
        moment("start_date_time").alias("start_time"),
    )


@registered
def sample_pages(f: Feeds) -> DataFrame:
    """First weeks from taxi pages: the index chooses the pages to open."""
    landing, index = shared_folder(f.spark, "taxi-pages"), shared_folder(f.spark, "page-index")
    rows = f.ylc_rows.select((F.col("event_id") / 5000).cast("int").alias("page"), F.struct(*f.ylc_raw.columns).alias("item"))
    rows.groupBy("page").agg(F.to_json(F.collect_list("item")).alias("value")).write.partitionBy("page").text(landing)
    pages.update_index(f.spark, landing, index, schemas.RAW_YLC, "tpep_pickup_datetime")
    read = pages.read_pages(f.spark, index, schemas.RAW_YLC, "tpep_pickup_datetime", pages.first_weeks(YEAR))
    numbers = [number(c).alias(c) for c in trips.YLC_NUMBERS]
    codes = [F.col(c).try_cast("int").alias(c) for c in trips.YLC_CODES]
    return read.select(moment("tpep_pickup_datetime").alias("tpep_pickup_datetime"), *codes, *numbers)


@registered
def sample_first_week(f: Feeds) -> DataFrame:
    return readers.sample_first_week(f.table("events").select("event_id", "ts", "value"), "ts", YEAR)


@registered
def compact_parquet(f: Feeds) -> DataFrame:
    parts, packed = shared_folder(f.spark, "parts"), shared_folder(f.spark, "packed")
    writers.write_parquet(f.fhv.repartition(32), parts)
    return writers.compact_parquet(f.spark, parts, packed)


@registered
def sink_csv(f: Feeds) -> DataFrame:
    """One service written, the other appended, both read back as one table."""
    target = shared_folder(f.spark, "csv-sink")
    columns = ["pickup_datetime", "pulocationid"]
    writers.write_csv(f.fhv.select(*columns), target)
    writers.write_csv(f.ylc.select(F.col("tpep_pickup_datetime").alias("pickup_datetime"), "pulocationid"), target, "append")
    back = readers.read_csv(f.spark, target, "pickup_datetime TIMESTAMP_NTZ, pulocationid DOUBLE")
    return back.withColumn("pulocationid", F.col("pulocationid").cast("bigint"))


@registered
def sink_parquet(f: Feeds) -> DataFrame:
    """The hourly table with its hour as an ordinary column, partitioned by day."""
    target = shared_folder(f.spark, "parquet-sink")
    writers.write_parquet(f.hourly.withColumn("dia", F.to_date("datetime_hour")), target, ["dia"])
    return readers.read_parquet(f.spark, target, f.hourly.columns)


@registered
def sink_days(f: Feeds) -> DataFrame:
    """The hourly table landed by day in two halves, the second one twice; no row is there twice and no day is lost."""
    target = shared_folder(f.spark, "days")
    hourly = settle(f.hourly.withColumn("dia", F.to_date("datetime_hour")), "hourly").df
    late = F.dayofmonth("dia") > 15
    for part in (hourly.where(~late), hourly.where(late), hourly.where(late)):
        writers.write_days(part, target, ["dia"])
    return readers.read_parquet(f.spark, target, f.hourly.columns)


@registered
def sink_runs(f: Feeds) -> DataFrame:
    """Both services as runs of one CSV dataset, the first run repeated."""
    target = shared_folder(f.spark, "runs")
    columns = ["pickup_datetime", "pulocationid"]
    taxis = f.ylc.select(F.col("tpep_pickup_datetime").alias("pickup_datetime"), "pulocationid")
    for run, rows in (("fhv 1/2", f.fhv.select(*columns)), ("ylc", taxis), ("fhv 1/2", f.fhv.select(*columns))):
        writers.append_run(rows, target, run)
    back = readers.read_csv(f.spark, target, "pickup_datetime TIMESTAMP_NTZ, pulocationid DOUBLE")
    return back.withColumn("pulocationid", F.col("pulocationid").cast("bigint"))


@registered
def features_json(f: Feeds) -> DataFrame:
    """Map features written as JSON lines and read back."""
    target = shared_folder(f.spark, "features")
    writers.write_json_lines(spatial.feature_json(spatial.features_zone_hour(f.zone_hour, f.zones)), target)
    style = "color: string, weight: double, fillColor: string, fillOpacity: double"
    popup = "zone: string, pickup_hour: int, FHV: bigint, YLC: bigint, ratio: double"
    shape = "type: string, coordinates: array<array<array<double>>>"
    inner = f"LocationID: bigint, time: string, style: struct<{style}>, popup: struct<{popup}>"
    read = f.spark.read.schema(f"type string, geometry struct<{shape}>, properties struct<{inner}>").json(target)
    corners = F.size(F.element_at("geometry.coordinates", 1)).alias("corners")
    return read.select("type", corners, "properties.LocationID", "properties.time", "properties.style.*", "properties.popup.*")


# Streams -----------------------------------------------------------------------------------------------------


def _landed_fhv(f: Feeds) -> DataFrame:
    landing = shared_folder(f.spark, "landing")
    writers.write_parquet(f.fhv_raw, landing)
    return streams.stream_fhv(f.spark, landing, f.fhv_raw.schema)


@registered
def stream_clean_fhv(f: Feeds) -> DataFrame:
    return streams.stream_clean_fhv(_landed_fhv(f), shared_folder(f.spark, "clean"), shared_folder(f.spark, "progress"))


@registered
def stream_hourly_demand(f: Feeds) -> DataFrame:
    return streams.stream_hourly_demand(_landed_fhv(f), shared_folder(f.spark, "demand"), shared_folder(f.spark, "progress"))


@registered
def stream_zone_demand(f: Feeds) -> DataFrame:
    """Hourly demand by zone in small batches, summed up every third; the files come in an order that is not that of their hours."""
    landing = shared_folder(f.spark, "landing")
    f.fhv_raw.repartition(7, "dolocationid").write.parquet(landing)
    raw = streams.stream_fhv(f.spark, landing, f.fhv_raw.schema, files_per_batch=1)
    target, progress = shared_folder(f.spark, "zone-demand"), shared_folder(f.spark, "progress")
    return streams.stream_hourly_demand(raw, target, progress, ["pulocationid"], fold_every=3)
