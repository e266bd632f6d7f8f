"""Interval matching, streamed counts, binned density, kept sketches, key types, audits and repeatable sinks."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metropulse.functions.times import floor_hour
from metropulse.operators import events as ev
from metropulse.operators import impact, quality, sketches, traffic
from metropulse.operators.staging import settle, shared_folder
from metropulse.plans import jobs
from metropulse.plans.audit import Audit, read_audit
from metropulse.plans.sqlfunctions import register_functions
from metropulse.sources import readers, schemas, writers
from metropulse.streaming import trips as streams

EVENTS = "event_type string, event_id bigint, event_name string, event_borough string, start_time timestamp_ntz, end_time timestamp_ntz"


def rows_of(df):
    return sorted(map(str, df.collect()))


# --- events by interval --------------------------------------------------------------------------------------------------------


def some_events(rng, n):
    start = dt.datetime(2023, 12, 1)
    out = []
    for i in range(n):
        at = start + dt.timedelta(minutes=15 * rng.randrange(4 * 24 * 60), seconds=rng.choice([0, 0, 0, 7]))
        lasts = rng.choice([-1, 0, 0.5, 1, 3, 30, 24 * 20, 24 * 400])
        end = rng.choice([at + dt.timedelta(hours=lasts)] * 9 + [None])
        out.append((rng.choice(["A", "B", None]), i, f"e{i}", rng.choice(["Bronx", "Queens", None]), at, end))
    out.append(("C", n, "forever", "Bronx", dt.datetime(2020, 1, 1, 0, 15), dt.datetime(9999, 1, 1)))
    out.append(("C", n + 1, "no start", "Bronx", None, dt.datetime(2024, 1, 1)))
    return out


def some_times(rng, n):
    start = dt.datetime(2023, 12, 20)
    return [(start + dt.timedelta(minutes=15 * rng.randrange(4 * 24 * 20)), rng.choice(["Bronx", "Queens", None])) for _ in range(n)] + [(None, "Bronx")]


@pytest.mark.parametrize("whole_hours", [False, True])
def test_event_hours_by_interval_equal_the_expansion(spark, whole_hours):
    rng = random.Random(5)
    events = some_events(rng, 300)
    times = spark.createDataFrame(some_times(rng, 800), "timestamp timestamp_ntz, Boro string")
    if whole_hours:
        times = times.withColumn("timestamp", floor_hour(F.col("timestamp")))
    table = spark.createDataFrame(events, EVENTS)
    clipped = [(*e[:5], min(e[5], dt.datetime(2025, 1, 1)) if e[5] else None) for e in events]
    hours = ev.expand_events_hourly(spark.createDataFrame(clipped, EVENTS))
    if whole_hours:
        hours = hours.withColumn("timestamp", floor_hour(F.col("timestamp")))
    want = hours.join(times.dropna().distinct(), ["timestamp", "Boro"], "left_semi")
    got = ev.event_hours_at(times, table, whole_hours)
    assert rows_of(got) == rows_of(want.select(got.columns)) and got.count() > 1000
    assert ev.event_hours_at(times.limit(0), table).count() == 0
    assert ev.event_hours_at(times, table.limit(0)).count() == 0


def test_long_events_are_few_rows(spark):
    start = dt.datetime(2024, 1, 1, 5, 30)
    lengths = [0, 1, 23, 24, 25, 24 * 365, 24 * 365 * 9]
    events = spark.createDataFrame([("A", i, "e", "Bronx", start, start + dt.timedelta(hours=h)) for i, h in enumerate(lengths)], EVENTS)
    far = F.lit(2**61).cast("bigint")
    counts = {r.event_id: r["count"] for r in ev.event_spans(events, -far, far).groupBy("event_id").count().collect()}
    assert set(counts) == set(range(len(lengths))) and max(counts.values()) <= 2


def test_schedules_with_drifting_cells(spark):
    good = '{"gameDate":"2024-07-04T23:05:00Z","venue":{"name":"Citi Field"},"gameInfo":{"gameDurationMinutes":%s}}'
    documents = [
        '{"dates":[{"games":[%s,%s]}]}' % (good % "150", good % '"90"'),
        '{"dates":[{"games":[%s]},{"games":"rain"},{"other":1}]}' % (good % '"long"'),
        '{"dates":[{"games":[{"gameDate":5,"venue":{"name":"Citi Field"}},{"gameDate":"2024-11-03T06:30:00Z","venue":{"name":"Yankee Stadium"}}]}]}',
        '{"dates":null}', '{"dates":{"games":[]}}', "[]", "no json", None, '{"dates":[{"games":[{"gameDate":"2024-07-04","venue":"Citi Field"}]}]}',
    ]
    got = ev.flatten_mlb_documents(spark.createDataFrame([(d,) for d in documents], "value string")).collect()
    evening = dt.datetime(2024, 7, 4, 19, 5)
    want = [(evening, evening + dt.timedelta(minutes=150)), (evening, evening + dt.timedelta(minutes=90)), (evening, None), (dt.datetime(2024, 11, 3, 1, 30), None), (None, None)]
    assert sorted([(r.start_time_ny, r.end_time_ny) for r in got], key=str) == sorted(want, key=str)


def test_games_do_not_follow_the_session_zone(spark):
    schedule = spark.createDataFrame([('{"dates":[{"games":[{"gameDate":"2024-11-03T05:30:00Z","venue":{"name":"Citi Field"}},{"gameDate":"2024-11-03T06:30:00Z","venue":{"name":"Citi Field"}}]}]}',)], "value string")
    want = rows_of(ev.flatten_mlb_documents(schedule))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows_of(ev.flatten_mlb_documents(schedule)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


# --- streamed counts -------------------------------------------------------------------------------------------------------------


def trips_of(spark, rng, n):
    start = dt.datetime(2024, 3, 1)
    rows = [(str(start + dt.timedelta(minutes=rng.randrange(600))) if rng.random() < 0.95 else "x", rng.choice(["1", "2", None])) for _ in range(n)]
    return spark.createDataFrame(rows, "pickup_datetime string, pulocationid string")


def counted(df, *keys):
    return rows_of(df.select("datetime_hour", *keys, "FHV"))


@pytest.mark.parametrize("fold_every", [2, 100])
def test_streamed_counts_of_late_files_and_repeated_batches(spark, fold_every):
    rng = random.Random(fold_every)
    landing, target, progress = (shared_folder(spark, x) for x in ("landing", "demand", "progress"))
    everything = None
    for _ in range(3):  # three starts of the stream; hours overlap at random
        more = settle(trips_of(spark, rng, 400).repartition(3), "more").df
        more.write.mode("append").parquet(landing)
        everything = more if everything is None else everything.union(more)
        raw = streams.stream_fhv(spark, landing, more.schema, files_per_batch=1)
        got = streams.stream_hourly_demand(raw, target, progress, ["pulocationid"], fold_every)
        hour = F.to_timestamp_ntz(F.when(F.col("pickup_datetime") != "x", F.col("pickup_datetime")))
        batch = everything.select(floor_hour(hour).alias("datetime_hour"), "pulocationid").dropna(subset=["datetime_hour"])
        want = batch.groupBy("datetime_hour", "pulocationid").agg(F.count("*").alias("FHV"))
        assert counted(got, "pulocationid") == counted(want, "pulocationid")
    stored = spark.read.parquet(target)
    assert stored.count() <= (9 + 9 // fold_every) * 11 * 3  # hours x batches, not trips
    before = counted(got, "pulocationid")
    again = batch.limit(50)
    last = max(r.last for r in stored.select("last").distinct().collect())
    for _ in range(2):  # a new batch that is run twice counts once
        streams.land_counts(again, last + 1, target, ["pulocationid"], fold_every)
    kinds = {"pulocationid": "string"}
    both = streams.hourly_demand(spark, target, ["pulocationid"], kinds)
    assert both.agg(F.sum("FHV")).first()[0] == got.agg(F.sum("FHV")).first()[0] + again.count()
    streams.land_counts(batch.limit(0), last + 1, target, ["pulocationid"], fold_every)
    assert counted(streams.hourly_demand(spark, target, ["pulocationid"], kinds), "pulocationid") == before


def test_stream_counts_rows_before_and_after(spark):
    landing, target, progress = (shared_folder(spark, x) for x in ("landing", "clean", "progress"))
    row = ("2024-01-01 00:00:00", "2024-01-01 00:30:00", "1", "2", "3", "4", "0", "0", "5")
    bad = ("x", *row[1:])
    raw = spark.createDataFrame([row] * 5 + [bad] * 3, schemas.RAW_FHV)
    raw.write.parquet(landing)
    counts = []
    clean = streams.stream_clean_fhv(streams.stream_fhv(spark, landing, raw.schema), target, progress, counts)
    assert clean.count() == 5 and [(i, o) for _, i, o in counts] == [(8, 5)]


# --- density -----------------------------------------------------------------------------------------------------------------


def test_binned_density_stays_within_its_bound(spark):
    rng = np.random.default_rng(3)
    rows = [("A" if i % 3 else None, float(v)) for i, v in enumerate(np.concatenate([rng.normal(0, 5, 900), rng.normal(40, 2, 500)]))]
    rows += [("A", 12.5)] * 300 + [("B", None)]
    df = spark.createDataFrame(rows, f"event_type string, {impact.CHANGE} double")
    exact = sorted(map(tuple, impact.kde_event_vs_none(df).collect()))
    for bins in (64, 1024, impact.DENSITY_BINS):
        made = sorted(map(tuple, impact.kde_binned(df, bins=bins).collect()))
        assert len(made) == len(exact) == 400
        for (flag, x, density), (flag2, x2, near, bound) in zip(exact, made, strict=True):
            assert flag == flag2 and x2 == pytest.approx(x, abs=1e-9) and abs(near - density) <= bound + 1e-12
    assert bound < 1e-7
    assert impact.kde_binned(df.limit(0)).count() == 0
    weighed = df.groupBy("event_type", impact.CHANGE).agg(F.count("*").alias("n"))
    assert [r[2] for r in sorted(map(tuple, impact.kde_binned(weighed, "n", 64).collect()))] == pytest.approx([r[2] for r in sorted(map(tuple, impact.kde_binned(df, bins=64).collect()))])


def test_binned_density_makes_few_rows(spark):
    df = spark.range(50_000).select(F.lit("A").alias("event_type"), (F.rand(1) * 100).alias(impact.CHANGE))
    bins = settle(impact.kde_binned(df, bins=32), "density")
    assert bins.rows == 200


# --- profiles ----------------------------------------------------------------------------------------------------------------


def test_kept_profiles_merge(spark):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(1e6, 3, 6000), rng.exponential(50, 3000), np.zeros(3000)])
    rows = [(dt.date(2024, 1, 1 + i % 9), float(v), str(i % 37) if i % 5 else "bad") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "d date, v double, code string").repartition(6)
    target = shared_folder(spark, "profile")
    for days in ((1, 2, 3), (4, 5), (3, 6, 7, 8, 9), (1,)):  # day 3 and day 1 come twice
        sketches.update_profile(df.where(F.dayofmonth("d").isin(*days)), ["v", "code"], F.col("d"), target)
    got = {r.column: r for r in sketches.read_profile(spark, target).collect()}
    exact = {r.column: r for r in quality.profile_numeric(df, ["v", "code"]).collect()}
    for c in ("v", "code"):
        assert got[c]["count"] == exact[c]["count"] and got[c].n_null == len(rows) - exact[c]["count"]
        assert (got[c].min, got[c].max) == (exact[c].min, exact[c].max)
        assert got[c].mean == pytest.approx(exact[c].mean, rel=1e-12) and got[c].std == pytest.approx(exact[c].std, rel=1e-9)
    known = np.sort(values)
    for name, q in sketches.QUANTILES.items():
        low, high = np.searchsorted(known, got["v"][name], "left"), np.searchsorted(known, got["v"][name], "right")
        assert low / len(known) - sketches.RANK_ERROR <= q <= high / len(known) + sketches.RANK_ERROR
    distinct = len(set(values.tolist()))
    assert abs(got["v"].n_distinct - distinct) <= sketches.DISTINCT_ERROR * distinct and got["code"].n_distinct == 37
    week = {r.column: r["count"] for r in sketches.read_profile(spark, target, "2024-01-02", "2024-01-03").collect()}
    assert week["v"] == sum(r[0].day in (2, 3) for r in rows)
    none = {r.column: tuple(r)[1:] for r in sketches.merge_profiles(sketches.sketch_profile(df.where("v < -9e9"), ["v"], ["d"])).collect()}
    assert none == {}


def test_numeric_profile_reads_its_source_once(spark):
    df = spark.createDataFrame([(1.0, "2"), (float("nan"), "x"), (4.0, None), (4.0, "9")], "a double, b string")
    got = {r.column: tuple(r)[1:] for r in quality.profile_numeric(df, ["a", "b"]).collect()}
    assert got["a"] == pytest.approx((3, 3.0, math.sqrt(3), 1.0, 2.5, 4.0, 4.0, 4.0))
    assert got["b"] == pytest.approx((2, 5.5, math.sqrt(24.5), 2.0, 3.75, 5.5, 7.25, 9.0))
    empty = {r.column: tuple(r)[1:] for r in quality.profile_numeric(df.limit(0), ["a", "b"]).collect()}
    assert empty == {c: (0, *[None] * 7) for c in ("a", "b")}
    assert quality.profile_numeric(df, ["a"], approx=True).first()["count"] == 3


def test_keys_of_different_types_are_reported(spark):
    one = spark.createDataFrame([("1",), ("x",), (None,), ("2.5",), ("7.0",)], "PULocationID string")
    two = spark.createDataFrame([(1,), (None,)], "pulocationid int")
    three = spark.createDataFrame([(5, "z")], "LocationID int, zone string")
    got = {r.source: tuple(r)[1:] for r in quality.key_types({"a": (one, "pulocationid"), "b": (two, "PULocationID"), "c": (three, "locationid")}).collect()}
    assert got == {
        "a": ("PULocationID", "string", 5, 1, 2, True),
        "b": ("pulocationid", "int", 2, 1, 0, False),
        "c": ("LocationID", "int", 1, 0, 0, False),
    }
    with pytest.raises(ValueError, match="no column"):
        quality.key_types({"a": (one, "zone")})


def test_too_many_categories_are_an_error(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("Boro"))
    with pytest.raises(ValueError, match="more than 20"):
        traffic.onehot_borough(df, most=20)
    assert len(traffic.onehot_borough(df, most=50).columns) == 51


# --- jobs and sinks ------------------------------------------------------------------------------------------------------------


def test_jobs_append_their_row_counts(spark, tmp_path):
    row = ("2024-01-01 00:00:00", "2024-01-01 00:30:00", "1", "2", "3", "4", "0", "0", "5")
    raw, out, audit = (str(tmp_path / x) for x in ("raw", "out", "audit"))
    writers.write_csv(spark.createDataFrame([row] * 5 + [("x", *row[1:])] * 3, schemas.RAW_FHV), raw)
    for _ in range(2):
        jobs.run(spark, "clean_fhv", [f"raw={raw}", f"out={out}", f"audit={audit}"])
    seen = read_audit(spark, audit).collect()
    assert sorted((r.job, r.side, r.dataset, r.rows) for r in seen) == sorted([("clean_fhv", "in", raw, 8), ("clean_fhv", "out", out, 5)] * 2)
    assert len({r.run for r in seen}) == 2
    assert spark.read.parquet(out).count() == 5
    jobs.run(spark, "clean_fhv", [f"raw={raw}", f"out={out}"])
    assert read_audit(spark, audit).count() == 4


def test_a_dataset_that_was_not_read_has_no_count(spark, monkeypatch):
    monkeypatch.setattr("metropulse.plans.audit.PATIENCE", 0.2)
    audit = Audit("job")
    audit.watch(spark.range(3), "in", "a")
    audit.watch(spark.range(4), "out", "b").count()
    assert [(r[2], r[3], r[4]) for r in audit.rows()] == [("in", "a", None), ("out", "b", 4)]


def test_repeated_writes_leave_every_row_once(spark):
    days, runs = shared_folder(spark, "days"), shared_folder(spark, "runs")
    table = spark.createDataFrame([(i, f"2024-01-0{1 + i % 3}") for i in range(30)], "n int, day string")
    for part in (table, table.where("day = '2024-01-02'"), table.where("day = '2024-01-02' and n < 9")):
        writers.write_days(part, days, ["day"])
    left = {str(r.day): r["count"] for r in spark.read.parquet(days).groupBy("day").count().collect()}
    assert left == {"2024-01-01": 10, "2024-01-02": 3, "2024-01-03": 10}
    for run, rows in (("a/1", table), ("b", table.limit(4)), ("a/1", table)):
        writers.append_run(rows, runs, run)
    assert readers.read_csv(spark, runs, "n INT, day STRING").count() == 34


def test_a_named_sample_can_be_repeated(spark, tmp_path):
    pages, out = tmp_path / "pages", str(tmp_path / "out")
    pages.mkdir()
    (pages / "1.json").write_text('[{"pickup_datetime": "2023-02-07T23:59:00.000"}, {"pickup_datetime": "2023-02-08T00:00:00.000"}]')
    for name in ("may", "june", "may"):
        jobs.run(spark, "sample_fhv", [f"pages={pages}", f"out={out}", f"run={name}"])
    assert readers.read_csv(spark, out, schemas.RAW_FHV).count() == 2


def test_sql_functions_equal_the_column_rules(spark):
    register_functions(spark)
    texts = ["  o'brien 42nd-st\t", "WEST end", "", None, "école ñandú", "a1b c"]
    spark.createDataFrame([(t,) for t in texts], "t string").createOrReplaceTempView("texts")
    from metropulse.functions.labels import title_case

    got = spark.sql("SELECT t, title_text(t) AS title FROM texts").withColumn("want", title_case(F.col("t"))).collect()
    assert all(r.title == r.want for r in got) and got[0].title == "O'Brien 42Nd-St"
    plan = spark.sql("SELECT part_of_day(hour(h.timestamp)) FROM (SELECT TIMESTAMP_NTZ'2024-01-01' a) e, LATERAL event_hours(e.a, e.a) h")
    assert "Python" not in plan._jdf.queryExecution().toString()
