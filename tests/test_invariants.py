"""Properties that hold for any input."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metropulse.operators import events as ev
from metropulse.operators import trips
from metropulse.plans.bridge import Feeds
from test_oracle import SF_DIR


@pytest.fixture(scope="module")
def feeds(spark):
    return Feeds(spark, SF_DIR)


def test_counts_survive_every_rollup(feeds):
    n = feeds.trips.count()
    for df in (feeds.zone_hour, trips.segment_zone(feeds.zone_hour)):
        assert df.agg(F.sum(F.col("FHV") + F.col("YLC"))).first()[0] == n
    assert feeds.zone_hour.where("total <> FHV + YLC or market_share < 0 or market_share > 1").count() == 0
    hourly = feeds.mobility.agg(F.sum("total")).first()[0]
    assert hourly == feeds.fhv.count() + feeds.ylc.count()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(-600, 6000)), min_size=1, max_size=20))
def test_event_hours_are_whole_hours_plus_one(spark, spans):
    base = dt.datetime(2023, 1, 1)
    rows = [(i, base + dt.timedelta(minutes=s), base + dt.timedelta(minutes=s + n)) for i, (s, n) in enumerate(spans)]
    made = spark.createDataFrame(rows, "event_id bigint, start_time timestamp_ntz, end_time timestamp_ntz")
    made = made.withColumns({c: F.lit("x") for c in ("event_name", "event_type", "event_borough")})
    got = {r.event_id: r["count"] for r in ev.expand_events_hourly(made).groupBy("event_id").count().collect()}
    assert got == {i: n // 60 + 1 for i, (_, n) in enumerate(spans) if n >= 0}


def test_every_traffic_row_keeps_at_least_one_match(feeds):
    plain, matched = feeds.baseline.count(), feeds.traffic_event_impact
    assert matched.count() >= plain
    assert feeds.matches().agg(F.sum("n")).first()[0] == feeds.traffic_events_mlb.count()
