"""What the physical plans must and must not hold."""

import contextlib
import io

import pytest

from metropulse.operators import impact, spatial
from metropulse.plans.bridge import YEAR, Feeds
from metropulse.plans.registry import queries
from metropulse.sources import readers
from test_oracle import SF_DIR


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def feeds(spark):
    return Feeds(spark, SF_DIR)


@pytest.mark.parametrize("key", ["zone_hour", "hourly_weather", "traffic_features", "traffic_events_mlb", "impact_by_event"])
def test_no_python_in_the_plan(spark, key):
    text = plan(queries()[key](spark, SF_DIR))
    assert "Python" not in text and "CartesianProduct" not in text


def test_first_week_reaches_the_scan(feeds):
    text = plan(readers.sample_first_week(feeds.table("events").select("event_id", "ts"), "ts", YEAR))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_trips_read_only_what_demand_needs(feeds):
    text = plan(feeds.zone_hour)
    assert "props" not in text and text.count("Exchange") <= 2


def test_small_lookup_is_broadcast_by_its_size(feeds):
    assert "BroadcastHashJoin" in plan(spatial.demand_with_borough(feeds.titled, feeds.lookup))


def test_measured_sides_are_broadcast(feeds):
    text = plan(feeds.traffic_events_mlb)
    assert text.count("BroadcastHashJoin LeftOuter") >= 3 and "SortMergeJoin" not in text


def test_reports_of_the_top_sort_only_what_they_keep(feeds):
    summary = impact.impact_by_event(feeds.matches("event_id", "event_name"), "n")
    assert "TakeOrderedAndProject" in plan(impact.top_events(summary))


def test_windows_run_on_aggregates_only(feeds):
    text = plan(spatial.borough_share_detailed(feeds.features, feeds.titled, feeds.lookup))
    assert text.index("Window") < text.index("HashAggregate")
