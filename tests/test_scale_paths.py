"""The ways taken beyond the size limits give the results of the small ways and of brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from metropulse.operators import events as ev
from metropulse.operators import impact, matching, quantiles, staging
from metropulse.operators.numbering import numbered
from metropulse.plans.bridge import Feeds
from test_oracle import SF_DIR


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one value of one group."""
    rng = random.Random(7)
    rows = [("hot", 5.0)] * 1000
    rows += [(rng.choice(["hot", "b", "c"]), round(rng.gauss(0, 50), 2)) for _ in range(2000)]
    rows += [("b", None), ("empty", None)]
    return spark.createDataFrame(rows, "g string, v double"), rows


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_quantiles_by_group(skewed, max_rows):
    df, rows = skewed
    probs = [0.0, 0.25, 0.5, 0.9995, 1.0]
    groups = defaultdict(list)
    for g, v in rows:
        if v is not None:
            groups[g].append(v)
    hist = quantiles.histogram(df, ["g"], "v")
    found = quantiles.quantiles(hist, ["g"], "v", probs, [F.sum("n").alias("rows")], max_rows)
    got = {r.g: r for r in found.collect()}
    assert got["empty"].quantiles is None and got["b"].rows == len(groups["b"]) + 1
    for g, values in groups.items():
        assert got[g].quantiles == pytest.approx(list(np.quantile(values, probs)))


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_quantile_of_everything(skewed, max_rows):
    df, rows = skewed
    hist = quantiles.histogram(df, [], "v")
    (row,) = quantiles.quantiles(hist, [], "v", [0.1, 0.77], max_rows=max_rows).collect()
    assert row.quantiles == pytest.approx(list(np.quantile([v for _, v in rows if v is not None], [0.1, 0.77])))


@pytest.mark.parametrize("max_rows", [0, 10**6])
def test_numbers_follow_the_order(spark, max_rows):
    values = list(range(500)) + [None]
    random.Random(3).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    got = numbered(df, [F.asc_nulls_last("v")], "id", max_rows).orderBy("id").collect()
    assert [r.id for r in got] == list(range(1, 502))
    assert [r.v for r in got] == [*range(500), None]


@pytest.mark.parametrize("hot_rows", [3, 10**6])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join(spark, how, hot_rows):
    """Key 1 is hot on both sides, key 5 on the right by equal rows, key 3 is missing there."""
    left = spark.createDataFrame([(1, i) for i in range(200)] + [(2, 1), (3, 1), (5, 1), (5, 1), (None, 1)], "k int, a int")
    rows = [(1, f"x{i % 4}") for i in range(20)] + [(5, "same")] * 10 + [(2, "z"), (None, "n"), (9, "w")]
    right = spark.createDataFrame(rows, "k int, b string")
    want = sorted(map(str, left.join(right, ["k"], how).collect()))
    for limit in (-1, 10**9):
        got = staging.join_sized(left, right, ["k"], how, max_bytes=limit, hot_rows=hot_rows)
        assert sorted(map(str, got.collect())) == want
    with pytest.raises(ValueError):
        staging.salted_join(left, staging.settle(right, "full"), ["k"], "full")


def test_only_hot_keys_are_copied(spark):
    """1,000 equal rows of one key spread over its salts; side rows of any other key are there once."""
    left = staging.settle(spark.createDataFrame([(1, "same")] * 1000 + [(k, "x") for k in range(2, 50)], "k int, a string"), "left")
    side = staging.settle(spark.createDataFrame([(k, f"s{k}") for k in range(40)] + [(39, f"t{i}") for i in range(400)], "k int, b string"), "side")
    hot = staging.hot_keys(left, side, ["k"], 100)
    assert {tuple(r) for r in hot.df.collect()} == {(1, 10, 1), (39, 1, 5)}
    ours, theirs = staging.spread(left, side, ["k"], hot.df)
    salts = [r["count"] for r in ours.where("k = 1").groupBy("_salt").count().collect()]
    assert len(salts) == 10 and sum(salts) == 1000 and max(salts) < 160
    copies = {r.k: r["count"] for r in theirs.groupBy("k").count().collect()}
    assert copies == {1: 10, 39: 401}
    joined = staging.salted_join(left, side, ["k"], "left", 100)
    assert joined.count() == 1000 + 401 + 47


def test_without_a_shared_folder_only_local_sessions_work(spark):
    assert staging.shared_folder(spark, "a").split("/metropulse/")[0] == staging.shared_folder(spark, "b").split("/metropulse/")[0]

    class Elsewhere:
        conf = spark.conf

        class sparkContext:
            applicationId, master = "app-elsewhere", "local-cluster[2,1,1024]"

    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(RuntimeError, match="checkpoint"):
            staging.shared_folder(Elsewhere, "a")


def test_settled_sizes(spark):
    found = staging.settle(spark.createDataFrame([("abc", 1), (None, 2)], "t string, n int"), "sizes")
    assert (found.rows, found.bytes) == (2, 2 * 16 + 3)
    assert found.df.count() == 2
    assert staging.settle(spark.range(0), "empty").rows == 0


def rounded(df):
    floats = {c for c, t in df.dtypes if t == "double"}
    columns = sorted(df.columns)
    cells = [[round(r[c], 9) + 0.0 if c in floats and r[c] is not None else r[c] for c in columns] for r in df.collect()]
    return sorted(map(str, cells))


@pytest.fixture(scope="module")
def feeds(spark):
    return Feeds(spark, SF_DIR)


@pytest.fixture(scope="module")
def matched(feeds):
    return staging.settle(feeds.traffic_events_mlb, "matched").df


REPORTS = {
    "type": (impact.impact_by_type, ["event_type"]),
    "event": (impact.impact_by_event, ["event_id", "event_name"]),
    "matrix": (impact.impact_type_hour_matrix, ["event_type"]),
    "box": (impact.box_stats_by_type, ["event_type"]),
    "density": (impact.kde_event_vs_none, ["event_type"]),
    "day": (lambda df, weight=None: impact.day_vs_baseline(df, "2024-01-05", weight=weight), []),
}


@pytest.mark.parametrize("name", REPORTS)
def test_weighted_reports_equal_row_reports(feeds, matched, name):
    report, fields = REPORTS[name]
    assert rounded(report(feeds.matches(*fields), weight="n")) == rounded(report(matched))


def test_reports_beyond_one_task(feeds, matched):
    for report in (impact.impact_by_type, impact.impact_by_event, impact.box_stats_by_type):
        assert rounded(report(matched, max_rows=0)) == rounded(report(matched))


def test_matches_without_broadcast(feeds, matched, monkeypatch):
    join = staging.join_sized

    def never_broadcast(left, right, on, how="left", label="side"):
        return join(left, right, on, how, label, max_bytes=-1, hot_rows=50)

    monkeypatch.setattr(matching, "join_sized", never_broadcast)
    monkeypatch.setattr(ev, "join_sized", never_broadcast)
    met = ev.traffic_event_impact(ev.traffic_baseline(feeds.features), feeds.events_hourly)
    plain = ev.traffic_events_mlb(met, feeds.mlb_hourly).select(matched.columns)
    assert rounded(plain) == rounded(matched)
    assert rounded(impact.impact_by_type(feeds.matches("event_type"), "n")) == rounded(impact.impact_by_type(matched))
