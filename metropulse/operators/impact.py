"""Reports on how events change traffic.

Every report reads traffic-event rows and takes either plain rows or weighted rows (``weight`` names the
count column). Rows are first collapsed to (group, change, n), so hot groups combine before the shuffle.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metropulse.functions.values import group_known, ratio
from metropulse.operators.quantiles import histogram, quantiles
from metropulse.operators.staging import ONE_TASK_ROWS, join_sized, settle

CHANGE = "pct_change_vs_baseline"
# Whisker reach of a box plot, and the usual kernel-density grid.
WHISKER_IQR = 1.5
GRID_POINTS = 200
GRID_CUT = 3
KERNEL_REACH = 39
#: Bins between the least and the greatest change, and the steepest curvature of the normal density.
DENSITY_BINS = 1 << 14
KERNEL_CURVATURE = 1 / math.sqrt(2 * math.pi)


def _weighted_mean(value: str, n: str = "n") -> Column:
    known = F.when(F.col(value).isNotNull(), F.col(n))
    return ratio(F.sum(F.col(value) * F.col(n)), F.sum(known))


def _known_count() -> Column:
    return F.coalesce(F.sum(F.when(F.col(CHANGE).isNotNull(), F.col("n"))), F.lit(0))


def _weighed(df: DataFrame, weight: str | None) -> DataFrame:
    return df.withColumn("n", F.col(weight) if weight else F.lit(1).cast("bigint"))


def impact_by_type(df: DataFrame, weight: str | None = None, max_rows: int = ONE_TASK_ROWS) -> DataFrame:
    hist = histogram(df.where("event_type is not null"), ["event_type"], CHANGE, weight)
    aggs = [
        _weighted_mean(CHANGE).alias("mean"),
        F.max(CHANGE).alias("max"),
        _known_count().alias("count"),
    ]
    found = quantiles(hist, ["event_type"], CHANGE, [0.5], aggs, max_rows)
    return found.select("event_type", "mean", F.get("quantiles", F.lit(0)).alias("median"), "max", "count")


def impact_by_event(df: DataFrame, weight: str | None = None, max_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Summary per event id, repeated for each name the id carries. ``count`` counts rows, the rest known changes."""
    identified = df.where("event_id is not null")
    hist = histogram(identified, ["event_id", "event_name"], CHANGE, weight)
    named = hist.df.select("event_id", "event_name").distinct()
    merged = histogram(hist.df, ["event_id"], CHANGE, "n")
    aggs = [
        F.sum("n").alias("count"),
        _weighted_mean(CHANGE).alias("mean_impact"),
        F.max(CHANGE).alias("max_impact"),
    ]
    found = quantiles(merged, ["event_id"], CHANGE, [0.5], aggs, max_rows)
    found = found.select(
        "event_id",
        "count",
        "mean_impact",
        F.get("quantiles", F.lit(0)).alias("median_impact"),
        "max_impact",
    )
    return found.join(named, "event_id", "left")


_TIES = ["event_id", "event_name"]


def top_events(summary: DataFrame, n: int = 20) -> DataFrame:
    return summary.orderBy(F.desc_nulls_last("max_impact"), *map(F.asc_nulls_last, _TIES)).limit(n)


def bottom_events(summary: DataFrame, n: int = 10) -> DataFrame:
    return summary.orderBy(F.asc_nulls_last("max_impact"), *map(F.asc_nulls_last, _TIES)).limit(n)


def extreme_events(summary: DataFrame, hi: int = 50, lo: int = 10) -> DataFrame:
    """The strongest increases and decreases together; an event in both lists stays twice."""
    both = top_events(summary, hi).unionByName(bottom_events(summary, lo))
    return both.orderBy(F.asc_nulls_last("max_impact"), *map(F.asc_nulls_last, _TIES))


def day_vs_baseline(
    df: DataFrame, day: dt.date | str, boro: str | None = None, weight: str | None = None
) -> DataFrame:
    """Mean volume and mean baseline by hour of one calendar day, written as a range so that it reaches the scan."""
    start = dt.datetime.combine(dt.date.fromisoformat(str(day)), dt.time())
    first, after = (F.lit(t.isoformat()).cast("timestamp_ntz") for t in (start, start + dt.timedelta(days=1)))
    rows = df.where((F.col("timestamp") >= first) & (F.col("timestamp") < after))
    if boro:
        rows = rows.where(F.col("Boro") == boro)
    means = [_weighted_mean(c).alias(c) for c in ("Vol", "baseline_vol")]
    return group_known(_weighed(rows, weight), ["hora_entera"]).agg(*means)


def impact_type_hour_matrix(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean change per event type, one column per hour of day (null where nothing was seen)."""
    cells = group_known(_weighed(df, weight), ["event_type", "hora_entera"]).agg(_weighted_mean(CHANGE).alias("m"))
    wide = cells.groupBy("event_type").pivot("hora_entera", list(range(24))).agg(F.first("m"))
    return wide.withColumnsRenamed({str(h): f"h{h}" for h in range(24)})


def box_stats_by_type(df: DataFrame, weight: str | None = None, max_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Quartiles, whiskers at the furthest values within 1.5 interquartile ranges, and rows beyond them."""
    known = df.where(F.col("event_type").isNotNull() & F.col(CHANGE).isNotNull())
    hist = histogram(known, ["event_type"], CHANGE, weight)
    found = quantiles(hist, ["event_type"], CHANGE, [0.25, 0.5, 0.75], max_rows=max_rows)
    boxes = found.select(
        "event_type", *[F.get("quantiles", F.lit(i)).alias(c) for i, c in enumerate(("q1", "median", "q3"))]
    )
    value, reach = F.col(CHANGE), WHISKER_IQR * (F.col("q3") - F.col("q1"))
    low, high = F.col("q1") - reach, F.col("q3") + reach
    beyond = (value < low) | (value > high)
    rows = join_sized(hist.df, boxes, ["event_type"], "inner", "boxes")
    return rows.groupBy("event_type", "q1", "median", "q3").agg(
        F.least(F.min(F.when(value >= low, value)), "q1").alias("whisker_lo"),
        F.greatest(F.max(F.when(value <= high, value)), "q3").alias("whisker_hi"),
        F.coalesce(F.sum(F.when(beyond, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )


def kde_event_vs_none(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Gaussian density of the change with and without an event, each normalised on its own.

    Scott's bandwidth and 200 grid points reaching three bandwidths past the data. Equal changes
    are collapsed first; every distinct change then adds its kernel to the grid points it reaches, summed on
    the map side. Beyond 39 bandwidths a kernel is exactly zero in double precision, so with many rows, whose
    bandwidth is narrow, a change touches a few points instead of all.
    """
    known = df.where(F.col(CHANGE).isNotNull()).withColumn("has_event", F.col("event_type").isNotNull())
    hist = histogram(known, ["has_event"], CHANGE, weight)
    value, n = F.col(CHANGE), F.col("n")
    centre = hist.df.groupBy("has_event").agg(
        F.sum("n").cast("double").alias("rows"),
        _weighted_mean(CHANGE).alias("mean"),
        F.min(value).alias("least"),
        F.max(value).alias("most"),
    )
    # Two rows at most, one per truth value.
    centred = hist.df.join(F.broadcast(centre), "has_event")
    squares = F.sum(n * F.pow(value - F.col("mean"), F.lit(2)))
    spread = centred.groupBy("has_event", "rows", "least", "most").agg(squares.alias("squares"))
    width = F.sqrt(ratio(F.col("squares"), F.col("rows") - 1)) * F.pow("rows", F.lit(-0.2))
    grid = spread.withColumn("bw", width).where("bw > 0").select(
        "has_event",
        "rows",
        "bw",
        (F.col("least") - GRID_CUT * F.col("bw")).alias("first"),
        ((F.col("most") - F.col("least") + 2 * GRID_CUT * F.col("bw")) / (GRID_POINTS - 1)).alias("step"),
    )
    last = GRID_POINTS - 1
    reach = KERNEL_REACH * F.col("bw")
    nearest = F.greatest(F.lit(0), F.ceil((value - reach - F.col("first")) / F.col("step")))
    furthest = F.least(F.lit(last), F.floor((value + reach - F.col("first")) / F.col("step")))
    touched = F.when(nearest <= furthest, F.sequence(nearest, furthest))
    points = hist.df.join(F.broadcast(grid), "has_event").withColumn("i", F.explode(touched))
    z = (F.col("first") + F.col("i") * F.col("step") - value) / F.col("bw")
    sums = points.groupBy("has_event", "i").agg(F.sum(n * F.exp(-z * z / 2)).alias("kernels"))

    every = grid.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(last)).cast("array<bigint>")))
    scale = F.col("rows") * F.col("bw") * F.sqrt(2 * F.pi())
    return every.join(sums, ["has_event", "i"], "left").select(
        "has_event",
        (F.col("first") + F.col("i") * F.col("step")).alias("x"),
        (F.coalesce("kernels", F.lit(0.0)) / scale).alias("density"),
    )


def kde_binned(df: DataFrame, weight: str | None = None, bins: int = DENSITY_BINS) -> DataFrame:
    """As ``kde_event_vs_none``, from ``bins`` counts per group instead of every distinct change, with error_bound.

    A change between two bin edges counts at both, nearer edge more (linear binning), so a kernel is replaced by its chord over
    one bin: the density is off by at most ``step^2 / 8 * curvature / bandwidth^3``, which is error_bound. Each row adds to one
    of the sums of its bin on the map side; what is left is ``GRID_POINTS`` x bins evaluations however many rows there are.
    Rows are read twice, for the extremes and for the bins.
    """
    known = _weighed(df, weight).where(F.col(CHANGE).isNotNull())
    known = known.select(F.col("event_type").isNotNull().alias("has_event"), F.col(CHANGE).alias("v"), "n")
    mean = ratio(F.sum(F.col("v") * F.col("n")), F.sum("n"))
    ends = known.groupBy("has_event").agg(
        F.sum("n").cast("double").alias("rows"), mean.alias("mean"), F.min("v").alias("least"), F.max("v").alias("most")
    )
    # Two rows at most, one per truth value.
    ends = settle(ends, "density-ends").df.where("most > least")
    placed = known.join(F.broadcast(ends), "has_event")
    place = (F.col("v") - F.col("least")) * bins / (F.col("most") - F.col("least"))
    edge = F.floor(place)
    placed = placed.withColumns({"edge": edge, "share": place - edge, "far": F.pow(F.col("v") - F.col("mean"), F.lit(2))})
    sums = placed.groupBy("has_event", "edge").agg(
        F.sum((1 - F.col("share")) * F.col("n")).alias("here"),
        F.sum(F.col("share") * F.col("n")).alias("next"),
        F.sum(F.col("far") * F.col("n")).alias("squares"),
    )
    # From here on there are no more than 2 x (bins + 1) rows.
    sums = settle(sums, "density-bins").df
    spread = sums.groupBy("has_event").agg(F.sum("squares").alias("squares")).join(F.broadcast(ends), "has_event")
    width = F.sqrt(ratio(F.col("squares"), F.col("rows") - 1)) * F.pow("rows", F.lit(-0.2))
    grid = spread.withColumn("bw", width).where("bw > 0").select(
        "has_event",
        "rows",
        "bw",
        "least",
        ((F.col("most") - F.col("least")) / bins).alias("step"),
        (F.col("least") - GRID_CUT * F.col("bw")).alias("first"),
        ((F.col("most") - F.col("least") + 2 * GRID_CUT * F.col("bw")) / (GRID_POINTS - 1)).alias("stride"),
    )
    ends_of = [F.struct((F.col("edge") + i).alias("edge"), F.col(c).alias("w")) for i, c in enumerate(("here", "next"))]
    at_edges = sums.select("has_event", F.explode(F.array(*ends_of)).alias("e"))
    weights = at_edges.groupBy("has_event", F.col("e.edge").alias("edge")).agg(F.sum("e.w").alias("w")).where("w > 0")
    every = grid.withColumn("x", F.explode(F.transform(F.sequence(F.lit(0), F.lit(GRID_POINTS - 1)), lambda i: F.col("first") + i * F.col("stride"))))
    z = (F.col("x") - F.col("least") - F.col("edge") * F.col("step")) / F.col("bw")
    scale = F.col("rows") * F.col("bw") * F.sqrt(2 * F.pi())
    bound = F.pow("step", F.lit(2)) / 8 * KERNEL_CURVATURE / F.pow("bw", F.lit(3))
    summed = every.join(F.broadcast(weights), "has_event").groupBy("has_event", "x", scale.alias("scale"), bound.alias("error_bound"))
    return summed.agg(F.sum(F.col("w") * F.exp(-z * z / 2)).alias("k")).select(
        "has_event", "x", (F.col("k") / F.col("scale")).alias("density"), "error_bound"
    )
