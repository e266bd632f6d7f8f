"""Exact quantiles by linear interpolation, weighted by row counts, without one task per group.

Values are first collapsed to (group, value, n). A collapsed table of modest measured size goes through
Spark's ``percentile`` with ``n`` as frequency. A larger one is sorted into ranges; the row count of each
range tells which range holds each wanted rank, and only those ranges are ranked, each in its own task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metropulse.operators.staging import ONE_TASK_ROWS, Settled, join_sized, range_parts, settle


def histogram(df: DataFrame, by: Sequence[str], value: str, weight: str | None = None) -> Settled:
    """Rows per (``by``, ``value``) as column ``n``; missing values stay as a row of their own."""
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    return settle(df.groupBy(*by, value).agg(rows.alias("n")), "histogram")


def quantiles(
    hist: Settled,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    aggs: Sequence[Column] = (),
    max_rows: int = ONE_TASK_ROWS,
) -> DataFrame:
    """One row per group: ``by``, ``aggs`` and the array column ``quantiles`` (null when nothing is known)."""
    if hist.rows <= max_rows:
        wanted = F.percentile(F.col(value).cast("double"), F.array(*map(F.lit, probs)), F.col("n"))
        return hist.df.groupBy(*by).agg(*aggs, wanted.alias("quantiles"))
    ranked = _by_rank(hist.df, by, value, probs)
    if not aggs:
        return ranked
    if not by:
        return hist.df.agg(*aggs).withColumn("quantiles", ranked.scalar())
    return hist.df.groupBy(*by).agg(*aggs).join(ranked, list(by), "left")


def _by_rank(hist: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    by = list(by)
    known = hist.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias(value), "n")
    laid = range_parts(known, [F.col(c) for c in [*by, value]], "ranges")

    # One row per group and range: bounded by groups + ranges, however large the groups are.
    parts = laid.groupBy(*by, "part").agg(F.sum("n").alias("size"))
    before = F.sum("size").over(Window.partitionBy(*by).orderBy("part")) - F.col("size")
    total = F.sum("size").over(Window.partitionBy(*by))
    parts = parts.select(*by, "part", "size", before.alias("before"), total.alias("total"))

    places = F.array(*[F.lit(float(p)) * (F.col("total") - 1) for p in probs])
    ranks = F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(F.floor(p), F.ceil(p)))))
    here = F.filter(ranks, lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("size")))
    targets = parts.withColumn("ranks", here).where(F.size("ranks") > 0).drop("size")

    hits = join_sized(laid, targets, [*by, "part"], "inner", "targets")
    upto = F.col("before") + F.sum("n").over(Window.partitionBy(*by, "part").orderBy(value))
    hits = hits.withColumn("upto", upto)
    covered = F.filter("ranks", lambda r: (r >= F.col("upto") - F.col("n")) & (r < F.col("upto")))
    hits = hits.select(*by, "total", value, F.explode(covered).alias("rank"))

    # At most two ranks per probability and group.
    found = hits.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", value))).alias("at"), F.max("total").alias("total")
    )

    def interpolate(place: Column) -> Column:
        low, high = F.floor(place), F.ceil(place)
        value_low, value_high = F.element_at("at", low), F.element_at("at", high)
        between = (high - place) * value_low + (place - low) * value_high
        return F.when(low == high, value_low).otherwise(between)

    return found.select(*by, F.transform(places, interpolate).alias("quantiles"))
