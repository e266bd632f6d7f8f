"""Profiles that add up: one small row per day and column, merged when the profile is read.

A row holds counts, moments, extremes, a HyperLogLog sketch of the distinct values and a KLL sketch of the order, so a day is scanned
once, for all columns together, and a profile of any span of days reads days x columns rows. Counts, mean, deviation and extremes are
exact. A quantile is a value whose rank is off by at most ``RANK_ERROR`` of the known rows, a distinct count by ``DISTINCT_ERROR`` of
itself (three standard errors; a few dozen distinct values are counted exactly).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metropulse.functions.values import number, ratio
from metropulse.sources.writers import write_days

KLL_K = 400
RANK_ERROR = 0.012
HLL_BITS = 12
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def sketch_profile(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group of ``by`` and column, from one scan. Unreadable text and NaN are missing."""
    kept = df.select(*by, *[number(c).alias(c) for c in cols])

    def figures(c: str) -> Column:
        value = F.col(f"`{c}`")
        known = F.count(value)
        return F.struct(
            F.lit(c).alias("column"),
            known.alias("known"),
            (F.count(F.lit(1)) - known).alias("missing"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * known).alias("squares"),
            F.min(value).alias("least"),
            F.max(value).alias("most"),
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), F.lit(HLL_BITS)).alias("distinct"),
            F.kll_sketch_agg_double(value, F.lit(KLL_K)).alias("order"),
        )

    return kept.groupBy(*by).agg(F.array(*map(figures, cols)).alias("figures")).select(*by, F.inline("figures"))


def merge_profiles(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile of all rows behind ``sketches`` per column (and ``by``): count, n_null, n_distinct, mean, std, min, quartiles, max."""
    keys = [*by, "column"]
    n = F.col("known")
    sums = sketches.groupBy(*keys).agg(
        F.sum("known").alias("count"),
        F.sum("missing").alias("n_null"),
        ratio(F.sum(F.col("mean") * n), F.sum(F.when(n > 0, n))).alias("mean"),
        F.min("least").alias("min"),
        F.max("most").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double(F.when(n > 0, F.col("order"))).alias("order"),
        F.collect_list(F.struct("known", "mean", "squares")).alias("parts"),
    )
    # Squares around the common mean, from those around each part's own: no large sums cancel.
    around = F.aggregate(
        F.filter("parts", lambda p: p["known"] > 0),
        F.lit(0.0),
        lambda total, p: total + p["squares"] + p["known"] * F.pow(p["mean"] - F.col("mean"), F.lit(2)),
    )
    std = F.sqrt(ratio(around, F.col("count") - 1))
    some = F.col("count") > 0
    quarters = [F.when(some, F.kll_sketch_get_quantile_double("order", F.lit(q))).alias(c) for c, q in QUANTILES.items()]
    return sums.select(*keys, "count", "n_null", "n_distinct", "mean", std.alias("std"), "min", *quarters, "max")


def update_profile(df: DataFrame, cols: Sequence[str], day: Column, target: str) -> None:
    """Write the sketches of the days in ``df`` below ``target``; a day that was there is replaced, the others stay."""
    write_days(sketch_profile(df.withColumn("day", day), cols, ["day"]), target, ["day"])


def read_profile(spark: SparkSession, target: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The profile of the days ``first`` to ``last`` (dates as text; open when not given). Other days are not read."""
    days = spark.read.parquet(target)
    for bound, inside in ((first, lambda d, b: d >= b), (last, lambda d, b: d <= b)):
        if bound:
            days = days.where(inside(F.col("day"), F.lit(bound).cast("date")))
    return merge_profiles(days)
