"""Profiles of a table and coverage of a join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from metropulse.functions.values import number, ratio
from metropulse.operators.quantiles import histogram, quantiles
from metropulse.operators.staging import ONE_TASK_ROWS


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows of ``df`` while something else runs it; read the count from the observation afterwards."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def profile_schema(df: DataFrame) -> DataFrame:
    """Column, type and table size: one row per column."""
    kinds = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type")) for c, t in df.dtypes])
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select("n_rows", F.lit(len(df.columns)).alias("n_columns"), F.inline(kinds))


QUARTERS = [0.25, 0.5, 0.75]


def profile_numeric(
    df: DataFrame, cols: Sequence[str], approx: bool = False, max_rows: int = ONE_TASK_ROWS
) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of each column.

    Exact quartiles shuffle every distinct value; ``approx`` keeps to one pass over continuous columns
    at the price of Spark's rank error.
    """
    numbers = df.select(*[number(c).alias(c) for c in cols])
    long = numbers.unpivot([], list(cols), "column", "value")
    value = F.col("value")
    if approx:
        figures = [F.count("value"), F.avg("value"), F.stddev_samp("value"), F.min("value"), F.max("value")]
        named = [f.alias(c) for f, c in zip(figures, ("count", "mean", "std", "min", "max"), strict=True)]
        found = long.groupBy("column").agg(*named, F.percentile_approx("value", QUARTERS).alias("quantiles"))
    else:
        # The source is read once: everything follows from its distinct values and their counts.
        hist = histogram(long, ["column"], "value")
        known = F.when(value.isNotNull(), F.col("n"))
        mean = ratio(F.sum(value * F.col("n")), F.sum(known))
        means = hist.df.groupBy("column").agg(mean.alias("mean"))  # a row per column
        centred = hist.df.join(F.broadcast(means), "column")
        squares = F.sum(F.col("n") * F.pow(value - F.col("mean"), F.lit(2)))
        spread = centred.groupBy("column").agg(F.sqrt(ratio(squares, F.sum(known) - 1)).alias("std"))
        aggs = [F.coalesce(F.sum(known), F.lit(0)).alias("count"), mean.alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")]
        found = quantiles(hist, ["column"], "value", QUARTERS, aggs, max_rows).join(F.broadcast(spread), "column", "left")
    quarters = [F.get("quantiles", F.lit(i)).alias(c) for i, c in enumerate(("p25", "p50", "p75"))]
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")  # an empty table has its columns too
    joined = F.broadcast(every).join(found, "column", "left").fillna(0, ["count"])
    return joined.select("column", "count", "mean", "std", "min", *quarters, "max")


def profile_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column; NaN counts as missing."""
    cols = list(cols or df.columns)
    kinds = dict(df.dtypes)

    def missing(c: str):
        gone = F.col(f"`{c}`").isNull()
        return gone | F.isnan(f"`{c}`") if kinds[c] in ("double", "float") else gone

    counts = df.agg(*[F.count_if(missing(c)).alias(c) for c in cols])
    return counts.unpivot([], cols, "column", "n_null")


def profile_distinct(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct known values per column."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in cols]).unpivot([], list(cols), "column", "n_distinct")


def key_types(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """How a key looks in each of several sources: its column (found in any case), type, rows, missing values, values that are no
    whole number, and differs: at most half of the sources have its type, so joins on it convert or miss.

    ``sources`` gives each source's table and key column. Each table is read once, for its key only.
    """
    rows = []
    for source, (df, wanted) in sources.items():
        column = next((c for c in df.columns if c.lower() == wanted.lower()), None)
        if column is None:
            raise ValueError(f"{source} has no column {wanted}; found {df.columns}")
        key = F.col(f"`{column}`")
        whole = number(f"`{column}`")
        readable = whole.isNotNull() & (whole == F.floor(whole))
        counts = df.select(key.alias("key"), readable.alias("readable")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("key").isNull()).alias("n_null"),
            F.count_if(F.col("key").isNotNull() & ~F.col("readable")).alias("n_unreadable"),
        )
        kind = F.lit(dict(df.dtypes)[column]).alias("type")
        rows.append(counts.select(F.lit(source).alias("source"), F.lit(column).alias("column"), kind, "*"))
    together = reduce(DataFrame.unionByName, rows)
    same = F.count(F.lit(1)).over(Window.partitionBy("type"))  # a row per source
    return together.withColumn("differs", 2 * same <= len(rows))


def value_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first."""
    rows = df if keep_null else df.dropna(subset=[col])
    counts = rows.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_last("value"))


def audit_zone_join(fhv: DataFrame, ylc: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips per borough and the share of all trips whose zone the lookup does not map."""
    zones = [df.select(F.col("pulocationid").try_cast("bigint").alias("pulocationid")) for df in (fhv, ylc)]
    per_zone = zones[0].unionByName(zones[1]).groupBy("pulocationid").agg(F.count(F.lit(1)).alias("n"))
    known = lookup.select(F.col("LocationID").cast("bigint").alias("pulocationid"), "Borough")
    per_borough = per_zone.join(known, "pulocationid", "left").groupBy("Borough").agg(F.sum("n").alias("n"))
    # The windows run over one row per borough.
    all_rows = Window.partitionBy(F.lit(1))
    unmatched = F.coalesce(F.sum(F.when(F.col("Borough").isNull(), F.col("n"))).over(all_rows), F.lit(0))
    total = F.sum("n").over(all_rows)
    totals = per_borough.select("Borough", "n", unmatched.alias("n_unmatched"), total.alias("n_total"))
    missing = F.try_divide(F.lit(100.0) * F.col("n_unmatched"), F.col("n_total"))
    return totals.withColumn("pct_unmatched", F.round(missing, 1))
