"""Consecutive numbers in sort order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metropulse.operators.staging import ONE_TASK_ROWS, join_sized, range_parts, settle


def numbered(df: DataFrame, order: Sequence[Column], name: str, max_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """Add BIGINT ``name`` = 1, 2, 3, ... along ``order``.

    A measured small table takes a plain window. Otherwise rows are laid out in ranges, numbered within
    their range and shifted by the rows of the ranges before.
    """
    whole = settle(df, "to-number")
    if whole.rows <= max_rows:
        place = F.row_number().over(Window.orderBy(*order))
        return whole.df.withColumn(name, place.cast("bigint"))
    laid = range_parts(whole.df, order, "numbering")
    sizes = laid.groupBy("part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("part")) - F.col("_size")
    starts = sizes.select("part", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    shifted = join_sized(laid.withColumn("_within", within), starts, ["part"], "inner", "starts")
    return shifted.withColumn(name, F.col("_before") + F.col("_within")).drop("part", "_before", "_within")
