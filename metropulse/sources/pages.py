"""Landed API pages read by the time they cover.

A page index holds a row per page file: its size, change time, and the first and last readable time of its rows. It is filled from new
or changed pages only, each read once. A scan for some days then opens the pages whose times meet them and no others, which
the page files themselves, named in order of landing, do not allow.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metropulse.functions.values import moment
from metropulse.sources.readers import read_json_pages

INDEX = "page string, size bigint, changed timestamp, first timestamp_ntz, last timestamp_ntz, rows bigint"
Span = tuple[dt.datetime, dt.datetime]


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """The pages below ``folder``; their contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return listed.select(F.col("_metadata.file_path").alias("page"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def read_index(spark: SparkSession, index: str) -> DataFrame:
    """The latest entry of every page."""
    latest = F.row_number().over(Window.partitionBy("page").orderBy(F.desc("changed"), F.desc("size")))
    return spark.read.schema(INDEX).parquet(index).withColumn("_age", latest).where("_age = 1").drop("_age")


def update_index(spark: SparkSession, folder: str, index: str, schema: str, stamp: str) -> int:
    """Enter pages that are new or have changed, and return how many. Unreadable times do not count; a page without a readable
    one is entered without times. Running it again enters nothing."""
    spark.createDataFrame([], INDEX).write.mode("ignore").parquet(f"{index}/run=none")
    known = spark.read.schema(INDEX).parquet(index).select("page", "size", "changed")
    fresh = _files(spark, folder).join(known, ["page", "size", "changed"], "left_anti")
    names = [r.page for r in fresh.select("page").collect()]  # a name per new page, as Spark's own file listing holds
    if not names:
        return 0
    rows = read_json_pages(spark, names, schema).select(F.col("_metadata.file_path").alias("page"), moment(stamp).alias("t"))
    times = rows.groupBy("page").agg(F.min("t").alias("first"), F.max("t").alias("last"), F.count(F.lit(1)).alias("rows"))
    entries = fresh.join(times, "page", "left").select("page", "size", "changed", "first", "last", F.coalesce("rows", F.lit(0)).alias("rows"))
    entries.write.parquet(f"{index}/run={uuid.uuid4().hex}")
    return len(names)


def first_weeks(year: int, days: int = 7) -> list[Span]:
    """The first ``days`` days of every month, as half-open spans."""
    months = [dt.datetime(year, m, 1) for m in range(1, 13)]
    return [(m, min(m + dt.timedelta(days=days), (m + dt.timedelta(days=31)).replace(day=1))) for m in months]


def pages_between(spark: SparkSession, index: str, spans: Sequence[Span]) -> list[str]:
    """The pages with times in any of ``spans``."""
    entries, meets = read_index(spark, index), F.lit(False)
    for first, after in spans:
        low, high = (F.lit(t.isoformat()).cast("timestamp_ntz") for t in (first, after))
        meets = meets | ((F.col("first") < high) & (F.col("last") >= low))
    return [r.page for r in entries.where(meets).select("page").collect()]


def read_pages(spark: SparkSession, index: str, schema: str, stamp: str, spans: Sequence[Span]) -> DataFrame:
    """The rows whose time lies in any of ``spans``, from the pages that can hold one."""
    names = pages_between(spark, index, spans)
    if not names:
        return spark.createDataFrame([], schema)
    inside = F.lit(False)
    for first, after in spans:
        low, high = (F.lit(t.isoformat()).cast("timestamp_ntz") for t in (first, after))
        inside = inside | ((moment(stamp) >= low) & (moment(stamp) < high))
    return read_json_pages(spark, names, schema).where(inside)
