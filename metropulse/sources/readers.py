"""Scans of landed files."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from metropulse.functions.values import moment
from metropulse.sources import schemas

# Lookup cells with one of these texts are missing.
MISSING_TEXTS = ["", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null", "#N/A", "#NA", "<NA>"]
# Fixed value: no JSON text holds it, in any Unicode encoding, for control characters are escaped.
NEVER_IN_JSON = "\0\0\0\0"


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str, null_value: str = "", optional: Sequence[str] = ()
) -> DataFrame:
    """CSV with a header, read by column name in any case and order; columns the schema does not name are left out.

    Malformed cells become null. A missing column is an error unless it is ``optional`` (then null), and so are parts whose
    headers differ. Splits of large files are read in parallel.
    """
    reader = spark.read.option("header", True).option("nullValue", null_value)
    names = reader.csv(path).columns
    texts = StructType([StructField(n, StringType()) for n in names])
    wanted = StructType.fromDDL(schema)
    held = {n.strip().lstrip("\ufeff").lower(): n for n in names}
    missing = [f.name for f in wanted if f.name.lower() not in held and f.name not in optional]
    if missing:
        raise ValueError(f"no column {missing} in {path}; found {names}")
    # Without enforcement the header of every part is checked against these names.
    raw = reader.schema(texts).option("enforceSchema", False).csv(path)

    def cell(field: StructField) -> Column:
        found = held.get(field.name.lower())
        value = F.col(f"`{found}`") if found else F.lit(None).cast("string")
        return value.try_cast(field.dataType).alias(field.name)

    return raw.select(*map(cell, wanted))


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    lookup = read_csv(spark, path, schemas.ZONE_LOOKUP)
    texts = [c for c, t in lookup.dtypes if t == "string"]
    return lookup.withColumns({c: F.when(~F.col(c).isin(MISSING_TEXTS), F.col(c)) for c in texts})


def read_parquet(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet file or directory of parts; only ``columns`` are read when given."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def read_json_pages(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Landed API pages, each file one array of objects; absent keys are null. One page is one task's work.

    A page is a single record up to a separator that never comes, so it is parsed from memory. With ``multiLine`` every number that
    a text column takes would be fetched from the file once more, with a block of checksummed bytes around it.
    """
    return spark.read.schema(schema).option("lineSep", NEVER_IN_JSON).json(path)


def read_schedule(spark: SparkSession, path: str | list[str], one_per_line: bool = False) -> DataFrame:
    """Nested game schedules: one document per file, or one per line."""
    return spark.read.schema(schemas.SCHEDULE).option("multiLine", not one_per_line).json(path)


def _between(ts: Column, first: dt.datetime, after: dt.datetime) -> Column:
    low, high = (F.lit(t.isoformat()).cast("timestamp_ntz") for t in (first, after))
    return (ts >= low) & (ts < high)


def sample_first_week(df: DataFrame, ts_col: str, year: int = 2023, days: int = 7) -> DataFrame:
    """The first ``days`` days of every month of ``year``, as half-open ranges that reach the Parquet scan.

    A text column is read leniently; unreadable times are outside every range.
    """
    stamp = moment(ts_col) if dict(df.dtypes)[ts_col] == "string" else F.col(ts_col)
    weeks = []
    for month in range(1, 13):
        first = dt.datetime(year, month, 1)
        last = min(days, calendar.monthrange(year, month)[1])
        weeks.append(_between(stamp, first, first + dt.timedelta(days=last)))
    return df.where(reduce(or_, weeks))


def first_days(df: DataFrame, ts_col: str, days: int = 7) -> DataFrame:
    """Rows on the first ``days`` days of any month and year."""
    return df.where(F.dayofmonth(F.col(ts_col)).between(1, days))
