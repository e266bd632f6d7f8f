"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession


MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV directory; every part carries the header, so appended runs read back as one table."""
    stamps = {"timestampFormat": MICROSECONDS, "timestampNTZFormat": MICROSECONDS}
    df.write.mode(mode).options(header=True, **stamps).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet directory. Rows of a partition value are brought together first, so that not every task adds a
    file to every value; the adaptive planner splits a value that holds too many rows."""
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    gathered = df.hint("rebalance", *partition_by)
    gathered.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_days(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Parquet directory by partition; the partitions that ``df`` holds are replaced, the others stay. A job that is run again,
    for the same days or corrected ones, leaves every row once."""
    gathered = df.hint("rebalance", *partition_by)
    gathered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Add ``df`` to a CSV dataset as the part named ``run``. The same run again replaces its part, so repeating it after a
    failure adds nothing twice."""
    write_csv(df, f"{path.rstrip('/')}/run={quote(run, safe='')}")


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the text column ``value``, one document per line."""
    df.select("value").write.mode(mode).text(path)


def compact_parquet(spark: SparkSession, source: str, target: str, files: int | None = None) -> DataFrame:
    """Rewrite a directory of many parts as few. Without ``files`` the sizes follow
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a large dataset does not end in one file."""
    df = spark.read.parquet(source)
    packed = df.coalesce(files) if files else df.hint("rebalance")
    write_parquet(packed, target)
    return spark.read.schema(df.schema).parquet(target)
