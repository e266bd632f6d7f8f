"""Incremental for-hire cleaning, and hourly demand as it arrives.

Both stop once the files present at the start are done (``availableNow``) and continue from their
checkpoint next time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from metropulse.functions.times import floor_hour
from metropulse.functions.values import moment
from metropulse.operators.trips import clean_fhv


def stream_fhv(
    spark: SparkSession, folder: str, schema: str | StructType, kind: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Landed trips as a stream. ``files_per_batch`` bounds a batch when a large backlog waits; results do not depend on it."""
    reader = spark.readStream.schema(schema).format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def _append(df: DataFrame, target: str, checkpoint: str) -> list[tuple[int, int, int]]:
    """Rows read and written by batch, as (batch, in, out)."""
    counted = df.observe("written", F.count(F.lit(1)).alias("rows"))
    query = (
        counted.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    done = [p for p in query.recentProgress if p["observedMetrics"].get("written") is not None]
    return [(p["batchId"], p["numInputRows"], p["observedMetrics"]["written"].rows) for p in done]


def stream_clean_fhv(
    raw: DataFrame, target: str, checkpoint: str, counts: list[tuple[int, int, int]] | None = None
) -> DataFrame:
    """Append the cleaned form of newly landed trips to ``target``; the rules are those of the batch job. ``counts`` receives the rows
    of each batch before and after, as (batch, in, out)."""
    told = _append(clean_fhv(raw), target, checkpoint)
    if counts is not None:
        counts += told
    return raw.sparkSession.read.parquet(target)


#: Batches between two sums of everything so far.
FOLD_EVERY = 100


def _counted(target: str, spark: SparkSession, keys: Sequence[str], kinds: dict[str, str]) -> DataFrame:
    """All partial counts in ``target`` with the first and last batch that each holds."""
    columns = ["datetime_hour timestamp_ntz", *[f"`{k}` {kinds[k]}" for k in keys], "n bigint", "first bigint", "last bigint"]
    return spark.read.schema(", ".join(columns)).parquet(target)


def _spans(parts: DataFrame) -> list[tuple[int, int]]:
    """The spans of batches that no longer span holds: one row per batch since the last sum, and the sum."""
    found = {(r.first, r.last) for r in parts.select("first", "last").distinct().collect()}
    return [s for s in found if not any(o != s and o[0] <= s[0] and s[1] <= o[1] for o in found)]


def _of_spans(parts: DataFrame, spans: list[tuple[int, int]]) -> DataFrame:
    held = F.lit(False)
    for first, last in spans:
        held = held | ((F.col("first") == first) & (F.col("last") == last))
    return parts.where(held)


def land_counts(
    batch: DataFrame, batch_id: int, target: str, keys: Sequence[str] = (), fold_every: int = FOLD_EVERY
) -> None:
    """Write the counts of one batch (datetime_hour and ``keys``) as the partition of its number.

    The partition is overwritten, so a batch that is run again after a failure leaves what it left before. Every ``fold_every``
    batches the counts so far are summed into one partition, which from then on stands for all of them.
    """
    spark, groups = batch.sparkSession, ["datetime_hour", *keys]
    counts = batch.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(f"{target}/first={batch_id}/last={batch_id}")
    if (batch_id + 1) % fold_every == 0:
        parts = _counted(target, spark, keys, dict(batch.dtypes))
        # A sum of an earlier run of this batch is left out, and made again.
        own = parts.where((F.col("last") < batch_id) | (F.col("first") == batch_id) & (F.col("last") == batch_id))
        total = _of_spans(own, _spans(own)).groupBy(*groups).agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{target}/first=0/last={batch_id}")


def hourly_demand(spark: SparkSession, target: str, keys: Sequence[str] = (), kinds: dict[str, str] | None = None) -> DataFrame:
    """Trips per hour (and ``keys``, of the types ``kinds``) over the batches landed so far."""
    parts = _counted(target, spark, keys, kinds or {})
    return _of_spans(parts, _spans(parts)).groupBy("datetime_hour", *keys).agg(F.sum("n").alias("FHV"))


def stream_hourly_demand(
    raw: DataFrame, target: str, checkpoint: str, keys: Sequence[str] = (), fold_every: int = FOLD_EVERY
) -> DataFrame:
    """Trips per hour (and ``keys``) over everything landed so far, equal to the batch job however late or out of order trips
    arrive.

    Each batch is counted as it comes and adds a row per hour it holds, so the target has at most hours x batches rows; no trip
    is stored and none is dropped as late. Batches are told apart by number: one that is run again replaces its counts.
    """
    spark = raw.sparkSession
    hours = raw.select(floor_hour(moment("pickup_datetime")).alias("datetime_hour"), *keys).where("datetime_hour is not null")
    kinds = dict(hours.dtypes)
    # Something to read even when no batch comes.
    none = spark.createDataFrame([], hours.schema).withColumn("n", F.lit(0).cast("bigint"))
    none.write.mode("overwrite").parquet(f"{target}/first=-1/last=-1")
    query = (
        hours.writeStream.foreachBatch(lambda batch, batch_id: land_counts(batch, batch_id, target, keys, fold_every))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return hourly_demand(spark, target, keys, kinds)
