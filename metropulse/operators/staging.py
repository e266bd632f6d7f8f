"""Stage boundaries on shared storage, and joins whose broadcast is checked by size.

``settle`` writes an intermediate to the shared checkpoint folder and reads it back. That cuts the lineage
(an executor lost later re-reads files instead of recomputing the source scan) and tells the exact row
and byte count, counted while writing, before the next plan is chosen.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

BROADCAST_BYTES = 64 * 1024 * 1024
ONE_TASK_ROWS = 1_000_000
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Settled:
    df: DataFrame
    rows: int
    bytes: int


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="metropulse-")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path, grouped by application, under the folder named by ``spark.checkpoint.dir``. A local session, whose tasks
    all run on this machine, may leave it unset; on a cluster that is an error."""
    run = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _own_folder(run)
    return f"{base.rstrip('/')}/metropulse/{run}/{label}-{uuid.uuid4().hex}"


def _bytes(value: Column, kind: DataType) -> Column:
    none = F.lit(0).cast("bigint")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value).cast("bigint"), none)
    if isinstance(kind, MapType):
        return _bytes(F.map_keys(value), ArrayType(kind.keyType)) + _bytes(F.map_values(value), ArrayType(kind.valueType))
    if isinstance(kind, StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind), none)
    if isinstance(kind, ArrayType):
        words = F.coalesce(8 * F.array_size(value).cast("bigint"), none)
        if not isinstance(kind.elementType, (StringType, BinaryType, MapType, StructType, ArrayType)):
            return words
        inner = F.aggregate(value, none, lambda acc, x: acc + _bytes(x, kind.elementType))
        return words + F.coalesce(inner, none)
    return none


def _width(df: DataFrame) -> Column:
    """Rough bytes of a row: a word per column, plus text, binary and nested values by what they hold."""
    fields = df.schema.fields
    words = F.lit(8 * len(fields)).cast("bigint")
    return sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in fields), words)


def settle(df: DataFrame, label: str) -> Settled:
    path = shared_folder(df.sparkSession, label)
    seen = Observation(label)
    measured = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_width(df)), F.lit(0)).alias("bytes")
    )
    measured.write.parquet(path)
    return Settled(df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"], seen.get["bytes"])


def hot_keys(left: Settled, side: Settled, on: Sequence[str], hot_rows: int = HOT_ROWS) -> Settled:
    """Keys with more than ``hot_rows`` rows on either side, and into how many salts (``_salts``, of the left rows) and parts
    (``_parts``, of the side's rows) each is cut. No more keys than rows / ``hot_rows`` of both sides together."""

    def pieces(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
        return counts.dropna(subset=list(on)).select(*on, F.ceil(F.col("_rows") / hot_rows).cast("bigint").alias(name))

    both = pieces(left.df, "_salts").join(pieces(side.df, "_parts"), list(on), "full").fillna(1, ["_salts", "_parts"])
    return settle(both, "hot-keys")


def spread(left: Settled, side: Settled, on: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of hot keys on both sides, ready to join on (``on``, ``_salt``, ``_part``).

    A left row takes a salt by its place (file and row number, the same on every attempt of a task, different for equal rows)
    and is copied per part; a side row takes a part by its place and is copied per salt.
    """
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    wanted = F.broadcast(hot)

    def upto(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    ours = left.df.withColumn("_place", place).join(wanted, list(on))
    ours = ours.withColumn("_salt", F.pmod("_place", "_salts")).withColumn("_part", upto("_parts"))
    theirs = side.df.withColumn("_place", place).join(wanted, list(on))
    theirs = theirs.withColumn("_part", F.pmod("_place", "_parts")).withColumn("_salt", upto("_salts"))
    return ours.drop("_place", "_salts"), theirs.drop("_place", "_salts", "_parts")


def salted_join(
    left: DataFrame | Settled, side: Settled, on: Sequence[str], how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left or inner join in three parts: hot keys spread over salts and parts, the others shuffled as they are, left rows with a
    missing key not joined at all. Only rows of hot keys are copied.

    ``left`` is settled first, for its keys are counted, and rows are told apart by their places in the files.
    """
    if how not in ("left", "inner"):
        raise ValueError("only left and inner joins can be spread")
    on = list(on)
    whole = left if isinstance(left, Settled) else settle(left, "spread-left")
    hot = hot_keys(whole, side, on, hot_rows)
    known = whole.df.dropna(subset=on)
    others = side.df
    if hot.rows:
        wanted = F.broadcast(hot.df.select(*on))
        known, others = known.join(wanted, on, "left_anti"), others.join(wanted, on, "left_anti")
    joined = known.join(others, on, how)
    if hot.rows:
        ours, theirs = spread(whole, side, on, hot.df)
        met = ours.join(theirs.withColumn("_met", F.lit(True)), [*on, "_salt", "_part"], how)
        # A key with several parts is in ``side``, so a copy that met nothing met its rows in another part.
        met = met.where((F.col("_parts") == 1) | F.col("_met"))
        joined = joined.unionByName(met.drop("_salt", "_part", "_parts", "_met"))
    if how == "left":
        lost = whole.df.where(~F.expr(" and ".join(f"`{c}` is not null" for c in on)))
        joined = joined.unionByName(lost, allowMissingColumns=True)
    return joined


def join_sized(
    left: DataFrame,
    right: DataFrame | Settled,
    on: Sequence[str],
    how: str = "left",
    label: str = "side",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a big ``left`` to a ``right`` of unknown size: broadcast it when its measured size allows, else spread hot keys.

    Without the measurement the planner would see an aggregate or exploded side only as big as its
    input and shuffle ``left`` for nothing.
    """
    side = right if isinstance(right, Settled) else settle(right, label)
    if side.bytes <= max_bytes:
        return left.join(F.broadcast(side.df), list(on), how)
    return salted_join(left, side, on, how, hot_rows)


def range_parts(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Settle ``df`` sorted into contiguous ranges; ``part`` numbers the ranges in sort order."""
    laid = df.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    return settle(laid, label).df
