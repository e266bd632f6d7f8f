"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metropulse.operators.staging import settle


def _least(df: DataFrame) -> DataFrame:
    """For each ``u`` the least of its ``v`` and itself."""
    return df.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small(edges: DataFrame) -> DataFrame:
    least = _least(edges)
    up = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return up.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(pairs: DataFrame, label: str = "cc") -> DataFrame:
    """(node, component) for every node that a pair of two different nodes holds; component is the least node reachable.

    ``pairs`` has two columns. Each round is written to the shared folder; equal counts and sums of hashes before and
    after a round end the loop. No neighbour list is gathered: a node's edges meet only its minimum.
    """
    a, b = pairs.columns
    edges = pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    seen = None
    now = settle(edges.distinct(), label).df
    while True:
        now = settle(_small(_large(now)), label).df
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
