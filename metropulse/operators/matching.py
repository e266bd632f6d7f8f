"""Event matches of traffic in weighted form.

A traffic row meets every event and game of its hour and borough, and the reports average over those
pairs. Reports do not need the pairs themselves: equal traffic rows of a cell collapse to one row with a
count, events of a cell collapse by the fields the report uses, and the counts multiply. The result
carries the number of pairs in ``n`` and gives every report the same figures as the row-by-row match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metropulse.functions.labels import title_case
from metropulse.functions.times import floor_hour
from metropulse.functions.values import group_known, ratio
from metropulse.operators.events import BASELINE_KEYS, with_change
from metropulse.operators.staging import join_sized, settle
from metropulse.operators.traffic import dated_points, time_labels, volume_quantile

CELL = ["timestamp", "Boro"]


def traffic_cells(raw: DataFrame, years: Sequence[int] = (2023, 2024), p: float = 0.9995) -> DataFrame:
    """Equal traffic rows counted in ``n``, with hour, weekday and baseline.

    The raw counts are read once: rows valid for the features collapse to (time, borough, volume),
    and the outlier limit and the baseline follow from the collapsed table with ``n`` as weight. Volumes are
    whole numbers, so cells collapse well.
    """
    valid = dated_points(raw, years).where("Vol >= 0")
    counted = settle(valid.groupBy(*CELL, "Vol").agg(F.count(F.lit(1)).alias("n")), "cells").df
    kept = counted.where(F.col("Vol") < volume_quantile(counted, p, "n"))
    labelled = kept.withColumns({"Boro": title_case(F.col("Boro")), **time_labels(F.col("timestamp"))})
    mean = ratio(F.sum(F.col("Vol") * F.col("n")), F.sum("n"))
    baseline = group_known(labelled, BASELINE_KEYS).agg(mean.alias("baseline_vol"))
    return join_sized(labelled, baseline, BASELINE_KEYS, "left", "cell-baseline")


def weighted_matches(
    cells: DataFrame, events_hourly: DataFrame, mlb_hourly: DataFrame, fields: Sequence[str]
) -> DataFrame:
    """Cells matched with events, then games filling missing ``fields``; ``n`` counts the pairs. The hours of events and games
    come from ``event_hours_at``, which makes those that meet a cell, or are all hours."""
    fields = list(fields)
    per_cell = events_hourly.groupBy(*CELL, *fields).agg(F.count(F.lit(1)).alias("_events"))
    met = join_sized(cells, per_cell, CELL, "left", "events-by-cell")
    met = met.withColumn("n", F.col("n") * F.coalesce("_events", F.lit(1))).drop("_events")

    # A row that lacks a field needs the games themselves; any other row only their number.
    lacking = F.lit(False)
    for f in fields:
        lacking = lacking | F.col(f).isNull()
    met = met.withColumns({"timestamp": floor_hour(F.col("timestamp")), "_lacking": lacking})

    games = mlb_hourly.withColumn("timestamp", floor_hour(F.col("timestamp")))
    numbers = games.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_games")).withColumn("_lacking", F.lit(False))
    detail = games.groupBy(*CELL, *fields).agg(F.count(F.lit(1)).alias("_games")).withColumn("_lacking", F.lit(True))
    detail = detail.withColumnsRenamed({f: f"{f}_mlb" for f in fields})
    either = detail.unionByName(numbers, allowMissingColumns=True) if fields else numbers

    full = join_sized(met, either, [*CELL, "_lacking"], "left", "games-by-cell")
    filled = {f: F.coalesce(F.col(f), F.col(f"{f}_mlb")) for f in fields}
    filled["n"] = F.col("n") * F.coalesce("_games", F.lit(1))
    return with_change(full.withColumns(filled).drop("_games", "_lacking", *[f"{f}_mlb" for f in fields]))
