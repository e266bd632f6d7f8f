"""Calendar expressions on zone-free timestamps; none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_hour(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def minutes_between(start: Column, end: Column) -> Column:
    seconds = (end - start).cast("interval day to second").cast("interval second").cast("decimal(18,6)")
    return seconds.cast("double") / 60


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def utc_to_local(ts: Column, zone: str) -> Column:
    """Zone-free wall clock of ``zone`` for a zone-free UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)
