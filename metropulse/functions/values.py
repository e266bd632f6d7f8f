"""Lenient coercion and null-safe arithmetic.

Dirty text becomes null instead of an ANSI error, and NaN becomes null so that comparisons and averages
treat it as missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F


def number(name: str) -> Column:
    """Column as DOUBLE; unreadable text and NaN are null."""
    return F.nanvl(F.col(name).try_cast("double"), F.lit(None).cast("double"))


def whole(name: str) -> Column:
    """Column as BIGINT through the same coercion (text such as "7.0" is accepted)."""
    return number(name).try_cast("bigint")


def moment(name: str, *patterns: str) -> Column:
    """Column as zone-free timestamp; a stated UTC offset is dropped, not applied."""
    parsed = [F.col(name).try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(F.col(name), F.lit(p)).cast("timestamp_ntz") for p in patterns]
    return F.coalesce(*parsed)


def ratio(top: Column, bottom: Column) -> Column:
    """Division where a zero or missing denominator gives null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def percent_over(value: Column, base: Column) -> Column:
    """Percentage by which ``value`` exceeds ``base``; null for a zero base."""
    return ratio(value - base, base) * 100


def round_even(value: Column, digits: int) -> Column:
    """Round half to even after scaling, the way numeric Python arrays round."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def group_known(df: DataFrame, keys: Sequence[str]) -> GroupedData:
    """``groupBy`` that leaves rows with a missing key out."""
    return df.dropna(subset=list(keys)).groupBy(*keys)
