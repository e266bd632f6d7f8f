"""Bucket labels and text clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label, first hour, first hour after it. Hours outside every range take the last label.
DAY_PARTS = [
    ("Mañana", 6, 12),
    ("Tarde", 12, 17),
    ("Noche", 17, 22),
]
DAY_PART_OTHER = "Madrugada"
MAP_SEGMENTS = [
    ("Primera mañana", 5, 8),
    ("Hora pico mañana", 8, 11),
    ("Mediodía", 11, 16),
    ("Regreso a casa", 16, 21),
]
MAP_SEGMENT_OTHER = "Noche / Madrugada"


def hour_label(hour: Column, ranges: Sequence[tuple[str, int, int]], other: str) -> Column:
    labelled = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, first, after in ranges:
        labelled = labelled.when((hour >= first) & (hour < after), label)
    return labelled.otherwise(other)


def part_of_day(hour: Column) -> Column:
    return hour_label(hour, DAY_PARTS, DAY_PART_OTHER)


def map_segment(hour: Column) -> Column:
    return hour_label(hour, MAP_SEGMENTS, MAP_SEGMENT_OTHER)


def stripped(text: Column) -> Column:
    """Remove white space of any kind from both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(" \t\n\r\f\v"))


_GAP = "\u0001 "


def title_case(text: Column) -> Column:
    """Capital after every non-letter, the rest lower: "o'brien 42nd-st" gives "O'Brien 42Nd-St".

    ``initcap`` starts words at spaces only, so a marked space goes between another non-letter and the letter
    after it and is taken out again afterwards. Most texts have no such pair and skip the rewriting.
    """
    plain = stripped(text)
    parted = F.regexp_replace(plain, r"([^\p{L} ])(\p{L})", f"$1{_GAP}$2")
    joined = F.replace(F.initcap(parted), F.lit(_GAP), F.lit(""))
    return F.when(plain.rlike(r"[^\p{L} ]\p{L}"), joined).otherwise(F.initcap(plain))
