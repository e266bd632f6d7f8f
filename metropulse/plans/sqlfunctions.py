"""The rules for single rows as SQL functions, for those who write SQL.

They are expressions and subqueries that the optimizer inlines, so a query that calls them has the plan of the DataFrame job. The
bodies are made from the same ranges as the column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from metropulse.functions.labels import DAY_PART_OTHER, DAY_PARTS, MAP_SEGMENT_OTHER, MAP_SEGMENTS


def _label(hour: str, ranges: Sequence[tuple[str, int, int]], other: str) -> str:
    whens = " ".join(f"WHEN {hour} >= {first} AND {hour} < {after} THEN '{label}'" for label, first, after in ranges)
    return f"CASE {whens} ELSE '{other}' END"


_PLAIN = r"btrim(t, ' \t\n\r\f\u000b')"
_PAIR = r"[^\\p{L} ]\\p{L}"

FUNCTIONS = {
    "part_of_day(h INT) RETURNS STRING": _label("h", DAY_PARTS, DAY_PART_OTHER),
    "map_segment(h INT) RETURNS STRING": _label("h", MAP_SEGMENTS, MAP_SEGMENT_OTHER),
    "cyclic_sin(h INT) RETURNS DOUBLE": "sin(2 * pi() * h / 24)",
    "cyclic_cos(h INT) RETURNS DOUBLE": "cos(2 * pi() * h / 24)",
    "title_text(t STRING) RETURNS STRING": (
        rf"CASE WHEN {_PLAIN} RLIKE '{_PAIR}' THEN "
        rf"replace(initcap(regexp_replace({_PLAIN}, '([^\\p{{L}} ])(\\p{{L}})', '$1\u0001 $2')), '\u0001 ', '') "
        rf"ELSE initcap({_PLAIN}) END"
    ),
    "percent_over(v DOUBLE, base DOUBLE) RETURNS DOUBLE": "try_divide(v - base, base) * 100",
    "event_hours(started TIMESTAMP_NTZ, ended TIMESTAMP_NTZ) RETURNS TABLE (timestamp TIMESTAMP_NTZ)": (
        "SELECT explode(CASE WHEN ended >= started THEN sequence(started, ended, INTERVAL 1 HOUR) END)"
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Make the functions known to SQL in this session: part_of_day, map_segment, cyclic_sin, cyclic_cos, title_text,
    percent_over, and the table function event_hours for use after ``LATERAL``."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
