"""Hourly weather: series from interval arrays, join to mobility, effect of rain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metropulse.functions.times import floor_hour, utc_to_local
from metropulse.functions.values import moment, number, ratio

# The weather variables and the measures compared between wet and dry hours.
WEATHER = ["temperature_2m", "precipitation", "rain", "snowfall", "snow_depth"]
RAIN_MEASURES = ["YLC", "FHV", "total", "market_share"]


def weather_series(responses: DataFrame) -> DataFrame:
    """One row per step from responses holding start, end (excluded), step and one array per variable.

    ``time_start``/``time_end`` are epoch seconds and ``interval_s`` the step.
    """
    steps = F.sequence(F.col("time_start"), F.col("time_end") - F.col("interval_s"), F.col("interval_s"))
    filled = responses.where("time_end > time_start and interval_s > 0").withColumn("time", steps)
    rows = filled.select(F.inline(F.arrays_zip("time", *WEATHER)))
    stamp = F.timestamp_seconds("time").cast("timestamp_ntz")
    return rows.select(stamp.alias("date"), *WEATHER)


def prepare_weather(weather: DataFrame, weather_tz: str | None = None) -> DataFrame:
    """Weather keyed by hour. Stamps are UTC and by default only lose their zone; ``weather_tz`` shifts them."""
    stamp = moment("date")
    if weather_tz:
        stamp = utc_to_local(stamp, weather_tz)
    return weather.select(floor_hour(stamp).alias("datetime_hour"), *[number(c).alias(c) for c in WEATHER])


def hourly_weather(
    mobility: DataFrame, weather: DataFrame, weather_tz: str | None = None, dedup_values: bool = True
) -> DataFrame:
    """Mobility with weather; hours without weather count as zeros.

    With ``dedup_values`` hours equal in every value collapse to the earliest one. Keeping the earliest
    is a ``min`` per distinct value row, so it combines before the shuffle.
    """
    joined = mobility.join(prepare_weather(weather, weather_tz), "datetime_hour", "left").fillna(0, WEATHER)
    if not dedup_values:
        return joined
    values = [c for c in joined.columns if c != "datetime_hour"]
    return joined.groupBy(*values).agg(F.min("datetime_hour").alias("datetime_hour")).select(joined.columns)


def rain_impact(hourly: DataFrame) -> DataFrame:
    """Percent difference of mean demand between rainy and dry hours; null when one kind is missing."""
    flag = F.when(F.col("precipitation") > 0, "Rain").otherwise("No Rain")

    def change(measure: str):
        wet, dry = (F.avg(F.when(F.col("rain_flag") == f, F.col(measure))) for f in ("Rain", "No Rain"))
        return (ratio(wet - dry, dry) * 100).alias(measure)

    changes = hourly.withColumn("rain_flag", flag).agg(*map(change, RAIN_MEASURES))
    return changes.unpivot([], RAIN_MEASURES, "variable", "percent_change")
