"""Traffic volume counts: time and place, cleaning, features, profiles and hotspots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metropulse.functions.geo import is_point, lon_lat, point_xy
from metropulse.functions.labels import part_of_day, title_case
from metropulse.functions.values import group_known, round_even
from metropulse.operators.quantiles import histogram, quantiles

# Columns title-cased, boroughs in the spelling title-casing gives them, and feature columns.
TEXT_COLUMNS = ["Boro", "street", "fromSt", "toSt", "Direction"]
BOROUGHS = ["Bronx", "Brooklyn", "Manhattan", "Queens", "Staten Island"]
FEATURES = [
    "timestamp",
    "mes_nombre",
    "dia_semana",
    "hora_entera",
    "momento_dia",
    "Vol",
    "latitude",
    "longitude",
    "Boro",
    "street",
    "fromSt",
    "toSt",
    "Direction",
    "SegmentID",
    "hour_sin",
    "hour_cos",
]


def traffic_time(raw: DataFrame, years: Sequence[int] = (2023, 2024)) -> DataFrame:
    """Counts of the wanted years with a timestamp built from their parts (null for an impossible date)."""
    parts = [F.col(c).try_cast("int") for c in ("Yr", "M", "D", "HH", "MM")]
    kept = raw.where(parts[0].isin(*years)) if "Yr" in raw.columns else raw
    return kept.withColumn("timestamp", F.try_make_timestamp_ntz(*parts, F.lit(0).cast("decimal(8,6)")))


def time_labels(ts: Column) -> dict[str, Column]:
    return {
        "hora_entera": F.hour(ts),
        "dia_semana": F.date_format(ts, "EEEE"),
        "mes_nombre": F.date_format(ts, "MMMM"),
    }


def wkt_point(df: DataFrame) -> DataFrame:
    x, y = point_xy(F.col("WktGeom"))
    return df.withColumns({"x": x, "y": y})


def geo_to_latlon(df: DataFrame) -> DataFrame:
    """Coordinates in degrees from ``WktGeom``; null where it holds no point."""
    longitude, latitude = lon_lat(F.col("x"), F.col("y"))
    return wkt_point(df).withColumns({"longitude": longitude, "latitude": latitude}).drop("x", "y")


def dated_points(raw: DataFrame, years: Sequence[int] = (2023, 2024)) -> DataFrame:
    """Counts of the wanted years with a possible date and a readable place."""
    return traffic_time(raw, years).where(F.col("timestamp").isNotNull() & is_point(F.col("WktGeom")))


def traffic_outlier_filter(df: DataFrame, p: float = 0.9995) -> DataFrame:
    """Known, non-negative volumes strictly below their own ``p`` quantile."""
    valid = df.where("Vol >= 0")
    return valid.where(F.col("Vol") < volume_quantile(valid, p))


def volume_quantile(df: DataFrame, p: float, weight: str | None = None) -> Column:
    """Quantile of ``Vol`` as a scalar subquery."""
    found = quantiles(histogram(df, [], "Vol", weight), [], "Vol", [p])
    return found.select(F.get("quantiles", F.lit(0))).scalar()


#: A table with more columns than this is better kept long.
MOST_FLAGS = 1000


def one_hot_values(df: DataFrame, column: str, most: int = MOST_FLAGS) -> list[str]:
    """The distinct values of a category column, one new column each; more than ``most`` are an error, found without
    bringing them to the driver."""
    found = [r[0] for r in df.select(column).dropna().distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values; give those wanted, or raise the limit")
    return sorted(found)


def onehot_borough(
    df: DataFrame, values: Sequence[str] | None = None, column: str = "Boro", most: int = MOST_FLAGS
) -> DataFrame:
    """A 0/1 column ``<column>_<value>`` per value; without ``values`` one per value found, ``most`` of them."""
    values = one_hot_values(df, column, most) if values is None else values
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("tinyint") for v in values}
    return df.withColumns(flags) if flags else df


def traffic_features(
    raw: DataFrame,
    boroughs: Sequence[str] | None = None,
    years: Sequence[int] = (2023, 2024),
    p: float = 0.9995,
) -> DataFrame:
    """Clean counts with place, text, time and model features."""
    kept = wkt_point(traffic_outlier_filter(dated_points(raw, years), p))
    longitude, latitude = lon_lat(F.col("x"), F.col("y"))
    hour = F.hour("timestamp")
    angle = F.lit(2 * math.pi) * hour / 24
    made = kept.withColumns(
        {
            "longitude": longitude,
            "latitude": latitude,
            "momento_dia": part_of_day(hour),
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
            **time_labels(F.col("timestamp")),
            **{c: title_case(F.col(c)) for c in TEXT_COLUMNS if c in kept.columns},
        }
    )
    made = made.select([c for c in FEATURES if c in made.columns])
    return onehot_borough(made, boroughs) if "Boro" in made.columns else made


def traffic_segment_hour(features: DataFrame) -> DataFrame:
    """Average day of every counting segment."""
    keys = ["SegmentID", "hora_entera", "street", "Boro", "latitude", "longitude"]
    return group_known(features, keys).agg(round_even(F.avg("Vol"), 0).alias("Vol"))


def traffic_hotspots(features: DataFrame, p: float = 0.5) -> DataFrame:
    """Mean volume per place over the counts above the ``p`` quantile."""
    busy = features.where(F.col("Vol") > volume_quantile(features, p))
    return group_known(busy, ["latitude", "longitude"]).agg(F.avg("Vol").alias("vol"))


def traffic_borough_hour(features: DataFrame) -> DataFrame:
    return group_known(features, ["hora_entera", "Boro"]).agg(F.avg("Vol").alias("vol"))


def heat_points(hotspots: DataFrame) -> DataFrame:
    """Hotspots as [latitude, longitude, weight] arrays for a heat layer, one row each."""
    return hotspots.select(F.array("latitude", "longitude", "vol").alias("point"))
