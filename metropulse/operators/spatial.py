"""Boroughs: mapping of trips, shares of traffic and demand, city rhythm, and map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metropulse.functions.values import group_known, ratio
from metropulse.operators.trips import SERVICE_TITLES

# The borough left out of the comparisons, category labels and drawing style.
UNKNOWN = "Unknown"
TRAFFIC_TITLE = "Tráfico"
TRAFFIC_TITLE_TOTAL = "Tráfico (% del total)"
DEMAND_TITLE_TOTAL = "Demanda Total (% del total)"
STYLE = {"color": "black", "weight": 0.3, "fillColor": "#08306b"}
MAX_OPACITY = 0.8
SLIDER_DAY = "2023-01-01"


def demand_with_borough(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips with the borough of their pickup zone, null where the lookup has none.

    The lookup is a file, so the planner knows its size: it broadcasts below
    ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffle join with skew splitting above.
    """
    zones = lookup.select(F.col("LocationID").cast("bigint").alias("LocationID"), "Borough")
    return trips.join(zones, trips["pulocationid"] == zones["LocationID"], "left")


def demand_by_hour_service(trips: DataFrame) -> DataFrame:
    return group_known(trips, ["hora_entera", "tipo_servicio"]).agg(F.count(F.lit(1)).alias("viajes"))


def city_rhythm(traffic: DataFrame, trips: DataFrame) -> DataFrame:
    """Mean traffic and trips per service for each hour of day."""
    volume = group_known(traffic, ["hora_entera"]).agg(F.avg("Vol").alias("vol_mean"))
    hire, taxi = (F.count_if(F.col("tipo_servicio") == title) for title in SERVICE_TITLES)
    demand = group_known(trips, ["hora_entera"]).agg(hire.alias("trips_fhv"), taxi.alias("trips_ylc"))
    return volume.join(demand, "hora_entera", "full")


def _share(part: Column, whole: Column) -> Column:
    return (ratio(part, whole) * 100).alias("Porcentaje")


def _traffic_share(traffic: DataFrame, title: str) -> DataFrame:
    # The window runs over one row per borough, not over traffic.
    sums = group_known(traffic, ["Boro"]).agg(F.sum("Vol").alias("vol"))
    everything = F.sum("vol").over(Window.partitionBy(F.lit(1)))
    return sums.select(F.col("Boro").alias("Borough"), _share(F.col("vol"), everything), F.lit(title).alias("Tipo"))


def _counts_by_borough(trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips per borough and service, counted per zone before the lookup; borough null where unmapped."""
    per_zone = trips.groupBy("pulocationid", "tipo_servicio").agg(F.count(F.lit(1)).alias("n"))
    return demand_with_borough(per_zone, lookup).groupBy("Borough", "tipo_servicio").agg(F.sum("n").alias("n"))


def _known_boroughs(shares: DataFrame) -> DataFrame:
    return shares.where(F.col("Borough") != UNKNOWN)


def borough_share_detailed(traffic: DataFrame, trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Share of each borough in traffic and in each service; a service's total includes unmapped trips."""
    counts = _counts_by_borough(trips, lookup)
    of_service = F.sum("n").over(Window.partitionBy("tipo_servicio"))
    demand = counts.select("Borough", _share(F.col("n"), of_service), F.col("tipo_servicio").alias("Tipo"))
    return _known_boroughs(_traffic_share(traffic, TRAFFIC_TITLE).unionByName(demand))


def borough_share_total(traffic: DataFrame, trips: DataFrame, lookup: DataFrame) -> DataFrame:
    """Share of each borough in traffic and in all demand; the demand total holds mapped trips only."""
    counts = group_known(_counts_by_borough(trips, lookup), ["Borough"]).agg(F.sum("n").alias("n"))
    mapped = F.sum("n").over(Window.partitionBy(F.lit(1)))
    demand = counts.select("Borough", _share(F.col("n"), mapped), F.lit(DEMAND_TITLE_TOTAL).alias("Tipo"))
    return _known_boroughs(_traffic_share(traffic, TRAFFIC_TITLE_TOTAL).unionByName(demand))


# The columns kept of a zone table, as far as it has them.
PLACE_NAMES = ["zone", "borough", "service_zone"]
ZONE_COLUMNS = [*PLACE_NAMES, "geometry"]


def with_location_id(zones: DataFrame) -> DataFrame:
    """Zones with their id column spelled ``LocationID``, whatever its case in the source."""
    found = next((c for c in zones.columns if c.lower() == "locationid"), None)
    if found is None:
        raise ValueError(f"zones need a LocationID column; found {zones.columns}")
    return zones.withColumnRenamed(found, "LocationID").withColumn("LocationID", F.col("LocationID").cast("bigint"))


def features_zone_hour(by_zone_hour: DataFrame, zones: DataFrame, metric: str = "ratio") -> DataFrame:
    """Every zone in each of the 24 hours with its demand (0 when none) and fill opacity for a time slider."""
    measures = ["FHV", "YLC", "ratio"]
    if metric not in measures:
        raise ValueError(f"metric must be one of {measures}")
    places = with_location_id(zones)
    for name in ZONE_COLUMNS:  # in any case, like the id
        found = next((c for c in places.columns if c.lower() == name), name)
        places = places.withColumnRenamed(found, name)
    extra = [c for c in ZONE_COLUMNS if c in places.columns]
    slots = places.select("LocationID", *extra, F.explode(F.sequence(F.lit(0), F.lit(23))).alias("pickup_hour"))
    filled = slots.join(by_zone_hour.select("LocationID", "pickup_hour", *measures), ["LocationID", "pickup_hour"], "left")
    filled = filled.fillna(0, measures)
    # A window over the zones of an hour, so that the trips behind them are read once for every metric.
    top = F.max(metric).over(Window.partitionBy("pickup_hour"))
    opacity = F.least(F.lit(MAX_OPACITY), ratio(F.col(metric), top + 1))
    stamp = F.concat(F.lit(f"{SLIDER_DAY}T"), F.lpad(F.col("pickup_hour").cast("string"), 2, "0"), F.lit(":00:00"))
    shown = filled.withColumns({"time": stamp, "fill_opacity": opacity})
    return shown.select("LocationID", *extra, "pickup_hour", "time", *measures, "fill_opacity")


def feature_json(features: DataFrame) -> DataFrame:
    """One GeoJSON-style feature per row as text in column ``value``, ready for a text sink."""
    style = F.struct(*[F.lit(v).alias(k) for k, v in STYLE.items()], F.col("fill_opacity").alias("fillOpacity"))
    shown = [c for c in (*PLACE_NAMES, "pickup_hour", "FHV", "YLC") if c in features.columns]
    popup = F.struct(*shown, F.round("ratio", 2).alias("ratio"))
    geometry = F.col("geometry") if "geometry" in features.columns else F.lit(None).cast("string")
    shape = F.try_parse_json(geometry)  # any kind of geometry, as it came
    properties = F.struct("LocationID", "time", style.alias("style"), popup.alias("popup"))
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), properties.alias("properties"))
    return features.select(F.to_json(feature).alias("value"))
