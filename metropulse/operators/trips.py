"""Taxi (YLC) and for-hire (FHV) trips: cleaning, common shape, demand by zone, hour and day segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metropulse.functions.labels import map_segment
from metropulse.functions.times import floor_hour, minutes_between
from metropulse.functions.values import group_known, moment, number, ratio, round_even, whole

SERVICES = ("FHV", "YLC")
SERVICE_TITLES = ("Uber/FHV", "Taxi Amarillo")  # fixed values: the labels used in the borough reports

# Measured columns of the two sources.
FHV_NUMBERS = [
    "pulocationid",
    "dolocationid",
    "trip_miles",
    "base_passenger_fare",
    "tolls",
    "tips",
    "driver_pay",
]
YLC_NUMBERS = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "tip_amount",
    "tolls_amount",
    "congestion_surcharge",
    "total_amount",
]

YLC_CODES = ["vendorid", "pulocationid", "dolocationid", "payment_type"]


def clean_fhv(raw: DataFrame) -> DataFrame:
    """Typed trips of positive duration whose miles, fare and pay are known and not negative."""
    times = {c: moment(c) for c in ("pickup_datetime", "dropoff_datetime")}
    typed = raw.withColumns({**times, **{c: number(c) for c in FHV_NUMBERS}})
    lasted = minutes_between(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return typed.withColumn("trip_duration_min", lasted).where(
        "trip_duration_min > 0 and trip_miles >= 0 and base_passenger_fare >= 0 and driver_pay >= 0"
    )


def clean_ylc(raw: DataFrame) -> DataFrame:
    """Typed trips with distance, amount, passengers and (rounded) duration above zero, plus four measures."""
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    times = {c: moment(c) for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")}
    numbers = {c: number(c) for c in YLC_NUMBERS if c in raw.columns}
    numbers |= {c: whole(c).try_cast("int") for c in YLC_CODES if c in raw.columns}
    paid = raw.withColumns({**times, **numbers}).where("trip_distance > 0 and total_amount > 0 and passenger_count > 0")
    return (
        paid.withColumn("trip_duration_min", round_even(minutes_between(pickup, dropoff), 2))
        .where("trip_duration_min > 0")
        .withColumns(
            {
                "pickup_hour": F.hour(pickup),
                "pickup_weekday": F.weekday(pickup),
                "revenue_per_mile": round_even(ratio(F.col("total_amount"), F.col("trip_distance")), 2),
            }
        )
    )


def _pickups(df: DataFrame, source: str) -> DataFrame:
    """(pickup_datetime, pulocationid) of either source, whichever name it gives the pickup time."""
    stamp = next((c for c in ("pickup_datetime", "tpep_pickup_datetime") if c in df.columns), None)
    if stamp is None or "pulocationid" not in df.columns:
        raise ValueError(f"{source} trips need a pickup time and 'pulocationid'; found {df.columns}")
    return df.select(moment(stamp).alias("pickup_datetime"), whole("pulocationid").alias("pulocationid"))


def _both(fhv: DataFrame, ylc: DataFrame, names: tuple[str, str]) -> DataFrame:
    tagged = [_pickups(df, n).withColumn("tipo_servicio", F.lit(n)) for df, n in zip((fhv, ylc), names)]
    return tagged[0].unionByName(tagged[1])


def normalize_trips(fhv: DataFrame, ylc: DataFrame) -> DataFrame:
    """Both services in one shape; trips without a pickup time or zone are left out."""
    known = _both(fhv, ylc, SERVICES).dropna(subset=["pickup_datetime", "pulocationid"])
    return known.withColumn("pickup_hour", F.hour("pickup_datetime"))


def titled_trips(fhv: DataFrame, ylc: DataFrame) -> DataFrame:
    """Both services under their report titles, keeping trips without a zone."""
    trips = _both(fhv, ylc, SERVICE_TITLES).withColumnRenamed("pickup_datetime", "datetime")
    return trips.withColumn("hora_entera", F.hour("datetime"))


def trips_zone_hour_service(trips: DataFrame) -> DataFrame:
    keys = ["pulocationid", "pickup_hour", "tipo_servicio"]
    return group_known(trips, keys).agg(F.count(F.lit(1)).alias("viajes"))


def market_columns(fhv: Column, ylc: Column) -> dict[str, Column]:
    """Market size, for-hire share of it (0 for an empty market) and for-hire trips per taxi trip plus one."""
    total = fhv + ylc
    share = F.when(total > 0, ratio(fhv, total)).otherwise(0.0)
    return {"total": total, "market_share": share, "ratio": ratio(fhv, ylc + 1)}


def service_counts(names: tuple[str, ...] = SERVICES) -> list[Column]:
    """Trips per service as columns. Conditional counts pivot in the one shuffle of their group."""
    return [F.count_if(F.col("tipo_servicio") == s).alias(s) for s in names]


def zone_hour(trips: DataFrame) -> DataFrame:
    """Demand per zone and hour of day, services side by side; a service without trips counts 0."""
    counts = group_known(trips, ["pulocationid", "pickup_hour"]).agg(*service_counts())
    market = market_columns(F.col("FHV"), F.col("YLC"))
    return counts.select(
        F.col("pulocationid").alias("LocationID"),
        "pickup_hour",
        "FHV",
        "YLC",
        market["total"].alias("total"),
        round_even(market["market_share"], 6).alias("market_share"),
        round_even(market["ratio"], 6).alias("ratio"),
    )


def prepare_hourly(ylc: DataFrame, fhv: DataFrame) -> DataFrame:
    """Trips of both services under common names with their calendar hour; for-hire total = fare + tolls."""
    taxi = ylc.select(
        F.lit("YLC").alias("tipo_servicio"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        "trip_distance",
        "fare_amount",
        "total_amount",
        "trip_duration_min",
    )
    hire = fhv.withColumnsRenamed({"trip_miles": "trip_distance", "base_passenger_fare": "fare_amount"}).select(
        F.lit("FHV").alias("tipo_servicio"),
        "pickup_datetime",
        "trip_distance",
        "fare_amount",
        (F.col("fare_amount") + F.col("tolls")).alias("total_amount"),
        "trip_duration_min",
        "tolls",
        "tips",
    )
    trips = taxi.unionByName(hire, allowMissingColumns=True)
    return trips.withColumn("datetime_hour", floor_hour(F.col("pickup_datetime")))


def hourly_mobility(trips: DataFrame) -> DataFrame:
    """Trips per calendar hour and service. Counting both services in one pass replaces an outer join."""
    counted = group_known(trips, ["datetime_hour"]).agg(*service_counts(("YLC", "FHV")))
    return counted.withColumns(market_columns(F.col("FHV"), F.col("YLC")))


def segment_zone(by_zone_hour: DataFrame) -> DataFrame:
    """Demand per day segment and zone."""
    tagged = by_zone_hour.withColumn("segmento", map_segment(F.col("pickup_hour")))
    summed = group_known(tagged, ["segmento", "LocationID"]).agg(*[F.sum(s).alias(s) for s in SERVICES])
    share = market_columns(F.col("FHV"), F.col("YLC"))["market_share"]
    return summed.withColumn("market_share", round_even(share, 4))


def segment_max(by_segment_zone: DataFrame) -> DataFrame:
    """Largest demand per day segment (colour scale of the map); the share scale always ends at 1."""
    tops = group_known(by_segment_zone, ["segmento"]).agg(*[F.max(s).cast("double").alias(s) for s in SERVICES])
    return tops.withColumn("market_share", F.lit(1.0))


def segment_map(by_segment_zone: DataFrame) -> DataFrame:
    """Per day segment a map from zone id (text) to its measures; one entry per zone."""
    entry = F.struct(F.col("LocationID").cast("string"), F.struct("FHV", "YLC", "market_share"))
    return group_known(by_segment_zone, ["segmento"]).agg(
        F.map_from_entries(F.collect_list(entry)).alias("zonas")
    )


def top5_longest_trips(raw: DataFrame, n: int = 5) -> DataFrame:
    measures = ["trip_distance", "fare_amount", "total_amount"]
    numbers = raw.select(*[number(c).alias(c) for c in measures]).where("trip_distance is not null")
    return numbers.orderBy(*[F.desc_nulls_last(c) for c in measures]).limit(n)
