"""Domain tables derived from the benchmark tables; the only module that knows those tables.

Every derived table maps each row of its source (nothing is left out) and plants dirty cells -
unreadable dates, NaN, text in numeric columns, reversed ranges - so that the cleaning rules have work to do.
Columns with dirty text are text; the others have the type a typed landing format would give them.
The registered SQL derives the same tables in its own words.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metropulse.functions.times import floor_hour
from metropulse.operators import events as ev
from metropulse.operators import matching, traffic, trips, weather
from metropulse.operators.staging import settle

YEAR = 2024
CALENDAR_HOURS = 87600  # ten years


def borough(index: str) -> str:
    return (
        f"case {index} when 0 then 'Bronx' when 1 then 'Queens' when 2 then 'Manhattan' "
        "when 3 then 'Brooklyn' else 'Staten Island' end"
    )


class Feeds:
    """Raw and derived domain tables over one folder of benchmark tables. All lazy; one instance per query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # Raw tables -----------------------------------------------------------------------------------------------

    @cached_property
    def ylc_raw(self) -> DataFrame:
        return self.ylc_rows.drop("event_id")

    @cached_property
    def ylc_rows(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            "cast(event_id % 2 + 1 as int) vendorid",
            "case when event_id % 199 = 0 then 'x' else cast(ts as string) end tpep_pickup_datetime",
            "ts + make_dt_interval(0, 0, cast(event_id % 50 as int) - 5) tpep_dropoff_datetime",
            "case when event_id % 97 = 0 then double('NaN') when event_id % 89 = 0 then null "
            "else double(event_id % 5) end passenger_count",
            "case when event_id % 103 = 0 then 'far' else cast(value / 10 - 1 as string) end trip_distance",
            "cast(user_id % 27 as int) pulocationid",
            "cast(user_id * 7 % 27 as int) dolocationid",
            "cast(event_id % 4 as int) payment_type",
            "value fare_amount",
            "0.5D extra",
            "value * 0.1D tip_amount",
            "double(event_id % 7) tolls_amount",
            "2.5D congestion_surcharge",
            "case when event_id % 107 = 0 then double('NaN') else value - 5 end total_amount",
        )

    @cached_property
    def fhv_raw(self) -> DataFrame:
        return self.table("events").selectExpr(
            "case when event_id % 211 = 0 then 'x' else cast(ts - interval 20 minutes as string) end pickup_datetime",
            "ts + make_dt_interval(0, 0, cast(event_id * 7 % 53 as int) - 24) dropoff_datetime",
            "case when event_id % 61 = 0 then null else cast(user_id % 27 as string) end pulocationid",
            "cast(user_id * 7 % 27 as string) dolocationid",
            "value / 10 - 0.5D trip_miles",
            "case when event_id % 53 = 0 then 'abc' else cast(value - 3 as string) end base_passenger_fare",
            "case when event_id % 7 = 0 then null else value * 0.05D end tolls",
            "case when event_id % 59 = 0 then 'n/a' else cast(value * 0.1D as string) end tips",
            "case when event_id % 109 = 0 then double('NaN') else value * 0.7D - 2 end driver_pay",
        )

    @cached_property
    def lookup(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "n_nationkey LocationID",
            "case n_nationkey when 24 then 'Unknown' when 13 then null "
            f"else {borough('n_regionkey')} end Borough",
            "n_name Zone",
            "'Boro Zone' service_zone",
        )

    @cached_property
    def zones(self) -> DataFrame:
        ring = "concat('{\"type\":\"Polygon\",\"coordinates\":[[[', n_nationkey, ',40],[-73,40],[-73,41],[', n_nationkey, ',40]]]}')"
        return self.table("nation").selectExpr("n_nationkey locationid", "n_name zone", f"{ring} geometry")

    @cached_property
    def zones_full(self) -> DataFrame:
        """Zones with all their columns, in other cases, and every third one in two parts."""
        place = "concat('[[[', n_nationkey, ',40],[-73,40],[-73,41],[', n_nationkey, ',40]]]')"
        apart = "concat('[[[', n_nationkey, ',50],[-73,50],[-73,51],[', n_nationkey, ',50]]]')"
        return self.table("nation").selectExpr(
            "n_nationkey LOCATIONID",
            "n_name Zone",
            f"{borough('n_regionkey')} Borough",
            "case when n_nationkey % 2 = 0 then 'Yellow Zone' else 'Boro Zone' end Service_Zone",
            f"case when n_nationkey % 3 = 0 then concat('{{\"type\":\"MultiPolygon\",\"coordinates\":[', {place}, ',', {apart}, ']}}') "
            f"else concat('{{\"type\":\"Polygon\",\"coordinates\":', {place}, '}}') end GEOMETRY",
        )

    @cached_property
    def traffic_text(self) -> DataFrame:
        """The counts as a text landing gives them: date parts are text, some of them unreadable."""
        parts = {c: F.col(c).cast("string") for c in ("Yr", "M", "D", "HH", "MM")}
        parts["HH"] = F.when(F.col("event_id") % 113 == 0, "n/a").otherwise(parts["HH"])
        parts["D"] = F.when(F.col("event_id") % 127 == 0, "").when(F.col("event_id") % 131 == 0, "31.5").otherwise(parts["D"])
        return self.traffic_rows.withColumns(parts).drop("event_id")

    @cached_property
    def traffic_raw(self) -> DataFrame:
        return self.traffic_rows.drop("event_id")

    @cached_property
    def traffic_rows(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id",
            f"concat('  ', upper({borough('user_id % 5')}), ' ') Boro",
            f"case when event_id % 307 = 0 then {YEAR - 2} else year(ts) end Yr",
            "case when event_id % 509 = 0 then 13 else month(ts) end M",
            "dayofmonth(ts) D",
            "hour(ts) HH",
            "cast(floor(minute(ts) / 15) * 15 as int) MM",
            "case when event_id % 401 = 0 then null else cast(floor(value) as bigint) - 3 end Vol",
            "user_id % 150 SegmentID",
            "case when event_id % 101 = 0 then 'bad' when event_id % 103 = 0 then 'POINT(1 2)' else "
            "concat('POINT (', 920000 + 1000 * (user_id % 150), '.25 ', 150000 + 700 * (user_id % 150), ')') end WktGeom",
            "concat(' main STREET ', user_id % 150, ' ') street",
            "'WEST end' fromSt",
            "' east END' toSt",
            "'NB' Direction",
        )

    @cached_property
    def events_raw(self) -> DataFrame:
        start = (
            f"timestamp_ntz'{YEAR}-01-01' + "
            f"make_dt_interval(0, cast((o_orderkey div 5) % {CALENDAR_HOURS} as int), cast(o_custkey % 4 * 15 as int))"
        )
        timed = self.table("orders").selectExpr("*", f"{start} start").selectExpr(
            "*", "start + make_dt_interval(0, cast(o_custkey % 6 as int) - 1) finish"
        )
        return timed.selectExpr(
            "cast(o_orderkey as string) `Event ID`",
            "case when o_orderkey % 41 = 0 then null else concat('Event ', o_orderkey) end `Event Name`",
            "case when o_orderkey % 2 = 0 then cast(start as string) "
            "else date_format(start, 'MM/dd/yyyy hh:mm:ss a') end `Start Date/Time`",
            "case when o_orderkey % 43 = 0 then null else cast(finish as string) end `End Date/Time`",
            "'Parks Department' `Event Agency`",
            "case when o_orderkey % 35 = 0 then null when o_orderpriority = '5-LOW' then 'Special Event' "
            "else o_orderpriority end `Event Type`",
            f"{borough('o_custkey % 5')} `Event Borough`",
            "'12,' `Police Precinct`",
        )

    @cached_property
    def schedule(self) -> DataFrame:
        """One document per supplier: a home game, and one elsewhere that must not survive."""
        start = (
            f"date_format(timestamp_ntz'{YEAR}-01-01 18:05:00' + "
            f"make_dt_interval(0, cast(s_suppkey * 7 % {CALENDAR_HOURS} as int)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        )
        info = (
            "case when s_suppkey % 5 = 0 then null else named_struct('gameDurationMinutes', "
            "case when s_suppkey % 7 = 0 then 0 else cast(150 + s_suppkey % 60 as int) end) end"
        )
        venue = "case s_suppkey % 2 when 0 then 'Yankee Stadium' else 'Citi Field' end"
        games = ", ".join(
            f"named_struct('gameDate', {start}, 'venue', named_struct('name', {v}), 'gameInfo', {info})"
            for v in (venue, "'Fenway Park'")
        )
        return self.table("supplier").selectExpr(f"array(named_struct('games', array({games}))) dates", "s_suppkey")

    @cached_property
    def weather_raw(self) -> DataFrame:
        """An hour per residue of the order keys; the last two hours of the month have no weather."""
        hours = self.table("lineitem").groupBy((F.col("l_orderkey") % 718).cast("int").alias("h")).agg(F.count(F.lit(1)).alias("c"))
        return hours.selectExpr(
            f"timestamp_ntz'{YEAR}-01-01' + make_dt_interval(0, h) date",
            "cast(c % 5 as double) temperature_2m",
            "cast(c % 3 as double) precipitation",
            "cast(c % 3 as double) rain",
            "0D snowfall",
            "0D snow_depth",
        )

    @cached_property
    def weather_responses(self) -> DataFrame:
        """The weather as one response per day with an array of at most 24 values per variable."""
        hours = self.weather_raw.withColumnRenamed("date", "at")
        rows = F.array_sort(F.collect_list(F.struct("at", *weather.WEATHER)))
        days = hours.groupBy(F.to_date("at").alias("day")).agg(rows.alias("rows"))
        start = F.unix_seconds(F.element_at("rows", 1)["at"].cast("timestamp"))
        return days.select(
            start.alias("time_start"),
            (start + F.size("rows") * 3600).alias("time_end"),
            F.lit(3600).cast("bigint").alias("interval_s"),
            *[F.col(f"rows.{v}").alias(v) for v in weather.WEATHER],
        )

    # Derived tables -------------------------------------------------------------------------------------------

    @cached_property
    def ylc(self) -> DataFrame:
        return trips.clean_ylc(self.ylc_raw)

    @cached_property
    def fhv(self) -> DataFrame:
        return trips.clean_fhv(self.fhv_raw)

    @cached_property
    def trips(self) -> DataFrame:
        return trips.normalize_trips(self.fhv, self.ylc)

    @cached_property
    def titled(self) -> DataFrame:
        return trips.titled_trips(self.fhv, self.ylc)

    @cached_property
    def zone_hour(self) -> DataFrame:
        return trips.zone_hour(self.trips)

    @cached_property
    def mobility(self) -> DataFrame:
        return trips.hourly_mobility(trips.prepare_hourly(self.ylc, self.fhv))

    @cached_property
    def hourly(self) -> DataFrame:
        return weather.hourly_weather(self.mobility, self.weather_raw)

    @cached_property
    def features(self) -> DataFrame:
        return traffic.traffic_features(self.traffic_raw, traffic.BOROUGHS)

    @cached_property
    def saved_features(self) -> DataFrame:
        """The features as a written table, for jobs that pass over them more than once."""
        return settle(self.features, "features").df

    @cached_property
    def baseline(self) -> DataFrame:
        return ev.traffic_baseline(self.saved_features)

    @cached_property
    def events(self) -> DataFrame:
        return ev.clean_events(self.events_raw)

    @cached_property
    def events_hourly(self) -> DataFrame:
        return ev.expand_events_hourly(self.events)

    @cached_property
    def games(self) -> DataFrame:
        return ev.flatten_mlb_schedule(self.schedule)

    @cached_property
    def mlb_events(self) -> DataFrame:
        return ev.mlb_as_events(ev.mlb_first_week(self.games), ev.largest_event_id(self.events))

    @cached_property
    def mlb_hourly(self) -> DataFrame:
        return ev.expand_events_hourly(self.mlb_events)

    def event_hours(self, times: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Hours of events and of games that meet ``times``."""
        hours = times.withColumn("timestamp", floor_hour(F.col("timestamp")))
        return ev.event_hours_at(times, self.events), ev.event_hours_at(hours, self.mlb_events, whole_hours=True)

    @cached_property
    def traffic_event_impact(self) -> DataFrame:
        return ev.traffic_event_impact(self.baseline, ev.event_hours_at(self.saved_features, self.events))

    @cached_property
    def traffic_events_mlb(self) -> DataFrame:
        hours = self.saved_features.withColumn("timestamp", floor_hour(F.col("timestamp")))
        return ev.traffic_events_mlb(self.traffic_event_impact, ev.event_hours_at(hours, self.mlb_events, whole_hours=True))

    @cached_property
    def cells(self) -> DataFrame:
        return matching.traffic_cells(self.traffic_raw)

    def matches(self, *fields: str) -> DataFrame:
        return matching.weighted_matches(self.cells, *self.event_hours(self.cells), fields)
