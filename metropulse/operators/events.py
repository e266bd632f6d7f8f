"""Permitted events and ball games: cleaning, hourly expansion, baseline and match with traffic.

Joins key on (timestamp, borough). The event side is measured before it is broadcast; beyond the limit
the traffic rows are salted, so one busy hour of one borough does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metropulse.functions.times import floor_hour, plus_minutes
from metropulse.functions.values import group_known, moment, percent_over
from metropulse.operators.numbering import numbered
from metropulse.operators.staging import join_sized, settle

# Source headers (export and API spelling), columns and types left out, venues.
EVENT_HEADERS = {
    "Event ID": "event_id",
    "Event Name": "event_name",
    "Event Type": "event_type",
    "Event Borough": "event_borough",
    "Start Date/Time": "start_time",
    "End Date/Time": "end_time",
    "start_date_time": "start_time",
    "end_date_time": "end_time",
}
UNUSED_COLUMNS = ["Event Agency", "Police Precinct", "Event Street Side", "Community Board"]
UNUSED_COLUMNS_API = ["event_agency", "police_precinct", "event_street_side", "community_board"]
EXCLUDED_TYPES = ["Sport - Youth", "Sport - Adult", "Special Event"]
EXPORT_TIME = "MM/dd/yyyy hh:mm:ss a"
VENUE_BOROUGH = {"Yankee Stadium": "Bronx", "Citi Field": "Queens"}
LOCAL_ZONE = "America/New_York"

EVENT_FIELDS = ["event_type", "event_id", "event_name"]
BASELINE_KEYS = ["Boro", "dia_semana", "hora_entera"]


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed events without the excluded types; events of unknown type stay."""
    ev = raw.withColumnsRenamed(EVENT_HEADERS).drop(*UNUSED_COLUMNS, *UNUSED_COLUMNS_API)
    kept = ev.where(F.col("event_type").isNull() | ~F.col("event_type").isin(EXCLUDED_TYPES))
    return kept.withColumns(
        {
            "event_id": F.col("event_id").try_cast("bigint"),
            "start_time": moment("start_time", EXPORT_TIME),
            "end_time": moment("end_time", EXPORT_TIME),
        }
    )


def expand_events_hourly(events: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """One row per hour of an event, counted from its own start, end included.

    With ``first`` and ``last`` only hours between them are made, still counted from the event's start: an end typed as
    year 9999 costs no more than the time the counts cover.

    An event that ends before it starts or has an open end yields nothing. The condition sits inside
    the generator: as a filter it would be pushed down and read both time texts a second time.
    """
    start, end = F.col("start_time"), F.col("end_time")
    if first is not None:
        late = F.ceil(F.timestamp_diff("SECOND", start, first) / 3600).cast("int")
        start = F.when(first > start, start + F.make_dt_interval(F.lit(0), late)).otherwise(start)
    if last is not None:
        end = F.when(end > last, last).otherwise(end)  # an open end stays open
    hours = F.sequence(start, end, F.expr("interval 1 hour"))
    return events.select(
        F.explode(F.when(end >= start, hours)).alias("timestamp"),
        F.col("event_borough").alias("Boro"),
        *EVENT_FIELDS,
    )


HOUR = 3_600_000_000
DAY = 24 * HOUR


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)


def event_spans(events: DataFrame, first: Column, last: Column, whole_hours: bool = False) -> DataFrame:
    """Events as (Boro, phase, level, bucket, begin, finish, fields) for a join by interval, two rows each however long.

    An event takes place at its start, an hour later and so on up to its end, so at times of its ``phase`` (start within the
    hour) between begin and finish, in microseconds. It is cut to ``first`` .. ``last`` and entered in the buckets it
    touches on the ``level`` whose buckets, days times a power of four, are as long as itself. With ``whole_hours`` its times
    are cut to the hour they lie in.
    """
    begin, finish = _micros(F.col("start_time")), _micros(F.col("end_time"))
    phase = F.pmod(begin, F.lit(HOUR))
    if whole_hours:
        begin, finish, phase = begin - phase, finish - phase, F.lit(0).cast("bigint")
    cut = events.select(
        F.col("event_borough").alias("Boro"),
        *EVENT_FIELDS,
        phase.alias("phase"),
        F.greatest(begin, first).alias("begin"),
        F.when(finish > last, last).otherwise(finish).alias("finish"),  # an open end stays open
    ).where("finish >= begin")
    level = F.greatest(F.lit(0), F.ceil(F.log2((F.col("finish") - F.col("begin") + 1) / DAY) / 2)).cast("int")
    sized = cut.withColumn("level", level).withColumn("wide", (DAY * F.pow(F.lit(4), "level")).cast("bigint"))
    buckets = F.expr("explode(sequence(begin div wide, finish div wide))")
    return sized.withColumn("bucket", buckets).drop("wide")


def event_hours_at(times: DataFrame, events: DataFrame, whole_hours: bool = False) -> DataFrame:
    """The rows of ``expand_events_hourly`` that meet a row of ``times`` (timestamp, Boro), without making the others.

    Times and event spans meet by borough, phase, level and bucket, and are then compared as a range. Every level in use copies
    the distinct times once (about six levels for ten years), and an event's length adds no rows. ``whole_hours`` wants times on
    the hour.
    """
    cells = settle(times.select("timestamp", "Boro").dropna().distinct().withColumn("t", _micros(F.col("timestamp"))), "times")
    first, last = (cells.df.agg(f("t")).scalar() for f in (F.min, F.max))
    spans = settle(event_spans(events, first, last, whole_hours), "event-spans")
    levels = [r.level for r in spans.df.select("level").distinct().collect()]  # a dozen at most
    level = F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>"))
    placed = cells.df.withColumn("phase", F.pmod("t", F.lit(HOUR))).withColumn("level", level)
    placed = placed.withColumn("bucket", F.expr(f"t div cast({DAY}L * pow(4, level) as bigint)"))
    met = join_sized(placed, spans, ["Boro", "phase", "level", "bucket"], "inner")
    return met.where("t between begin and finish").select("timestamp", "Boro", *EVENT_FIELDS)


def traffic_baseline(traffic: DataFrame) -> DataFrame:
    """Traffic with the mean volume of its borough, weekday and hour.

    A partial aggregate plus a join back: the few hundred groups each hold a large share of all
    rows, so a window over them would sort whole groups inside single tasks.
    """
    mean = group_known(traffic, BASELINE_KEYS).agg(F.avg("Vol").alias("baseline_vol"))
    return join_sized(traffic, mean, BASELINE_KEYS, "left", "baseline")


def with_change(traffic: DataFrame) -> DataFrame:
    change = percent_over(F.col("Vol").cast("double"), F.col("baseline_vol"))
    return traffic.withColumn("pct_change_vs_baseline", change)


def traffic_event_impact(traffic: DataFrame, events_hourly: DataFrame) -> DataFrame:
    """Every traffic row with each event of exactly its time and borough, and its change against the baseline."""
    return with_change(join_sized(traffic, events_hourly, ["timestamp", "Boro"], "left", "events"))


def traffic_events_mlb(traffic_events: DataFrame, mlb_hourly: DataFrame) -> DataFrame:
    """Fill missing event fields, each on its own, from the games of the same hour and borough."""
    games = mlb_hourly.withColumn("timestamp", floor_hour(F.col("timestamp")))
    games = games.withColumnsRenamed({f: f"{f}_mlb" for f in EVENT_FIELDS})
    hourly = traffic_events.withColumn("timestamp", floor_hour(F.col("timestamp")))
    joined = join_sized(hourly, games, ["timestamp", "Boro"], "left", "games")
    filled = {f: F.coalesce(F.col(f), F.col(f"{f}_mlb")) for f in EVENT_FIELDS}
    return joined.withColumns(filled).drop(*[f"{f}_mlb" for f in EVENT_FIELDS])


def distinct_event_types(traffic_events: DataFrame, weight: str | None = None) -> DataFrame:
    """Event types present, with their rows; of weighted rows the sum of ``weight``."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return group_known(traffic_events, ["event_type"]).agg(n.alias("n"))


def flatten_mlb_schedule(schedule: DataFrame, venues: Sequence[str] = tuple(VENUE_BOROUGH)) -> DataFrame:
    """Games at the wanted venues from a nested schedule, in local time; end unknown without a duration."""
    games = schedule.select(F.inline("dates")).select(F.inline("games"))
    return _timed_games(
        games.select(
            F.col("gameDate").alias("date"),
            F.col("venue.name").alias("venue"),
            F.col("gameInfo.gameDurationMinutes").alias("_minutes"),
        ),
        venues,
    )


def flatten_mlb_documents(documents: DataFrame, venues: Sequence[str] = tuple(VENUE_BOROUGH), column: str = "value") -> DataFrame:
    """As ``flatten_mlb_schedule``, from schedules as text. Documents are read as variants, so a cell of another type than expected
    (a duration in words, a venue that is text, no games at all) costs that cell and neither its row nor its document; a number
    written as text is read. Text that is no JSON gives no games."""

    def each(df: DataFrame, path: str) -> DataFrame:
        return df.select(F.explode(F.try_variant_get("v", path, "array<variant>")).alias("v"))

    games = each(each(documents.select(F.try_parse_json(column).alias("v")), "$.dates"), "$.games")
    cells = {"date": ("$.gameDate", "string"), "venue": ("$.venue.name", "string"), "_minutes": ("$.gameInfo.gameDurationMinutes", "int")}
    return _timed_games(games.select(*[F.try_variant_get("v", p, t).alias(c) for c, (p, t) in cells.items()]), venues)


def _timed_games(games: DataFrame, venues: Sequence[str]) -> DataFrame:
    """(venue, start_time_ny, end_time_ny) of games with date, venue and _minutes."""
    # An offset in the text is applied and the instant counted from the epoch, so the session's zone has no part in it.
    seconds = (F.unix_micros(F.col("date").try_cast("timestamp")).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    instant = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    start = F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), instant)
    timed = games.where(F.col("venue").isin(*venues)).select("venue", start.alias("start_time_ny"), "_minutes")
    end = F.when(F.col("_minutes") != 0, plus_minutes(F.col("start_time_ny"), F.col("_minutes")))
    return timed.withColumn("end_time_ny", end).drop("_minutes")


def typed_games(games: DataFrame) -> DataFrame:
    return games.withColumns({c: moment(c) for c in ("start_time_ny", "end_time_ny")})


def mlb_first_week(games: DataFrame) -> DataFrame:
    """Games on the first seven days of any month."""
    return typed_games(games).where(F.dayofmonth("start_time_ny").between(1, 7))


def mlb_as_events(games: DataFrame, max_id: Column | int) -> DataFrame:
    """Games in the shape of events; ids continue after ``max_id`` in order of start."""
    order = [F.asc_nulls_last(c) for c in ("start_time_ny", "venue", "end_time_ny")]
    counted = numbered(typed_games(games).select("venue", "start_time_ny", "end_time_ny"), order, "_place")
    borough = F.create_map(*[F.lit(x) for pair in VENUE_BOROUGH.items() for x in pair])
    offset = F.lit(max_id) if isinstance(max_id, int) else max_id
    return counted.select(
        (offset + F.col("_place")).alias("event_id"),
        F.concat("venue", F.lit(" MLB Game")).alias("event_name"),
        F.lit("MLB").alias("event_type"),
        F.try_element_at(borough, F.col("venue")).alias("event_borough"),
        F.col("start_time_ny").alias("start_time"),
        F.col("end_time_ny").alias("end_time"),
    )


def largest_event_id(events: DataFrame) -> Column:
    """The largest id as a scalar subquery, 0 when there is none."""
    return events.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("max_id")).scalar()
