"""Trip-shaped view over the driver's ``events`` table, plus small side tables.

``events`` rows become trips.  Every user is a start station, so stations grow with the
table, but every third event starts at station 0, a hot one; the end station comes from the
``k`` value in ``props``, duration from ``value`` minutes.  Four stations share a grid cell,
and cells are spread over the areas.  Every number is a double so grid and area maths agree
across engines.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_utc

STATIONS_PER_CELL = 4
CELLS_PER_SIDE = 20
HOT_EVERY = 3
NO_END_EVERY = 20
MEMBER_EVENTS = ["click", "view", "signup"]


def _station_id(n: Column) -> Column:
    return F.concat(F.lit("S"), F.lpad(n.cast("string"), 6, "0"))


def _station_name(n: Column) -> Column:
    return F.concat(F.lit("Station "), n.cast("string"))


def _start_station() -> Column:
    return F.when(F.col("event_id") % HOT_EVERY == 0, F.lit(0)).otherwise(F.col("user_id")).cast("bigint")


def _cell(n: Column) -> Column:
    return ((n - n % STATIONS_PER_CELL) / STATIONS_PER_CELL).cast("bigint")


def _lat(n: Column) -> Column:
    return (F.lit(40.562) + (_cell(n) % CELLS_PER_SIDE).cast("double") * F.lit(0.015)
            + (n % STATIONS_PER_CELL).cast("double") * F.lit(0.000371373))


def _lng(n: Column) -> Column:
    cell = _cell(n)
    column = (cell * 7 + ((cell - cell % CELLS_PER_SIDE) / CELLS_PER_SIDE).cast("bigint")) % CELLS_PER_SIDE
    return F.lit(-74.088) + column.cast("double") * F.lit(0.017)


def events_to_trips(events: DataFrame) -> DataFrame:
    """Map event rows to the 13 raw trip columns + ``source_file``."""
    # ``props`` is parsed once per row: the one-element generator is a plan
    # boundary, so predicates on the derived columns are not pushed below it
    # with the JSON parse substituted back into each of them.
    parsed = F.inline(F.array(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"))))
    ev = events.select("event_id", "ts", "value", "event_type", _start_station().alias("st"), parsed)
    end = F.col("k").cast("bigint")
    no_end = end % NO_END_EVERY == NO_END_EVERY - 1
    started = F.col("ts").cast("timestamp")
    return ev.select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.when(F.col("k") % 2 == 0, F.lit("classic_bike")).otherwise(F.lit(" Electric_Bike ")).alias("rideable_type"),
        started.alias("started_at"),
        F.timestamp_add("SECOND", F.round(F.col("value") * 60).cast("int"), started).alias("ended_at"),
        _station_id(F.col("st")).alias("start_station_id"),
        _station_name(F.col("st")).alias("start_station_name"),
        F.when(no_end, F.lit(None)).otherwise(_station_id(end)).alias("end_station_id"),
        F.when(no_end, F.lit(None)).otherwise(_station_name(end)).alias("end_station_name"),
        _lat(F.col("st")).alias("start_lat"),
        _lng(F.col("st")).alias("start_lng"),
        F.when(no_end, F.lit(None).cast("double")).otherwise(_lat(end)).alias("end_lat"),
        F.when(no_end, F.lit(None).cast("double")).otherwise(_lng(end)).alias("end_lng"),
        F.when(F.col("event_type").isin(MEMBER_EVENTS), F.lit(" Member ")).otherwise(F.lit("casual")).alias("member_casual"),
        F.concat(F.lit("part-"), (F.col("event_id") % 3).cast("string"), F.lit(".csv")).alias("source_file"),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def trip_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_trips(read_events(spark, sf_dir))


def trip_view_with_duplicates(spark: SparkSession, sf_dir: str, every: int = 97,
                              shift_minutes: int = 5) -> DataFrame:
    """Edge variant: every ``every``-th event appears twice, the copy starting later."""
    base = trip_view(spark, sf_dir)
    dup = base.filter(F.col("ride_id").cast("bigint") % every == 0).withColumns({
        "started_at": F.timestamp_add("MINUTE", F.lit(shift_minutes), F.col("started_at")),
        "ended_at": F.timestamp_add("MINUTE", F.lit(shift_minutes), F.col("ended_at")),
    })
    return base.unionByName(dup)


def trip_view_renamed_station(spark: SparkSession, sf_dir: str, station: int = 0,
                              k_from: int = 50) -> DataFrame:
    """Edge variant: one station carries a second name for part of its trips (Q9)."""
    ev = read_events(spark, sf_dir)
    trips = events_to_trips(ev)
    k = F.get_json_object(ev["props"], "$.k").cast("int")
    renamed = ev.select(F.col("event_id").cast("string").alias("_rid"), k.alias("_k"),
                        _start_station().alias("_st"))
    joined = trips.join(renamed, trips["ride_id"] == renamed["_rid"])
    cond = (F.col("_st") == station) & (F.col("_k") >= k_from)
    return joined.withColumn(
        "start_station_name",
        F.when(cond, F.concat(F.col("start_station_name"), F.lit(" (renamed)"))).otherwise(F.col("start_station_name")),
    ).drop("_rid", "_k", "_st")


# Synthetic side tables of the fixture (same expressions in the SQL oracle).
FIXTURE_WEATHER_START = dt.date(2024, 1, 1)
FIXTURE_WEATHER_DAYS = 29  # i = 0..28; day 29 is left out on purpose
FIXTURE_HOLIDAYS = [("2024-01-01", "New Year's Day"), ("2024-01-15", "Martin Luther King Jr. Day")]


def fixture_weather(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(FIXTURE_WEATHER_DAYS).select(
        F.date_add(F.lit(FIXTURE_WEATHER_START), i.cast("int")).alias("date"),
        ((i * 7) % 40 - 8).cast("double").alias("temperature"),
        ((i % 5) * 3.0).alias("precipitation"),
        ((i % 7) * 10.0).alias("snow"),
        ((i % 6) * 2.0).alias("wind_speed"),
    )


def fixture_holidays(spark: SparkSession) -> DataFrame:
    from .holidays import holiday_table
    return holiday_table(spark, FIXTURE_HOLIDAYS)
