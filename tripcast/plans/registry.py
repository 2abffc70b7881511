"""Registered queries: each operator as a (Spark plan, DuckDB SQL) pair.

Every query reads the driver's tables (the trip view over ``events``) so its
work grows with them.  Doubles are rounded to 6 decimals on both sides so
float summation order cannot decide the comparison.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from . import oracle as O
from ..operators.clean import clean_trips
from ..operators.demand import station_hour_demand
from ..operators.stations import station_metadata
from ..sources.fixtures import fixture_holidays, fixture_weather, trip_view
from .facts import enriched_station_hour

ROUND_DIGITS = 6


@dataclass
class Registered:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doubles: list[str] = field(default_factory=list)
    covers: list[str] = field(default_factory=list)


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None = None, doubles: list[str] | None = None,
             covers: list[str] | None = None):
    def deco(fn):
        REGISTRY[name] = Registered(fn, sql, list(doubles or []), list(covers or []))
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    changes = {f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(changes) if changes else df


def rounded_sql(sql: str, doubles: list[str], digits: int = ROUND_DIGITS) -> str:
    if not doubles:
        return sql
    # "+ 0.0" folds a negative zero into zero, as Spark's decimal rounding does
    repl = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS oracle_result"


# ---------------------------------------------------------------------------
# shared building blocks
# ---------------------------------------------------------------------------
def trips_of(spark: SparkSession, sf: str) -> DataFrame:
    """Clean trips as a lazy plan: what a query does not read is pruned from the scan on."""
    return clean_trips(trip_view(spark, sf))


def stations_of(trips: DataFrame) -> DataFrame:
    # Oracle-checked plans use the station dimension without KMeans ids (SQL has no KMeans).
    return station_metadata(trips, cluster=False)


def fact_of(spark: SparkSession, sf: str) -> DataFrame:
    trips = trips_of(spark, sf)
    return station_hour_demand(trips, stations_of(trips))


def enriched_of(spark: SparkSession, sf: str, **kw) -> DataFrame:
    """Enriched fact as a lazy plan; columns and joins that a query does not use are pruned."""
    trips = trips_of(spark, sf)
    return enriched_station_hour(trips, fixture_holidays(spark), fixture_weather(spark),
                                 stations=stations_of(trips), **kw)


TRIP_COLS = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "start_station_name",
             "end_station_id", "end_station_name", "start_lat", "start_lng", "end_lat", "end_lng",
             "member_casual", "source_file", "duration_min", "rider_type", "trip_distance_miles", "hour_start"]
TRIP_DOUBLES = ["start_lat", "start_lng", "end_lat", "end_lng", "duration_min", "trip_distance_miles"]
FACT_COLS = ["hour_start", "start_station_id", "rider_type", "demand", "avg_duration_min",
             "avg_trip_distance_miles", "start_station_name", "station_lat", "station_lng", "grid_cell",
             "area_label", "year", "month", "day", "hour", "minute", "day_of_week", "is_weekend",
             "week_of_year", "season", "peak_hour", "morning_peak", "evening_peak", "weekend_peak",
             "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "daypart"]
FACT_DOUBLES = ["avg_duration_min", "avg_trip_distance_miles", "station_lat", "station_lng",
                "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]
LAG_DOUBLES = ["lag_1h", "lag_24h", "lag_168h", "rolling_mean_24h", "rolling_mean_3h", "rolling_mean_6h",
               "rolling_mean_168h", "rolling_max_24h", "rolling_min_24h", "trend_24h",
               "historical_profile_demand", "station_hour_mean", "station_hour_median", "area_hour_mean",
               "station_avg_demand", "area_avg_demand", "area_lag_1h", "area_lag_24h", "area_rolling_mean_24h"]
LAG_COLS = LAG_DOUBLES + ["station_total_demand", "area_total_demand", "station_demand_tier", "area_demand_tier"]
KEYS = ["hour_start", "start_station_id", "rider_type"]
WEATHER_OUT = ["temperature", "precipitation", "snow", "wind_speed", "rain_intensity", "rain_level",
               "snow_intensity", "snow_level", "wind_intensity", "wind_level", "temperature_band",
               "temperature_level"]


def _sel(cols):
    return ", ".join(cols)


# ---------------------------------------------------------------------------
# 1. cleaning
# ---------------------------------------------------------------------------
@register("clean_trips", O.BASE + f"\nSELECT {_sel(TRIP_COLS)} FROM trips", TRIP_DOUBLES,
          ["C1", "C2", "C3", "C4", "C5", "C6", "C7", "C8", "C9", "C10", "C11"])
def q_clean_trips(spark, sf):
    return trips_of(spark, sf).select(*TRIP_COLS)


@register("clean_trips_with_duplicates",
          O.with_ctes(O.TRIP_VIEW, O.RAW_DUPLICATES, O.clean("raw_dups"))
          + "\nSELECT ride_id, started_at, ended_at, start_station_id, rider_type, duration_min FROM trips",
          ["duration_min"], ["C3"])
def q_clean_dups(spark, sf):
    from ..sources.fixtures import trip_view_with_duplicates
    return (clean_trips(trip_view_with_duplicates(spark, sf))
            .select("ride_id", "started_at", "ended_at", "start_station_id", "rider_type", "duration_min"))


# ---------------------------------------------------------------------------
# 2. station dimension and fact
# ---------------------------------------------------------------------------
@register("station_metadata", O.with_ctes(O.TRIP_VIEW, O.clean(), O.STATIONS)
          + "\nSELECT start_station_id, start_station_name, station_lat, station_lng, trips, grid_cell, area_label FROM stations",
          ["station_lat", "station_lng"], ["A1", "F10", "F11"])
def q_station_metadata(spark, sf):
    return stations_of(trips_of(spark, sf)).select(
        "start_station_id", "start_station_name", "station_lat", "station_lng", "trips", "grid_cell", "area_label")


@register("station_metadata_renamed", O.with_ctes(O.TRIP_VIEW, O.RAW_RENAMED, O.clean("raw_renamed"), O.STATIONS)
          + "\nSELECT start_station_id, start_station_name, station_lat, station_lng, trips FROM stations",
          ["station_lat", "station_lng"], ["A1", "Q9"])
def q_station_metadata_renamed(spark, sf):
    from ..sources.fixtures import trip_view_renamed_station
    trips = clean_trips(trip_view_renamed_station(spark, sf))
    return station_metadata(trips, cluster=False).select(
        "start_station_id", "start_station_name", "station_lat", "station_lng", "trips")


@register("station_hour_demand", O.BASE_FACT + f"\nSELECT {_sel(FACT_COLS)} FROM fact", FACT_DOUBLES,
          ["A2", "U1", "J1", "F1", "F2", "F3", "F4", "F5", "F6", "F7"])
def q_station_hour_demand(spark, sf):
    return fact_of(spark, sf).select(*FACT_COLS)


@register("station_hour_lags",
          O.BASE_ENRICHED + f"\nSELECT {_sel(KEYS + LAG_COLS + ['is_holiday', 'is_pre_holiday'])} FROM enriched",
          LAG_DOUBLES, ["W1", "W2", "W3", "W4", "W5", "A4", "A5", "A6", "A7", "A8", "A9", "F24", "J2", "S10",
                        "F8", "F9", "J5", "F12"])
def q_station_hour_lags(spark, sf):
    return enriched_of(spark, sf, cut_lineage=True).select(*KEYS, *LAG_COLS, "is_holiday", "is_pre_holiday")


@register("station_hour_weather",
          O.BASE_ENRICHED + f"\nSELECT {_sel(KEYS + WEATHER_OUT)} FROM enriched",
          ["temperature", "precipitation", "snow", "wind_speed"], ["J4", "F13", "F14", "F15", "F16", "F17"])
def q_station_hour_weather(spark, sf):
    return enriched_of(spark, sf).select(*KEYS, *WEATHER_OUT)
