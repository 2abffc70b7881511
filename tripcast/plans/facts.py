"""The enriched station-hour fact and its area rollup, as one lazy plan each."""
from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.demand import area_hour_demand, station_hour_demand
from ..operators.enrich import add_holiday_features, merge_weather
from ..operators.lags import add_lag_features
from ..operators.stations import station_metadata
from ..session import written


def enriched_station_hour(trips: DataFrame, holidays: DataFrame | None = None,
                          weather: DataFrame | None = None, weather_kind: str = "daily",
                          stations: DataFrame | None = None, fill: str = "median",
                          densify: bool = False, one_name_per_id: bool = True,
                          cut_lineage: bool = False) -> DataFrame:
    """clean trips -> fact (+ station dimension, calendar) -> holidays -> lags/profiles -> weather.

    The base fact feeds the series windows, two area aggregates and the global
    median.  By default the plan stays lazy, so that projections and filters reach
    the scan and equal shuffles are reused; ``cut_lineage`` writes the base fact once
    to the checkpoint folder (batch builds that store every column anyway).
    """
    if stations is None:
        stations = station_metadata(trips, one_name_per_id=one_name_per_id)
    fact = station_hour_demand(trips, stations)
    fact = add_holiday_features(fact, holidays)
    if cut_lineage:
        fact = written(fact)
    fact = add_lag_features(fact, fill=fill, densify=densify)
    return merge_weather(fact, weather, weather_kind)


def enriched_area_hour(station_hour: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    return add_holiday_features(area_hour_demand(station_hour), holidays)
