"""Station-hour and area-hour demand facts."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import add_time_features

STATION_KEYS = ["hour_start", "start_station_id", "rider_type"]
ALL_RIDERS = "all"


def station_hour_counts(trips: DataFrame) -> DataFrame:
    """Demand per (hour, station, rider) plus the ``'all'`` rider rollup.

    One pass with grouping sets (one Expand + partial/final aggregate) instead
    of two group-bys and a union.
    """
    agg = trips.groupingSets(
        [["hour_start", "start_station_id", "rider_type"], ["hour_start", "start_station_id"]],
        "hour_start", "start_station_id", "rider_type",
    ).agg(
        F.count("ride_id").alias("demand"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.avg("trip_distance_miles").alias("avg_trip_distance_miles"),
        F.grouping("rider_type").alias("_rollup"),
    )
    return agg.select(
        "hour_start", "start_station_id",
        F.when(F.col("_rollup") == 1, F.lit(ALL_RIDERS)).otherwise(F.col("rider_type")).alias("rider_type"),
        "demand", "avg_duration_min", "avg_trip_distance_miles",
    )


def station_hour_demand(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Fact table: counts joined to the station dimension on id, plus calendar features.

    The dimension has one row per station (per (id, name) with fan-out).  No
    broadcast hint: AQE turns the join into a broadcast at run time when the
    measured dimension is small, and keeps a shuffle join when it is not.
    """
    fact = station_hour_counts(trips).join(stations.drop("trips"), on="start_station_id", how="left")
    return add_time_features(fact)


def area_hour_demand(station_hour: DataFrame) -> DataFrame:
    """Area-hour rollup (A3): summed demand, mean coordinates, distinct stations."""
    keys = ["hour_start", "grid_cell", "region_cluster", "area_label", "rider_type"]
    area = (station_hour.dropna(subset=keys)
            .groupBy(*keys).agg(
                F.sum("demand").alias("demand"),
                F.avg("station_lat").alias("station_lat"),
                F.avg("station_lng").alias("station_lng"),
                F.countDistinct("start_station_id").alias("stations"),
            ))
    return add_time_features(area)
