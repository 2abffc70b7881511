"""Lag, rolling and historical-profile features of the fact.

Plan shape (chosen for skew): every station-level feature is a window over
(station, rider), whose partitions hold one row per active hour of a station,
so they stay bounded by the time span however many trips a hot station has.
Area-level features are first aggregated to (grid, rider, hour[_start]) with
partial aggregation, windowed on that much smaller table, and joined back on
fine keys.  Cluster features are tiny (k <= 12) and broadcast.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import (AREA_LAG_ROWS, AREA_ROLLING_ROWS, LAG_FEATURE_COLUMNS, LAG_ROWS,
                         MAX_CLUSTERS, ROLLING_EXTREME_ROWS, ROLLING_MEAN_ROWS)
from ..functions.tiers import demand_tier

SERIES_KEYS = ["start_station_id", "rider_type"]


def _series_features(df: DataFrame, keys: list[str], order: str = "hour_start") -> dict:
    w = Window.partitionBy(*keys).orderBy(order)
    d = F.col("demand")
    cols = {name: F.lag(d, n).over(w).cast("double") for name, n in LAG_ROWS.items()}
    for name, n in ROLLING_MEAN_ROWS.items():
        cols[name] = F.avg(d).over(w.rowsBetween(-n, -1))
    cols["rolling_max_24h"] = F.max(d).over(w.rowsBetween(-ROLLING_EXTREME_ROWS, -1)).cast("double")
    cols["rolling_min_24h"] = F.min(d).over(w.rowsBetween(-ROLLING_EXTREME_ROWS, -1)).cast("double")
    return cols


def station_profile_columns() -> dict:
    """Station-level means/medians as windows sharing the (station, rider) partitioning."""
    d = F.col("demand")
    by = lambda *extra: Window.partitionBy(*SERIES_KEYS, *extra)
    return {
        "historical_profile_demand": F.avg(d).over(by("day_of_week", "hour")),
        "station_hour_mean": F.avg(d).over(by("hour")),
        "station_hour_median": F.median(d).over(by("hour")),
        "station_avg_demand": F.avg(d).over(by()),
        "station_total_demand": F.sum(d).over(by()),
    }


def area_hour_profiles(fact: DataFrame) -> DataFrame:
    """(grid, rider, hour) -> area_hour_mean, area_avg_demand, area_total_demand."""
    gh = fact.dropna(subset=["grid_cell"]).groupBy("grid_cell", "rider_type", "hour").agg(
        F.sum("demand").alias("_s"), F.count(F.lit(1)).alias("_n"))
    per_area = Window.partitionBy("grid_cell", "rider_type")
    return gh.select(
        "grid_cell", "rider_type", "hour",
        (F.col("_s") / F.col("_n")).alias("area_hour_mean"),
        (F.sum("_s").over(per_area) / F.sum("_n").over(per_area)).alias("area_avg_demand"),
        F.sum("_s").over(per_area).alias("area_total_demand"),
    )


def area_hourly_lags(fact: DataFrame) -> DataFrame:
    """Area demand per (grid, rider, hour_start) with row lags and rolling mean."""
    area = fact.dropna(subset=["grid_cell"]).groupBy("grid_cell", "rider_type", "hour_start").agg(
        F.sum("demand").alias("_area_demand"))
    w = Window.partitionBy("grid_cell", "rider_type").orderBy("hour_start")
    cols = {name: F.lag("_area_demand", n).over(w).cast("double") for name, n in AREA_LAG_ROWS.items()}
    cols["area_rolling_mean_24h"] = F.avg("_area_demand").over(w.rowsBetween(-AREA_ROLLING_ROWS, -1))
    return area.select("grid_cell", "rider_type", "hour_start", *[c.alias(n) for n, c in cols.items()])


def cluster_hour_profiles(fact: DataFrame) -> DataFrame:
    """(cluster, rider, hour) mean.  At most MAX_CLUSTERS x riders x 24 rows."""
    return (fact.dropna(subset=["region_cluster"]).groupBy("region_cluster", "rider_type", "hour")
            .agg(F.avg("demand").alias("cluster_hour_mean")))


def dense_series_features() -> dict:
    """The series features when lags count hours and an hour without a row has demand 0.

    Windows over ranges of hours give what rows of 0 between a series' first and last hour
    would give, without making them: the work grows with the rows, not with the hours between.
    """
    d, hours = F.col("demand"), (F.unix_timestamp("hour_start") / 3600).cast("bigint")
    w = Window.partitionBy(*SERIES_KEYS).orderBy(hours)
    # hours of the series before this one; a frame that reaches back further holds no more than them
    earlier = hours - F.min(hours).over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    held = lambda n: F.least(F.lit(n), earlier)
    cols = {name: F.when(earlier >= n, F.coalesce(F.sum(d).over(w.rangeBetween(-n, -n)), F.lit(0))).cast("double")
            for name, n in LAG_ROWS.items()}
    for name, n in ROLLING_MEAN_ROWS.items():
        cols[name] = F.when(earlier > 0, F.coalesce(F.sum(d).over(w.rangeBetween(-n, -1)), F.lit(0)) / held(n))
    frame, n = w.rangeBetween(-ROLLING_EXTREME_ROWS, -1), ROLLING_EXTREME_ROWS
    gaps = F.count(d).over(frame) < held(n)
    for name, extreme, beside in (("rolling_max_24h", F.max, F.greatest), ("rolling_min_24h", F.min, F.least)):
        found = extreme(d).over(frame)
        cols[name] = F.when(earlier > 0, F.when(gaps, beside(found, F.lit(0))).otherwise(found)).cast("double")
    return cols


def add_lag_features(fact: DataFrame, fill: str = "median", densify: bool = False) -> DataFrame:
    """Add the 22 lag / rolling / profile columns of the reference.

    fill='median' (parity, Q3): every null feature takes the global median demand.
    fill='profile': first the row's historical profile, then the global median.
    densify=True (Q4): lags count hours, not rows; missing hours are demand 0.
    """
    data = fact.withColumns(dense_series_features() if densify else _series_features(fact, SERIES_KEYS))
    data = data.withColumn("trend_24h", F.col("lag_1h") - F.col("lag_24h"))
    data = data.withColumns(station_profile_columns())
    area = (area_hourly_lags(fact).withColumn("hour", F.hour("hour_start"))
            .join(area_hour_profiles(fact), ["grid_cell", "rider_type", "hour"], "left").drop("hour"))
    data = data.join(area, ["grid_cell", "rider_type", "hour_start"], "left")
    if "region_cluster" in fact.columns:
        # bounded: k <= MAX_CLUSTERS clusters x rider types x 24 hours
        data = data.join(F.broadcast(cluster_hour_profiles(fact)), ["region_cluster", "rider_type", "hour"], "left")
    else:
        data = data.withColumn("cluster_hour_mean", F.lit(None).cast("double"))
    data = data.withColumns({
        "station_demand_tier": demand_tier("station_avg_demand"),
        "area_demand_tier": demand_tier("area_avg_demand"),
    })
    median = fact.select(F.median("demand")).scalar()
    fills = {}
    for c in LAG_FEATURE_COLUMNS:
        if fill == "profile" and c != "historical_profile_demand":
            fills[c] = F.coalesce(F.col(c), F.col("historical_profile_demand"), median)
        else:
            fills[c] = F.coalesce(F.col(c), median)
    for c in ("station_total_demand", "area_total_demand"):  # sums stay integers
        fills[c] = fills[c].cast("bigint")
    return data.withColumns(fills)
