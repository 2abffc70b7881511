"""Published aggregate tables and analysis queries.

Conventions:
* ``rider_type='all'`` selects the rollup rows of the fact (Q5).  The reference
  filters nothing for 'all', which sums member + casual + rollup (2x).  Pass
  ``include_rollup=True`` to get that parity behaviour.
* Top-k results carry explicit key tie-breaks.
* Global "winner" picks (peak hour, top station) use ``min(struct(-total, key))``,
  an aggregate with a map-side partial step, never a global sort.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import DEFAULT_CONTEXT_HOURS, DEFAULT_MAP_CENTER, DEFAULT_TOP_K, STATION_CONTEXT_COLUMNS, \
    WEATHER_COLUMNS
from ..functions.weather import weather_bin, weather_bin_order


# ---------------------------------------------------------------------------
# filters (C12, C13, C16, C17)
# ---------------------------------------------------------------------------
def filter_area(df: DataFrame, area: str | None) -> DataFrame:
    """C12: 'All areas' (or None) passes everything through."""
    if area is None or area == "All areas" or "area_label" not in df.columns:
        return df
    return df.filter(F.col("area_label") == area)


def filter_rider(df: DataFrame, rider_type: str = "all", include_rollup: bool = False) -> DataFrame:
    """One rider type; 'all' means the rollup rows unless ``include_rollup``."""
    if rider_type == "all" and include_rollup:
        return df
    return df.filter(F.col("rider_type") == rider_type)


def rider_options(df: DataFrame) -> DataFrame:
    """C16: 'all' first, then the other rider types sorted."""
    riders = df.select("rider_type").dropna().distinct().filter(F.col("rider_type") != "all")
    return (riders.select(F.lit(1).alias("position"), F.col("rider_type").alias("option"))
            .unionByName(df.sparkSession.range(1).select(F.lit(0).alias("position"), F.lit("all").alias("option"))))


def area_options(df: DataFrame) -> DataFrame:
    """C16: 'All areas' first, then the area labels sorted."""
    areas = df.select(F.col("area_label").alias("option")).dropna().distinct()
    return (areas.select(F.lit(1).alias("position"), "option")
            .unionByName(df.sparkSession.range(1).select(F.lit(0).alias("position"), F.lit("All areas").alias("option"))))


def weather_columns_present(df: DataFrame) -> DataFrame:
    """C17: which weather columns hold any non-null value (one aggregate pass)."""
    present = [c for c in WEATHER_COLUMNS if c in df.columns]
    row = df.agg(*[(F.count(c) > 0).alias(c) for c in present])
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("weather_column"), F.col(c).alias("has_values"))
                                          for c in present])).alias("x")).select("x.*")


# ---------------------------------------------------------------------------
# rider summaries
# ---------------------------------------------------------------------------
def rider_type_summary(trips: DataFrame) -> DataFrame:
    """A10: trip-level counts and durations per rider type.

    A rider type holds billions of trips at full scale, so the median duration
    is the histogram-narrowed exact median, not one task's value buffer.
    """
    from .stats import exact_median
    base = trips.groupBy("rider_type").agg(
        F.count("ride_id").alias("trips"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.avg("trip_distance_miles").alias("avg_distance_miles"),
    )
    med = exact_median(trips.dropna(subset=["rider_type"]), ["rider_type"], "duration_min", "median_duration_min",
                       few_groups=True)
    return base.join(med, "rider_type", "left").select(
        "rider_type", "trips", "avg_duration_min", "median_duration_min", "avg_distance_miles")


def rider_summary_from_fact(station_hour: DataFrame) -> DataFrame:
    """The fact-based summary (sum of demand, mean of hourly means), Q6."""
    return station_hour.groupBy("rider_type").agg(
        F.sum("demand").alias("trips"),
        F.avg("avg_duration_min").alias("avg_duration_min"),
        F.avg("avg_trip_distance_miles").alias("avg_distance_miles"),
    )


# ---------------------------------------------------------------------------
# published app aggregates
# ---------------------------------------------------------------------------
def station_map_hour(station_hour: DataFrame) -> DataFrame:
    keys = ["hour", "rider_type", "area_label", "start_station_id", "start_station_name",
            "station_lat", "station_lng", "grid_cell"]
    return station_hour.dropna(subset=keys).groupBy(*keys).agg(
        F.avg("demand").alias("predicted_demand"), F.sum("demand").alias("demand"))


def area_map_hour(area_hour: DataFrame) -> DataFrame:
    keys = ["hour", "rider_type", "area_label", "grid_cell", "region_cluster"]
    return area_hour.dropna(subset=keys).groupBy(*keys).agg(
        F.avg("demand").alias("predicted_demand"), F.sum("demand").alias("demand"),
        F.avg("station_lat").alias("station_lat"), F.avg("station_lng").alias("station_lng"))


def demand_pattern(station_hour: DataFrame, by: str) -> DataFrame:
    """Mean demand by (by, rider, area); sum and rows kept for exact re-aggregation (Q7)."""
    keys = [by, "rider_type", "area_label"]
    return station_hour.dropna(subset=keys).groupBy(*keys).agg(
        F.avg("demand").alias("demand"), F.sum("demand").alias("demand_sum"), F.count(F.lit(1)).alias("row_count"))


def reaggregate_pattern(pattern: DataFrame, by: str, exact: bool = True) -> DataFrame:
    """A16 over a published pattern: exact (sum/rows) or the reference's mean of means."""
    if exact:
        agg = (F.sum("demand_sum") / F.sum("row_count")).alias("demand")
    else:
        agg = F.avg("demand").alias("demand")
    return pattern.groupBy(by, "rider_type").agg(agg)


def chart_pattern(station_hour: DataFrame, by: str) -> DataFrame:
    """A16 + F23: mean demand by (by, rider) with the text label of the chart."""
    out = station_hour.dropna(subset=[by]).groupBy(by, "rider_type").agg(F.avg("demand").alias("demand"))
    if by == "is_weekend":
        out = out.withColumn("day_type", day_type_label("is_weekend"))
    elif by == "is_holiday":
        out = out.withColumn("calendar_type", calendar_type_label("is_holiday"))
    return out


def day_type_label(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == 1, "Weekend").when(c == 0, "Weekday")


def calendar_type_label(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c == 1, "Holiday").when(c == 0, "Non-holiday")


def top_station_summary(station_hour: DataFrame) -> DataFrame:
    """Total demand per (rider, area, station)."""
    keys = ["rider_type", "area_label", "start_station_id", "start_station_name", "station_lat", "station_lng"]
    return station_hour.dropna(subset=keys).groupBy(*keys).agg(F.sum("demand").alias("demand"))


# ---------------------------------------------------------------------------
# hotspots and top-k
# ---------------------------------------------------------------------------
def station_hotspots(station_hour: DataFrame, rider_type: str = "all", top_k: int = DEFAULT_TOP_K,
                     include_rollup: bool = False) -> DataFrame:
    """Stations by total demand, top k (ties: station id)."""
    keys = ["start_station_id", "start_station_name", "station_lat", "station_lng"]
    data = filter_rider(station_hour, rider_type, include_rollup).dropna(subset=keys)
    return (data.groupBy(*keys).agg(F.sum("demand").alias("demand"))
            .orderBy(F.desc("demand"), *keys).limit(top_k))


def area_hotspots(area_hour: DataFrame, rider_type: str = "all", top_k: int = DEFAULT_TOP_K,
                  include_rollup: bool = False) -> DataFrame:
    """(grid, cluster) by total demand, top k."""
    keys = ["grid_cell", "region_cluster"]
    data = filter_rider(area_hour, rider_type, include_rollup).dropna(subset=keys)
    return (data.groupBy(*keys).agg(F.sum("demand").alias("demand"))
            .orderBy(F.desc("demand"), *keys).limit(top_k))


def top_stations(station_hour: DataFrame, rider_type: str = "all", n: int = 20,
                 include_rollup: bool = False) -> DataFrame:
    """Top n station names by demand, returned in ascending demand order (chart order)."""
    data = filter_rider(station_hour, rider_type, include_rollup).dropna(subset=["start_station_name"])
    top = (data.groupBy("start_station_name").agg(F.sum("demand").alias("demand"))
           .orderBy(F.desc("demand"), F.desc("start_station_name")).limit(n))
    return top.orderBy("demand", "start_station_name")


def top_k_with_marker_size(predictions: DataFrame, top_k: int = 50) -> DataFrame:
    """T4: top-k predicted stations and marker radius 4 + 12*d/max (max floored at 1)."""
    top = predictions.orderBy(F.desc("predicted_demand"), "start_station_id").limit(top_k)
    peak = F.greatest(top.select(F.max("predicted_demand")).scalar(), F.lit(1.0))
    return top.withColumn("marker_radius", F.lit(4.0) + F.lit(12.0) * F.col("predicted_demand") / peak)


def map_center(df: DataFrame, lat: str = "station_lat", lng: str = "station_lng") -> DataFrame:
    """T4: mean coordinates, or the fixed default centre when there are no rows."""
    return df.agg(F.coalesce(F.avg(lat), F.lit(DEFAULT_MAP_CENTER[0])).alias("center_lat"),
                  F.coalesce(F.avg(lng), F.lit(DEFAULT_MAP_CENTER[1])).alias("center_lng"))


def flow_line_weights(flows: DataFrame) -> DataFrame:
    """T5: line weight 1 + 6*count/max (max floored at 1), over a bounded top-k flow table."""
    peak = F.greatest(flows.select(F.max("flow_count")).scalar().cast("double"), F.lit(1.0))
    return flows.withColumn("line_weight", F.lit(1.0) + F.lit(6.0) * F.col("flow_count") / peak)


def top_k_keys(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    return df.select(key, value).dropna(subset=[key]).orderBy(F.desc(value), key).limit(k).select(key)


def top_k_agreement(actual: DataFrame, predicted: DataFrame, key: str, k: int = DEFAULT_TOP_K) -> DataFrame:
    """T7 + T8 (J10): overlap of the actual and predicted top-k key sets, and precision@k."""
    a = top_k_keys(actual, "demand", key, k).distinct()
    p = top_k_keys(predicted, "predicted_demand", key, k).distinct()
    overlap = a.join(p, key, "inner")
    n_pred = p.select(F.count(F.lit(1))).scalar()
    n_overlap = overlap.select(F.count(F.lit(1))).scalar()
    return actual.sparkSession.range(1).select(
        n_overlap.alias("top_k_overlap"),
        F.when(n_pred == 0, F.lit(0.0)).otherwise(n_overlap / n_pred).alias("precision_at_k"),
    )


# ---------------------------------------------------------------------------
# overview (A17, A18)
# ---------------------------------------------------------------------------
def overview_metrics(trips: DataFrame, station_hour: DataFrame, include_rollup: bool = False) -> DataFrame:
    """One row of headline numbers, from one aggregate over the trips and one over the fact.

    The fact is rolled up by hour, by station name and by station id in one pass (grouping
    sets); the winners are taken from that small table.
    """
    counted = F.lit(True) if include_rollup else F.col("rider_type") == "all"
    keys = ["hour", "start_station_name", "start_station_id"]
    small = station_hour.groupingSets([[k] for k in keys], *keys).agg(
        F.sum(F.when(counted, F.col("demand"))).alias("_t"), *[F.grouping(k).alias(f"_no_{k}") for k in keys])

    def winner(key):  # the largest total, of equal ones the least key
        held = (F.col(f"_no_{key}") == 0) & F.col(key).isNotNull() & F.col("_t").isNotNull()
        return F.min(F.when(held, F.struct((-F.col("_t")).alias("neg"), F.col(key).alias("k"))))["k"]

    stations = F.count_if((F.col("_no_start_station_id") == 0) & F.col("start_station_id").isNotNull())
    fact = small.agg(stations.alias("stations"), winner("hour").alias("peak_hour"),
                     winner("start_station_name").alias("top_station"))
    numbers = trips.agg(F.count(F.lit(1)).alias("total_trips"), F.min("started_at").alias("date_min"),
                        F.max("started_at").alias("date_max"))
    both = numbers.join(fact, F.lit(True))  # one row each
    return both.select("total_trips", "stations", "date_min", "date_max", "peak_hour", "top_station")


def run_summary(raw: DataFrame, trips: DataFrame, stations: DataFrame, station_hour: DataFrame,
                area_hour: DataFrame, raw_files: int | None = None) -> DataFrame:
    """Files, trips, stations and fact sizes in one row.

    ``raw_files`` is the number of files that were listed; without it the names in ``raw`` are
    counted, which misses files without rows.
    """
    spark = trips.sparkSession
    named = [c for c in ("source_path", "source_file") if c in raw.columns]
    if raw_files is not None or not named:
        files = F.lit(raw_files)
    else:
        files = raw.select(F.countDistinct(named[0])).scalar()
    return spark.range(1).select(
        files.alias("raw_files"),
        trips.select(F.count(F.lit(1))).scalar().alias("clean_trips"),
        stations.select(F.countDistinct("start_station_id")).scalar().alias("stations"),
        station_hour.select(F.count(F.lit(1))).scalar().alias("station_hour_rows"),
        area_hour.select(F.count(F.lit(1))).scalar().alias("area_hour_rows"),
    )


# ---------------------------------------------------------------------------
# weather analysis
# ---------------------------------------------------------------------------
def weather_vs_demand(station_hour: DataFrame, weather_col: str, rider_type: str = "all",
                      include_rollup: bool = False) -> DataFrame:
    """Total demand per hour_start, binned by weather, mean and count per (hour, bin)."""
    data = filter_rider(station_hour, rider_type, include_rollup).dropna(subset=[weather_col])
    hourly = data.groupBy("hour_start", "hour", weather_col).agg(F.sum("demand").alias("demand"))
    binned = hourly.withColumn("weather_bin", weather_bin(weather_col, weather_col)).dropna(subset=["weather_bin"])
    return (binned.groupBy("hour", "weather_bin").agg(
        F.avg("demand").alias("avg_demand"), F.count(F.lit(1)).alias("observations"))
        .withColumn("bin_order", weather_bin_order(weather_col, "weather_bin")))


def weather_binned_demand(station_hour: DataFrame, weather_col: str, rider_type: str = "all",
                          include_rollup: bool = False) -> DataFrame:
    """Demand per hour_start, binned by weather, mean and count per bin."""
    data = filter_rider(station_hour, rider_type, include_rollup).dropna(subset=[weather_col])
    hourly = data.groupBy("hour_start", weather_col).agg(F.sum("demand").alias("demand"))
    binned = hourly.withColumn("weather_bin", weather_bin(weather_col, weather_col)).dropna(subset=["weather_bin"])
    return (binned.groupBy("weather_bin").agg(F.avg("demand").alias("avg_demand"),
                                              F.count(F.lit(1)).alias("observations"))
            .withColumn("bin_order", weather_bin_order(weather_col, "weather_bin")))


def dynamic_bins(df: DataFrame, value_col: str, min_bins: int = 3, max_bins: int = 10) -> DataFrame:
    """equal-width bins, count = clamp(distinct values, 3, 10), lowest edge widened by 0.1%.

    Adds ``bin_index`` (0-based), ``bin_lo``, ``bin_hi`` and a ``(lo, hi]`` label.
    """
    # the one row of statistics meets the rows by a join: as scalar subqueries the whole plan of ``df``
    # would stand in every expression that mentions them, and the driver holds each copy
    stats = df.agg(F.min(value_col).alias("__lo"), F.max(value_col).alias("__hi"), F.least(F.greatest(
        F.countDistinct(value_col), F.lit(min_bins)), F.lit(max_bins)).alias("__n"))
    lo, hi, nbins, v, idx = (F.col(c) for c in ("__lo", "__hi", "__n", value_col, "bin_index"))
    width = (hi - lo) / nbins
    raw_idx = F.when(width == 0, F.lit(0)).otherwise(F.ceil((v - lo) / width) - 1)
    bin_lo = F.when(idx == 0, lo - (hi - lo) * 0.001).otherwise(lo + idx * width)
    out = df.crossJoin(F.broadcast(stats)).withColumn("bin_index", F.when(v.isNotNull(), F.least(F.greatest(
        raw_idx, F.lit(0)), nbins - 1)).cast("int"))
    return out.withColumns({"bin_lo": bin_lo, "bin_hi": lo + (idx + 1) * width}).withColumn(
        "bin_label", F.format_string("(%.3f, %.3f]", "bin_lo", "bin_hi")).drop("__lo", "__hi", "__n")


def weather_category_demand(station_hour: DataFrame, category_col: str, rider_type: str = "all",
                            include_rollup: bool = True) -> DataFrame:
    """Mean demand by (category, rider)."""
    data = filter_rider(station_hour, rider_type, include_rollup).dropna(subset=[category_col])
    return data.groupBy(category_col, "rider_type").agg(F.avg("demand").alias("demand"))


def daily_weather_summary(station_hour: DataFrame, days: int = 60, rider_type: str = "all",
                          include_rollup: bool = False) -> DataFrame:
    """Demand and mean weather per day, the latest ``days`` days."""
    data = filter_rider(station_hour, rider_type, include_rollup)
    daily = data.groupBy(F.to_date("hour_start").alias("date")).agg(
        F.sum("demand").alias("demand"), F.avg("temperature").alias("temperature"),
        F.avg("precipitation").alias("rain"), F.avg("snow").alias("snow"), F.avg("wind_speed").alias("wind_speed"))
    return daily.orderBy(F.desc("date")).limit(days)


def typical_weather(station_hour: DataFrame) -> DataFrame:
    """Median of the four weather values, null -> 0."""
    return station_hour.agg(*[F.coalesce(F.median(c), F.lit(0.0)).alias(c) for c in WEATHER_COLUMNS])


# ---------------------------------------------------------------------------
# historical heat map and predicted areas
# ---------------------------------------------------------------------------
def historical_station_means(station_hour: DataFrame, hour: int | None = None, rider_type: str = "all",
                             include_rollup: bool = False) -> DataFrame:
    """Mean demand per station for one hour of day and rider."""
    data = station_hour if hour is None else station_hour.filter(F.col("hour") == hour)
    data = filter_rider(data, rider_type, include_rollup)
    keys = ["start_station_id", "start_station_name", "station_lat", "station_lng", "grid_cell"]
    return data.dropna(subset=keys).groupBy(*keys).agg(F.avg("demand").alias("predicted_demand"))


def predicted_area_hotspots(predictions: DataFrame) -> DataFrame:
    """Predicted totals per area (or grid + cluster without area labels)."""
    keys = ["area_label"] if "area_label" in predictions.columns else ["grid_cell", "region_cluster"]
    return predictions.dropna(subset=keys).groupBy(*keys).agg(
        F.sum("predicted_demand").alias("predicted_demand"),
        F.avg("station_lat").alias("station_lat"), F.avg("station_lng").alias("station_lng"),
        F.countDistinct("start_station_id").alias("stations"),
    )


# ---------------------------------------------------------------------------
# context windows
# ---------------------------------------------------------------------------
def station_context(station_hour: DataFrame, recent_hours: int | None = DEFAULT_CONTEXT_HOURS) -> DataFrame:
    """The latest N rows per (station, rider); N <= 0 or None keeps all rows."""
    cols = [c for c in STATION_CONTEXT_COLUMNS if c in station_hour.columns]
    data = station_hour.select(*cols)
    if not recent_hours or recent_hours <= 0:
        return data
    w = Window.partitionBy("start_station_id", "rider_type").orderBy(F.desc("hour_start"))
    return data.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= recent_hours).drop("_rn")


# ---------------------------------------------------------------------------
# calendar lookups
# ---------------------------------------------------------------------------
def calendar_for_dates(dates: DataFrame, holidays: DataFrame | None, date_col: str = "date") -> DataFrame:
    """weekend flag, day type, holiday flag and name for each date of a table."""
    out = dates.withColumn("is_weekend", F.weekday(date_col).isin(5, 6).cast("int")) \
        .withColumn("day_type", day_type_label("is_weekend"))
    if holidays is None:
        return out.withColumns({"is_holiday": F.lit(0), "holiday_name": F.lit(None).cast("string")})
    names = holidays.groupBy(F.col("date").alias("_hd")).agg(F.min("holiday_name").alias("holiday_name"))
    out = out.join(names, F.col(date_col) == F.col("_hd"), "left")
    return out.withColumn("is_holiday", F.col("_hd").isNotNull().cast("int")).drop("_hd")
