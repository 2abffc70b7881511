"""Registered analysis and flow queries (added to the registry on import).

Each Spark plan reads the trip view over ``events``; each SQL string is the
same computation written independently for DuckDB.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from . import oracle as O
from .registry import (FACT_DOUBLES, LAG_DOUBLES, enriched_of, register, trips_of)
from ..constants import STATION_CONTEXT_COLUMNS, WEATHER_BIN_LABELS
from ..operators import analysis as A
from ..operators import flows as FL
from ..operators.demand import area_hour_demand
from ..operators.enrich import ensure_area_label
from ..operators.stations import one_row_per_station, station_display_options
from ..sources.fixtures import fixture_holidays

E = O.BASE_ENRICHED  # WITH ... enriched AS (...)
T = O.BASE           # WITH ... trips AS (...)


def _labels_list(col: str) -> str:
    return "[" + ", ".join(O.q(x) for x in WEATHER_BIN_LABELS[col]) + "]"


# ---------------------------------------------------------------------------
# rider summaries
# ---------------------------------------------------------------------------
@register("rider_type_summary", T + """
SELECT rider_type, count(ride_id) AS trips, avg(duration_min) AS avg_duration_min,
       median(duration_min) AS median_duration_min, avg(trip_distance_miles) AS avg_distance_miles
FROM trips GROUP BY rider_type""", ["avg_duration_min", "median_duration_min", "avg_distance_miles"], ["A10"])
def q_rider_type_summary(spark, sf):
    return A.rider_type_summary(trips_of(spark, sf))


@register("rider_summary_from_fact", E + """
SELECT rider_type, CAST(sum(demand) AS BIGINT) AS trips, avg(avg_duration_min) AS avg_duration_min,
       avg(avg_trip_distance_miles) AS avg_distance_miles
FROM enriched GROUP BY rider_type""", ["avg_duration_min", "avg_distance_miles"], ["A11"])
def q_rider_summary_from_fact(spark, sf):
    return A.rider_summary_from_fact(enriched_of(spark, sf))


# ---------------------------------------------------------------------------
# published app aggregates
# ---------------------------------------------------------------------------
_SMH_KEYS = "hour, rider_type, area_label, start_station_id, start_station_name, station_lat, station_lng, grid_cell"


@register("station_map_hour", E + f"""
SELECT {_SMH_KEYS}, avg(demand) AS predicted_demand, CAST(sum(demand) AS BIGINT) AS demand
FROM enriched GROUP BY {_SMH_KEYS}""", ["station_lat", "station_lng", "predicted_demand"], ["A12"])
def q_station_map_hour(spark, sf):
    return A.station_map_hour(enriched_of(spark, sf))


def _pattern_sql(by: str) -> str:
    return E + f"""
SELECT {by}, rider_type, area_label, avg(demand) AS demand, CAST(sum(demand) AS BIGINT) AS demand_sum,
       count(*) AS row_count
FROM enriched WHERE {by} IS NOT NULL AND area_label IS NOT NULL GROUP BY {by}, rider_type, area_label"""


for _by, _name in [("hour", "hourly_patterns"), ("is_weekend", "weekday_patterns"), ("is_holiday", "holiday_patterns")]:
    register(_name, _pattern_sql(_by), ["demand"], ["A14"])(
        (lambda by: lambda spark, sf: A.demand_pattern(enriched_of(spark, sf), by))(_by))


@register("hourly_pattern_mean_of_means", E + """
SELECT hour, rider_type, avg(demand) AS demand FROM (
  SELECT hour, rider_type, area_label, avg(demand) AS demand FROM enriched
  WHERE area_label IS NOT NULL GROUP BY hour, rider_type, area_label)
GROUP BY hour, rider_type""", ["demand"], ["A16", "Q7"])
def q_pattern_mom(spark, sf):
    return A.reaggregate_pattern(A.demand_pattern(enriched_of(spark, sf), "hour"), "hour", exact=False)


@register("hourly_pattern_exact", E + """
SELECT hour, rider_type, avg(demand) AS demand FROM enriched WHERE area_label IS NOT NULL
GROUP BY hour, rider_type""", ["demand"], ["A16", "Q7"])
def q_pattern_exact(spark, sf):
    return A.reaggregate_pattern(A.demand_pattern(enriched_of(spark, sf), "hour"), "hour", exact=True)


@register("chart_weekday_pattern", E + """
SELECT is_weekend, rider_type, avg(demand) AS demand,
       CASE WHEN is_weekend = 1 THEN 'Weekend' WHEN is_weekend = 0 THEN 'Weekday' END AS day_type
FROM enriched GROUP BY is_weekend, rider_type""", ["demand"], ["A16", "F23"])
def q_chart_weekday(spark, sf):
    return A.chart_pattern(enriched_of(spark, sf), "is_weekend")


@register("chart_holiday_pattern", E + """
SELECT is_holiday, rider_type, avg(demand) AS demand,
       CASE WHEN is_holiday = 1 THEN 'Holiday' WHEN is_holiday = 0 THEN 'Non-holiday' END AS calendar_type
FROM enriched GROUP BY is_holiday, rider_type""", ["demand"], ["A16", "F23"])
def q_chart_holiday(spark, sf):
    return A.chart_pattern(enriched_of(spark, sf), "is_holiday")


@register("hourly_pattern_in_area", E + """
SELECT hour, rider_type, area_label, avg(demand) AS demand, CAST(sum(demand) AS BIGINT) AS demand_sum,
       count(*) AS row_count
FROM enriched WHERE area_label = 'Queens' GROUP BY hour, rider_type, area_label""", ["demand"], ["C12", "A14"])
def q_pattern_area(spark, sf):
    return A.demand_pattern(A.filter_area(enriched_of(spark, sf), "Queens"), "hour")


_TSS = "rider_type, area_label, start_station_id, start_station_name, station_lat, station_lng"


@register("top_station_summary", E + f"""
SELECT {_TSS}, CAST(sum(demand) AS BIGINT) AS demand FROM enriched GROUP BY {_TSS}""",
          ["station_lat", "station_lng"], ["A15"])
def q_top_station_summary(spark, sf):
    return A.top_station_summary(enriched_of(spark, sf))


# ---------------------------------------------------------------------------
# area rollup: several stations per grid cell, which a cluster id may cut apart (KMeans has no
# SQL form, so here the id is a rule of the fixture)
# ---------------------------------------------------------------------------
_AREA_SQL = E + """,
area_hour AS (
  SELECT hour_start, grid_cell, CAST(CAST(substr(start_station_id, 2) AS INTEGER) % 4 // 2 AS INTEGER) AS region_cluster,
         area_label, rider_type, CAST(sum(demand) AS BIGINT) AS demand,
         avg(station_lat) AS station_lat, avg(station_lng) AS station_lng,
         count(DISTINCT start_station_id) AS stations
  FROM enriched GROUP BY ALL
)"""


def _area_hour_spark(spark, sf):
    number = F.substring("start_station_id", 2, 10).cast("int") % 4
    fact = enriched_of(spark, sf).drop("region_cluster")
    return area_hour_demand(fact.withColumn("region_cluster", F.floor(number / 2).cast("int")))


@register("area_hour_demand", _AREA_SQL + f"""
SELECT hour_start, grid_cell, region_cluster, area_label, rider_type, demand, station_lat, station_lng, stations,
       {O.time_features('hour_start')} FROM area_hour""",
          ["station_lat", "station_lng", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"],
          ["A3"])
def q_area_hour(spark, sf):
    return _area_hour_spark(spark, sf)


@register("area_map_hour", _AREA_SQL + """
SELECT CAST(hour(hour_start) AS INTEGER) AS hour, rider_type, area_label, grid_cell, region_cluster,
       avg(demand) AS predicted_demand, CAST(sum(demand) AS BIGINT) AS demand, avg(station_lat) AS station_lat,
       avg(station_lng) AS station_lng
FROM area_hour GROUP BY hour(hour_start), rider_type, area_label, grid_cell, region_cluster""",
          ["predicted_demand", "station_lat", "station_lng"], ["A13"])
def q_area_map_hour(spark, sf):
    return A.area_map_hour(_area_hour_spark(spark, sf))


@register("area_hotspots", _AREA_SQL + """
SELECT grid_cell, region_cluster, CAST(sum(demand) AS BIGINT) AS demand FROM area_hour WHERE rider_type = 'all'
GROUP BY grid_cell, region_cluster ORDER BY demand DESC, grid_cell, region_cluster LIMIT 20""", [], ["T2"])
def q_area_hotspots(spark, sf):
    return A.area_hotspots(_area_hour_spark(spark, sf), "all", 20)


# ---------------------------------------------------------------------------
# hotspots, top stations, overview
# ---------------------------------------------------------------------------
_HOT = "start_station_id, start_station_name, station_lat, station_lng"


@register("station_hotspots", E + f"""
SELECT {_HOT}, CAST(sum(demand) AS BIGINT) AS demand FROM enriched WHERE rider_type = 'all'
GROUP BY {_HOT} ORDER BY demand DESC, {_HOT} LIMIT 20""", ["station_lat", "station_lng"], ["T1", "C13"])
def q_station_hotspots(spark, sf):
    return A.station_hotspots(enriched_of(spark, sf), "all", 20)


@register("station_hotspots_member", E + f"""
SELECT {_HOT}, CAST(sum(demand) AS BIGINT) AS demand FROM enriched WHERE rider_type = 'member'
GROUP BY {_HOT} ORDER BY demand DESC, {_HOT} LIMIT 5""", ["station_lat", "station_lng"], ["T1", "C13"])
def q_station_hotspots_member(spark, sf):
    return A.station_hotspots(enriched_of(spark, sf), "member", 5)


@register("top_stations_casual", E + """
SELECT start_station_name, demand FROM (
  SELECT start_station_name, CAST(sum(demand) AS BIGINT) AS demand FROM enriched WHERE rider_type = 'casual'
  GROUP BY start_station_name ORDER BY demand DESC, start_station_name DESC LIMIT 15)""", [], ["T3"])
def q_top_stations(spark, sf):
    return A.top_stations(enriched_of(spark, sf), "casual", 15)


@register("overview_metrics", E + """
SELECT (SELECT count(*) FROM trips) AS total_trips,
       (SELECT count(DISTINCT start_station_id) FROM enriched) AS stations,
       (SELECT min(started_at) FROM trips) AS date_min,
       (SELECT max(started_at) FROM trips) AS date_max,
       (SELECT hour FROM (SELECT hour, sum(demand) AS t FROM enriched WHERE rider_type = 'all' GROUP BY hour)
        ORDER BY t DESC, hour LIMIT 1) AS peak_hour,
       (SELECT start_station_name FROM (SELECT start_station_name, sum(demand) AS t FROM enriched
        WHERE rider_type = 'all' GROUP BY start_station_name) ORDER BY t DESC, start_station_name LIMIT 1) AS top_station
""", [], ["A17"])
def q_overview(spark, sf):
    trips = trips_of(spark, sf)
    from .facts import enriched_station_hour
    from ..operators.stations import station_metadata
    from ..sources.fixtures import fixture_weather
    fact = enriched_station_hour(trips, fixture_holidays(spark), fixture_weather(spark),
                                 stations=station_metadata(trips, cluster=False))
    return A.overview_metrics(trips, fact)


@register("run_summary", E + """
SELECT (SELECT count(DISTINCT source_file) FROM raw_trips) AS raw_files,
       (SELECT count(*) FROM trips) AS clean_trips,
       (SELECT count(DISTINCT start_station_id) FROM stations) AS stations,
       (SELECT count(*) FROM enriched) AS station_hour_rows,
       (SELECT count(*) FROM (SELECT DISTINCT hour_start, grid_cell, area_label, rider_type,
         CAST(substr(start_station_id, 2) AS INTEGER) % 4 // 2 FROM enriched)) AS area_hour_rows
""", [], ["A18"])
def q_run_summary(spark, sf):
    from ..operators.stations import station_metadata
    from ..sources.fixtures import fixture_weather, trip_view
    from .facts import enriched_station_hour
    from ..operators.clean import clean_trips
    raw = trip_view(spark, sf)
    trips = clean_trips(raw)
    number = F.substring("start_station_id", 2, 10).cast("int") % 4
    stations = station_metadata(trips, cluster=False).drop("region_cluster").withColumn(
        "region_cluster", F.floor(number / 2).cast("int"))
    fact = enriched_station_hour(trips, fixture_holidays(spark), fixture_weather(spark), stations=stations)
    return A.run_summary(raw, trips, stations, fact, area_hour_demand(fact))


# ---------------------------------------------------------------------------
# weather analysis
# ---------------------------------------------------------------------------
def _weather_vs_sql(col: str) -> str:
    return E + f""",
hourly AS (SELECT hour_start, hour, {col}, CAST(sum(demand) AS BIGINT) AS demand FROM enriched
           WHERE rider_type = 'all' AND {col} IS NOT NULL GROUP BY hour_start, hour, {col}),
binned AS (SELECT *, {O.weather_bin(col, col)} AS weather_bin FROM hourly)
SELECT hour, weather_bin, avg(demand) AS avg_demand, count(*) AS observations,
       CAST(list_position({_labels_list(col)}, weather_bin) AS INTEGER) AS bin_order
FROM binned WHERE weather_bin IS NOT NULL GROUP BY hour, weather_bin"""


def _weather_binned_sql(col: str) -> str:
    return E + f""",
hourly AS (SELECT hour_start, {col}, CAST(sum(demand) AS BIGINT) AS demand FROM enriched
           WHERE rider_type = 'all' AND {col} IS NOT NULL GROUP BY hour_start, {col}),
binned AS (SELECT *, {O.weather_bin(col, col)} AS weather_bin FROM hourly)
SELECT weather_bin, avg(demand) AS avg_demand, count(*) AS observations,
       CAST(list_position({_labels_list(col)}, weather_bin) AS INTEGER) AS bin_order
FROM binned WHERE weather_bin IS NOT NULL GROUP BY weather_bin"""


for _col in ["temperature", "precipitation"]:
    register(f"weather_vs_demand_{_col}", _weather_vs_sql(_col), ["avg_demand"], ["A19", "F19", "Q16"])(
        (lambda c: lambda spark, sf: A.weather_vs_demand(enriched_of(spark, sf), c))(_col))
for _col in ["wind_speed", "snow"]:
    register(f"weather_binned_demand_{_col}", _weather_binned_sql(_col), ["avg_demand"], ["A20", "F19"])(
        (lambda c: lambda spark, sf: A.weather_binned_demand(enriched_of(spark, sf), c))(_col))


@register("weather_category_demand", E + """
SELECT rain_intensity, rider_type, avg(demand) AS demand FROM enriched WHERE rain_intensity IS NOT NULL
GROUP BY rain_intensity, rider_type""", ["demand"], ["A21"])
def q_weather_category(spark, sf):
    return A.weather_category_demand(enriched_of(spark, sf), "rain_intensity")


@register("daily_weather_summary", E + """
SELECT CAST(hour_start AS DATE) AS date, CAST(sum(demand) AS BIGINT) AS demand, avg(temperature) AS temperature,
       avg(precipitation) AS rain, avg(snow) AS snow, avg(wind_speed) AS wind_speed
FROM enriched WHERE rider_type = 'all' GROUP BY CAST(hour_start AS DATE) ORDER BY date DESC LIMIT 60""",
          ["temperature", "rain", "snow", "wind_speed"], ["A22"])
def q_daily_weather(spark, sf):
    return A.daily_weather_summary(enriched_of(spark, sf))


@register("typical_weather", E + """
SELECT coalesce(median(temperature), 0.0) AS temperature, coalesce(median(precipitation), 0.0) AS precipitation,
       coalesce(median(snow), 0.0) AS snow, coalesce(median(wind_speed), 0.0) AS wind_speed FROM enriched""",
          ["temperature", "precipitation", "snow", "wind_speed"], ["A23"])
def q_typical_weather(spark, sf):
    return A.typical_weather(enriched_of(spark, sf))


@register("weather_columns_present", E + """
SELECT * FROM (VALUES
  ('temperature', (SELECT count(temperature) > 0 FROM enriched)),
  ('precipitation', (SELECT count(precipitation) > 0 FROM enriched)),
  ('snow', (SELECT count(snow) > 0 FROM enriched)),
  ('wind_speed', (SELECT count(wind_speed) > 0 FROM enriched))) AS t(weather_column, has_values)""", [], ["C17"])
def q_weather_present(spark, sf):
    return A.weather_columns_present(enriched_of(spark, sf))


# ---------------------------------------------------------------------------
# heat map, predicted areas, top-k agreement, markers
# ---------------------------------------------------------------------------
_HSM = "start_station_id, start_station_name, station_lat, station_lng, grid_cell"
_HSM_SQL = f"""SELECT {_HSM}, avg(demand) AS predicted_demand FROM enriched
WHERE hour = 8 AND rider_type = 'all' GROUP BY {_HSM}"""


@register("historical_station_means", E + "\n" + _HSM_SQL, ["station_lat", "station_lng", "predicted_demand"], ["A27"])
def q_hist_means(spark, sf):
    return A.historical_station_means(enriched_of(spark, sf), hour=8)


@register("predicted_area_hotspots", E + """,
preds AS (SELECT start_station_id, start_station_name, station_lat, station_lng, area_label,
                 avg(demand) AS predicted_demand FROM enriched WHERE rider_type = 'all'
          GROUP BY start_station_id, start_station_name, station_lat, station_lng, area_label)
SELECT area_label, sum(predicted_demand) AS predicted_demand, avg(station_lat) AS station_lat,
       avg(station_lng) AS station_lng, count(DISTINCT start_station_id) AS stations
FROM preds GROUP BY area_label""", ["predicted_demand", "station_lat", "station_lng"], ["A28"])
def q_pred_area(spark, sf):
    preds = (enriched_of(spark, sf).filter(F.col("rider_type") == "all")
             .groupBy("start_station_id", "start_station_name", "station_lat", "station_lng", "area_label")
             .agg(F.avg("demand").alias("predicted_demand")))
    return A.predicted_area_hotspots(preds)


@register("top_k_agreement", E + f""",
actual AS (SELECT start_station_id, sum(demand) AS demand FROM enriched WHERE rider_type = 'all'
           GROUP BY start_station_id),
a AS (SELECT start_station_id FROM actual ORDER BY demand DESC, start_station_id LIMIT 5),
p AS (SELECT start_station_id FROM ({_HSM_SQL}) ORDER BY predicted_demand DESC, start_station_id LIMIT 5)
SELECT (SELECT count(*) FROM a JOIN p USING (start_station_id)) AS top_k_overlap,
       CASE WHEN (SELECT count(*) FROM p) = 0 THEN 0.0
            ELSE (SELECT count(*) FROM a JOIN p USING (start_station_id)) / (SELECT count(*) FROM p) END
       AS precision_at_k""", ["precision_at_k"], ["T7", "T8", "J10"])
def q_topk(spark, sf):
    fact = enriched_of(spark, sf)
    actual = fact.filter(F.col("rider_type") == "all").groupBy("start_station_id").agg(F.sum("demand").alias("demand"))
    return A.top_k_agreement(actual, A.historical_station_means(fact, hour=8), "start_station_id", 5)


@register("top_k_markers", E + f"""
SELECT *, CAST(4.0 AS DOUBLE) + CAST(12.0 AS DOUBLE) * predicted_demand
          / greatest(max(predicted_demand) OVER (), CAST(1.0 AS DOUBLE)) AS marker_radius
FROM ({_HSM_SQL} ORDER BY predicted_demand DESC, start_station_id LIMIT 10)""",
          ["station_lat", "station_lng", "predicted_demand", "marker_radius"], ["T4"])
def q_markers(spark, sf):
    return A.top_k_with_marker_size(A.historical_station_means(enriched_of(spark, sf), hour=8), 10)


@register("map_center", E + f"""
SELECT coalesce(avg(station_lat), CAST(40.73 AS DOUBLE)) AS center_lat,
       coalesce(avg(station_lng), CAST(-74.03 AS DOUBLE)) AS center_lng FROM ({_HSM_SQL})""",
          ["center_lat", "center_lng"], ["T4"])
def q_center(spark, sf):
    return A.map_center(A.historical_station_means(enriched_of(spark, sf), hour=8))


# ---------------------------------------------------------------------------
# context, options, calendar lookups, display
# ---------------------------------------------------------------------------
_CTX = [c for c in STATION_CONTEXT_COLUMNS if c != "region_cluster"]
_CTX_DOUBLES = [c for c in _CTX if c in FACT_DOUBLES + LAG_DOUBLES + ["temperature", "precipitation", "snow", "wind_speed"]]


@register("station_context", E + f"""
SELECT {', '.join(_CTX)} FROM enriched
QUALIFY row_number() OVER (PARTITION BY start_station_id, rider_type ORDER BY hour_start DESC) <= 168""",
          _CTX_DOUBLES, ["W7"])
def q_context(spark, sf):
    return A.station_context(enriched_of(spark, sf), 168)


@register("rider_options", E + """
SELECT 1 AS position, rider_type AS option FROM (SELECT DISTINCT rider_type FROM enriched
  WHERE rider_type IS NOT NULL AND rider_type <> 'all')
UNION ALL SELECT 0 AS position, 'all' AS option""", [], ["C16"])
def q_rider_options(spark, sf):
    return A.rider_options(enriched_of(spark, sf))


@register("area_options", E + """
SELECT 1 AS position, area_label AS option FROM (SELECT DISTINCT area_label FROM enriched WHERE area_label IS NOT NULL)
UNION ALL SELECT 0 AS position, 'All areas' AS option""", [], ["C16"])
def q_area_options(spark, sf):
    return A.area_options(enriched_of(spark, sf))


@register("calendar_for_dates", E + """
SELECT d.date, CAST(isodow(d.date) IN (6, 7) AS INTEGER) AS is_weekend,
       CASE WHEN isodow(d.date) IN (6, 7) THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       CASE WHEN d.date = DATE '2024-01-01' THEN 'New Year''s Day'
            WHEN d.date = DATE '2024-01-15' THEN 'Martin Luther King Jr. Day' END AS holiday_name,
       CAST(d.date IN (DATE '2024-01-01', DATE '2024-01-15') AS INTEGER) AS is_holiday
FROM (SELECT DISTINCT CAST(hour_start AS DATE) AS date FROM enriched) d""", [], ["F22"])
def q_calendar(spark, sf):
    dates = enriched_of(spark, sf).select(F.to_date("hour_start").alias("date")).distinct()
    return A.calendar_for_dates(dates, fixture_holidays(spark))


@register("one_row_per_station", E + """
SELECT start_station_id, start_station_name, area_label, station_lat, station_lng FROM enriched
QUALIFY row_number() OVER (PARTITION BY start_station_id ORDER BY hour_start, rider_type) = 1""",
          ["station_lat", "station_lng"], ["C18"])
def q_one_row(spark, sf):
    cols = ["start_station_id", "start_station_name", "area_label", "station_lat", "station_lng", "hour_start", "rider_type"]
    return one_row_per_station(enriched_of(spark, sf).select(*cols)).drop("hour_start", "rider_type")


@register("station_display_options", E + """
SELECT start_station_id, start_station_name,
       printf('%s | %s | %s | %.5f, %.5f', start_station_id, start_station_name, area_label, station_lat, station_lng) AS label
FROM enriched
QUALIFY row_number() OVER (PARTITION BY start_station_id ORDER BY start_station_name, area_label, station_lat, station_lng) = 1""",
          [], ["F21"])
def q_display(spark, sf):
    return station_display_options(enriched_of(spark, sf))


@register("trips_area_label", T + f"""
SELECT ride_id, {O.area('start_lat', 'start_lng')} AS area_label FROM trips""", [], ["C14", "F11"])
def q_area_label(spark, sf):
    return ensure_area_label(trips_of(spark, sf)).select("ride_id", "area_label")


# ---------------------------------------------------------------------------
# flows
# ---------------------------------------------------------------------------
_FLOW_BASE = T + """,
flow_src AS (
  SELECT *, CAST(isodow(started_at) - 1 AS INTEGER) AS day_of_week, CAST(hour(started_at) AS INTEGER) AS hour
  FROM trips
)"""
_MED = ("count(ride_id) AS flow_count, median(start_lat) AS start_lat, median(start_lng) AS start_lng, "
        "median(end_lat) AS end_lat, median(end_lng) AS end_lng")
_FLOW_DOUBLES = ["start_lat", "start_lng", "end_lat", "end_lng"]


@register("flow_summary", _FLOW_BASE + f""",
flows AS (
  SELECT day_of_week, hour, CASE WHEN grouping(rider_type) = 1 THEN 'all' ELSE rider_type END AS rider_type,
         start_station_name, end_station_name, {_MED}
  FROM flow_src
  WHERE end_station_id IS NOT NULL AND end_station_name IS NOT NULL AND end_lat IS NOT NULL AND end_lng IS NOT NULL
  GROUP BY GROUPING SETS ((day_of_week, hour, rider_type, start_station_name, end_station_name),
                          (day_of_week, hour, start_station_name, end_station_name))
)
SELECT * FROM flows
QUALIFY row_number() OVER (PARTITION BY day_of_week, hour, rider_type
                           ORDER BY flow_count DESC, start_station_name, end_station_name) <= 30""",
          _FLOW_DOUBLES, ["A24", "W6", "U1"])
def q_flow_summary(spark, sf):
    return FL.flow_summary(trips_of(spark, sf))


@register("flow_summary_artifact", _FLOW_BASE + f""",
flows AS (
  SELECT day_of_week, hour, rider_type, start_station_name, end_station_name, {_MED}
  FROM flow_src WHERE end_station_name IS NOT NULL AND end_lat IS NOT NULL AND end_lng IS NOT NULL
  GROUP BY day_of_week, hour, rider_type, start_station_name, end_station_name
)
SELECT * FROM flows
QUALIFY row_number() OVER (PARTITION BY day_of_week, hour, rider_type
                           ORDER BY flow_count DESC, start_station_name, end_station_name) <= 30""",
          _FLOW_DOUBLES, ["A25", "Q8"])
def q_flow_artifact(spark, sf):
    return FL.flow_summary(trips_of(spark, sf), with_all=False, require_end_station_id=False)


def _trend_sql(where: str) -> str:
    return _FLOW_BASE + f"""
SELECT start_station_name, end_station_name, {_MED} FROM flow_src
WHERE {where} AND end_station_id IS NOT NULL AND start_station_name IS NOT NULL AND end_station_name IS NOT NULL
GROUP BY start_station_name, end_station_name
ORDER BY flow_count DESC, start_station_name, end_station_name LIMIT 30"""


@register("predict_flow_trends", _trend_sql("day_of_week = 2 AND hour = 17"), _FLOW_DOUBLES, ["A26"])
def q_flow_trends(spark, sf):
    return FL.predict_flow_trends(trips_of(spark, sf), day_of_week=2, hour=17)


@register("predict_flow_trends_area_member",
          _trend_sql(f"day_of_week = 0 AND hour = 9 AND rider_type = 'member' AND "
                     f"{O.area('start_lat', 'start_lng')} = 'Other'"), _FLOW_DOUBLES, ["A26", "C14"])
def q_flow_trends_area(spark, sf):
    return FL.predict_flow_trends(trips_of(spark, sf), day_of_week=0, hour=9, rider_type="member", area="Other")


_T6_SQL = _FLOW_BASE + f""",
flows AS (
  SELECT day_of_week, hour, CASE WHEN grouping(rider_type) = 1 THEN 'all' ELSE rider_type END AS rider_type,
         start_station_name, end_station_name, {_MED}
  FROM flow_src
  WHERE end_station_id IS NOT NULL AND end_station_name IS NOT NULL AND end_lat IS NOT NULL AND end_lng IS NOT NULL
  GROUP BY GROUPING SETS ((day_of_week, hour, rider_type, start_station_name, end_station_name),
                          (day_of_week, hour, start_station_name, end_station_name))
),
top AS (SELECT * FROM flows QUALIFY row_number() OVER (PARTITION BY day_of_week, hour, rider_type
        ORDER BY flow_count DESC, start_station_name, end_station_name) <= 30),
hour_flows AS (SELECT * FROM top WHERE day_of_week = 0 AND hour = 8 AND rider_type =
        CASE WHEN (SELECT count(*) FROM top WHERE rider_type = 'member') > 0 THEN 'member' ELSE 'all' END
        ORDER BY flow_count DESC, start_station_name, end_station_name LIMIT 30)"""


@register("flows_for_hour", _T6_SQL + "\nSELECT * FROM hour_flows", _FLOW_DOUBLES, ["T6"])
def q_flows_for_hour(spark, sf):
    return FL.flows_for_hour(FL.flow_summary(trips_of(spark, sf)), 0, 8, "member")


@register("flow_line_weights", _T6_SQL + """
SELECT *, CAST(1.0 AS DOUBLE) + CAST(6.0 AS DOUBLE) * flow_count
          / greatest(CAST(max(flow_count) OVER () AS DOUBLE), CAST(1.0 AS DOUBLE)) AS line_weight
FROM hour_flows""", _FLOW_DOUBLES + ["line_weight"], ["T5"])
def q_line_weights(spark, sf):
    return A.flow_line_weights(FL.flows_for_hour(FL.flow_summary(trips_of(spark, sf)), 0, 8, "member"))
