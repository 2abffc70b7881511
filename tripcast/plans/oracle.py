"""DuckDB SQL for the correctness oracle.

Each registered query has an equivalent plain-SQL form built from the common
table expressions below (trip view -> clean trips -> stations -> fact ->
enriched fact).  Every numeric literal that feeds a float computation is cast
to DOUBLE, so both engines do the same IEEE arithmetic.
"""
from __future__ import annotations

import math

from ..constants import (AREA_BOXES, DAYPART_UPPER_EDGES, DEMAND_TIERS, EARTH_RADIUS_MILES,
                         EVENING_PEAK_HOURS, MORNING_PEAK_HOURS, PEAK_HOURS, RAIN_EDGES, RAIN_LABELS,
                         SEASON_MONTHS, SNOW_EDGES, SNOW_LABELS, TEMPERATURE_EDGES, TEMPERATURE_LABELS,
                         WEATHER_BIN_EDGES, WEATHER_BIN_LABELS, WIND_EDGES, WIND_LABELS)


def d(x) -> str:
    """A double literal."""
    return f"CAST({x!r} AS DOUBLE)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ints(xs) -> str:
    return ", ".join(str(x) for x in xs)


# ---------------------------------------------------------------------------
# Column expressions
# ---------------------------------------------------------------------------
def haversine(lat1, lon1, lat2, lon2) -> str:
    r = {k: f"radians({v})" for k, v in dict(a=lat1, b=lon1, c=lat2, e=lon2).items()}
    inner = (f"pow(sin(({r['c']} - {r['a']}) / 2), 2) + cos({r['a']}) * cos({r['c']}) "
             f"* pow(sin(({r['e']} - {r['b']}) / 2), 2)")
    return f"{d(2 * EARTH_RADIUS_MILES)} * asin(sqrt({inner}))"


def grid(lat, lng) -> str:
    part = lambda c: f"CAST(CAST(floor(CAST({c} AS DOUBLE) / {d(0.01)}) AS BIGINT) AS VARCHAR)"
    return f"({part(lat)} || '_' || {part(lng)})"


def area(lat, lng) -> str:
    whens = " ".join(
        f"WHEN {lat} BETWEEN {d(a)} AND {d(b)} AND {lng} BETWEEN {d(c)} AND {d(e)} THEN {q(n)}"
        for n, a, b, c, e in reversed(AREA_BOXES))
    return f"(CASE {whens} ELSE 'Other' END)"


def tier(c) -> str:
    whens = " ".join(f"WHEN {c} < {b} THEN {q(label)}" for b, label in DEMAND_TIERS)
    return f"(CASE WHEN {c} IS NULL OR isnan({c}) THEN 'unknown' {whens} ELSE 'very_high' END)"


def season(m) -> str:
    return (f"(CASE WHEN {m} IN ({ints(SEASON_MONTHS['winter'])}) THEN 'winter' "
            f"WHEN {m} IN ({ints(SEASON_MONTHS['spring'])}) THEN 'spring' "
            f"WHEN {m} IN ({ints(SEASON_MONTHS['summer'])}) THEN 'summer' ELSE 'fall' END)")


def daypart(h) -> str:
    whens = " ".join(f"WHEN {h} <= {u} THEN {q(label)}" for u, label in DAYPART_UPPER_EDGES)
    return f"(CASE {whens} END)"


def _upper_closed(v, edges, outs) -> str:
    parts = [f"WHEN {v} IS NULL OR isnan({v}) OR {v} <= {d(edges[0])} THEN {outs[0]}"]
    parts += [f"WHEN {v} <= {d(e)} THEN {o}" for e, o in zip(edges[1:], outs[1:])]
    return f"(CASE {' '.join(parts)} ELSE {outs[-1]} END)"


def _lower_closed(v, edges, outs) -> str:
    parts = [f"WHEN {v} IS NULL OR isnan({v}) THEN {outs[0]}"]
    parts += [f"WHEN {v} < {d(e)} THEN {o}" for e, o in zip(edges, outs[1:])]
    return f"(CASE {' '.join(parts)} ELSE {outs[-1]} END)"


def weather_categories(prefix: str = "") -> str:
    p = prefix
    lv = lambda n: [str(i) for i in range(n)]
    return ", ".join([
        _upper_closed(f"{p}precipitation", RAIN_EDGES, [q(x) for x in RAIN_LABELS]) + " AS rain_intensity",
        f"CAST({_upper_closed(f'{p}precipitation', RAIN_EDGES, lv(4))} AS INTEGER) AS rain_level",
        _upper_closed(f"{p}snow", SNOW_EDGES, [q(x) for x in SNOW_LABELS]) + " AS snow_intensity",
        f"CAST({_upper_closed(f'{p}snow', SNOW_EDGES, lv(4))} AS INTEGER) AS snow_level",
        _lower_closed(f"{p}wind_speed", WIND_EDGES, [q(x) for x in WIND_LABELS]) + " AS wind_intensity",
        f"CAST({_lower_closed(f'{p}wind_speed', WIND_EDGES, lv(4))} AS INTEGER) AS wind_level",
        _lower_closed(f"{p}temperature", TEMPERATURE_EDGES, [q(x) for x in TEMPERATURE_LABELS]) + " AS temperature_band",
        f"CAST({_lower_closed(f'{p}temperature', TEMPERATURE_EDGES, lv(5))} AS INTEGER) AS temperature_level",
    ])


def weather_bin(v, col) -> str:
    edges, labels = WEATHER_BIN_EDGES[col], WEATHER_BIN_LABELS[col]
    parts = [f"WHEN {v} IS NULL OR isnan({v}) OR {v} < {d(edges[0])} OR {v} > {d(edges[-1])} THEN NULL"]
    parts += [f"WHEN {v} <= {d(e)} THEN {q(label)}" for e, label in zip(edges[1:], labels)]
    return f"(CASE {' '.join(parts)} END)"


def time_features(t: str = "hour_start") -> str:
    two_pi = d(2 * math.pi)
    flag = lambda cond: f"CAST({cond} AS INTEGER)"
    return ", ".join([
        f"CAST(year({t}) AS INTEGER) AS year", f"CAST(month({t}) AS INTEGER) AS month",
        f"CAST(day({t}) AS INTEGER) AS day", f"CAST(hour({t}) AS INTEGER) AS hour",
        f"CAST(minute({t}) AS INTEGER) AS minute", f"CAST(isodow({t}) - 1 AS INTEGER) AS day_of_week",
        f"{flag(f'isodow({t}) IN (6, 7)')} AS is_weekend",
        f"CAST(week({t}) AS INTEGER) AS week_of_year",
        f"{season(f'month({t})')} AS season",
        f"{flag(f'hour({t}) IN ({ints(PEAK_HOURS)})')} AS peak_hour",
        f"{flag(f'hour({t}) IN ({ints(MORNING_PEAK_HOURS)})')} AS morning_peak",
        f"{flag(f'hour({t}) IN ({ints(EVENING_PEAK_HOURS)})')} AS evening_peak",
        f"{flag(f'isodow({t}) IN (6, 7) AND hour({t}) BETWEEN 11 AND 17')} AS weekend_peak",
        f"sin({two_pi} * hour({t}) / 24) AS hour_sin", f"cos({two_pi} * hour({t}) / 24) AS hour_cos",
        f"sin({two_pi} * (isodow({t}) - 1) / 7) AS dow_sin", f"cos({two_pi} * (isodow({t}) - 1) / 7) AS dow_cos",
        f"sin({two_pi} * month({t}) / 12) AS month_sin", f"cos({two_pi} * month({t}) / 12) AS month_cos",
        f"{daypart(f'hour({t})')} AS daypart",
    ])


# ---------------------------------------------------------------------------
# Common table expressions
# ---------------------------------------------------------------------------
def _station(n):
    return f"'S' || lpad(CAST({n} AS VARCHAR), 6, '0')"


def _lat(n):
    return (f"{d(40.562)} + CAST((({n}) // 4) % 20 AS DOUBLE) * {d(0.015)} "
            f"+ CAST(({n}) % 4 AS DOUBLE) * {d(0.000371373)}")


def _lng(n):
    return f"{d(-74.088)} + CAST(((({n}) // 4) * 7 + (({n}) // 80)) % 20 AS DOUBLE) * {d(0.017)}"


TRIP_VIEW = f"""
ev AS (
  SELECT event_id, ts, value, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS st
  FROM events
),
raw_trips AS (
  SELECT CAST(event_id AS VARCHAR) AS ride_id,
    CASE WHEN k % 2 = 0 THEN 'classic_bike' ELSE ' Electric_Bike ' END AS rideable_type,
    CAST(ts AS TIMESTAMP) AS started_at,
    CAST(ts AS TIMESTAMP) + to_seconds(CAST(round(value * 60) AS BIGINT)) AS ended_at,
    {_station('st')} AS start_station_id,
    'Station ' || CAST(st AS VARCHAR) AS start_station_name,
    CASE WHEN k % 20 = 19 THEN NULL ELSE {_station('k')} END AS end_station_id,
    CASE WHEN k % 20 = 19 THEN NULL ELSE 'Station ' || CAST(k AS VARCHAR) END AS end_station_name,
    {_lat('st')} AS start_lat,
    {_lng('st')} AS start_lng,
    CASE WHEN k % 20 = 19 THEN NULL ELSE {_lat('k')} END AS end_lat,
    CASE WHEN k % 20 = 19 THEN NULL ELSE {_lng('k')} END AS end_lng,
    CASE WHEN event_type IN ('click', 'view', 'signup') THEN ' Member ' ELSE 'casual' END AS member_casual,
    'part-' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS source_file
  FROM ev
)"""

RAW_DUPLICATES = """
raw_dups AS (
  SELECT * FROM raw_trips
  UNION ALL
  SELECT * REPLACE (started_at + INTERVAL 5 MINUTE AS started_at, ended_at + INTERVAL 5 MINUTE AS ended_at)
  FROM raw_trips WHERE CAST(ride_id AS BIGINT) % 97 = 0
)"""

RAW_RENAMED = """
raw_renamed AS (
  SELECT r.* REPLACE (CASE WHEN e.st = 0 AND e.k >= 50 THEN r.start_station_name || ' (renamed)'
                           ELSE r.start_station_name END AS start_station_name)
  FROM raw_trips r JOIN ev e ON r.ride_id = CAST(e.event_id AS VARCHAR)
)"""


def clean(source: str = "raw_trips") -> str:
    box = lambda lat, lng: (f"{lat} BETWEEN {d(40.0)} AND {d(41.2)} AND {lng} BETWEEN {d(-75.0)} AND {d(-73.0)}")
    return f"""
nn AS (
  SELECT * FROM {source}
  WHERE ride_id IS NOT NULL AND started_at IS NOT NULL AND ended_at IS NOT NULL
    AND start_station_id IS NOT NULL AND start_station_name IS NOT NULL AND start_lat IS NOT NULL
    AND start_lng IS NOT NULL AND member_casual IS NOT NULL AND rideable_type IS NOT NULL
),
dedup AS (
  SELECT * FROM nn
  QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY source_file, started_at, ended_at) = 1
),
boxed AS (
  SELECT *, CAST(epoch_us(ended_at) - epoch_us(started_at) AS DOUBLE) / {d(60000000.0)} AS duration_min
  FROM dedup
  WHERE {box('start_lat', 'start_lng')}
    AND (end_lat IS NULL OR end_lat BETWEEN {d(40.0)} AND {d(41.2)})
    AND (end_lng IS NULL OR end_lng BETWEEN {d(-75.0)} AND {d(-73.0)})
),
trips AS (
  SELECT ride_id, lower(trim(rideable_type)) AS rideable_type, started_at, ended_at,
    start_station_id, start_station_name, end_station_id, end_station_name,
    start_lat, start_lng, end_lat, end_lng, member_casual, source_file, duration_min,
    lower(trim(member_casual)) AS rider_type,
    {haversine('start_lat', 'start_lng', 'end_lat', 'end_lng')} AS trip_distance_miles,
    date_trunc('hour', started_at) AS hour_start
  FROM boxed
  WHERE duration_min BETWEEN 1 AND 1440
)"""


STATIONS = f"""
station_names AS (
  SELECT start_station_id, start_station_name, median(start_lat) AS station_lat,
         median(start_lng) AS station_lng, count(ride_id) AS trips
  FROM trips GROUP BY start_station_id, start_station_name
),
stations AS (
  SELECT start_station_id, start_station_name, station_lat, station_lng, trips,
         {grid('station_lat', 'station_lng')} AS grid_cell, {area('station_lat', 'station_lng')} AS area_label
  FROM station_names
  QUALIFY row_number() OVER (PARTITION BY start_station_id ORDER BY trips DESC, start_station_name) = 1
)"""

FACT = f"""
counts AS (
  SELECT hour_start, start_station_id,
         CASE WHEN grouping(rider_type) = 1 THEN 'all' ELSE rider_type END AS rider_type,
         count(ride_id) AS demand, avg(duration_min) AS avg_duration_min,
         avg(trip_distance_miles) AS avg_trip_distance_miles
  FROM trips
  GROUP BY GROUPING SETS ((hour_start, start_station_id, rider_type), (hour_start, start_station_id))
),
fact AS (
  SELECT c.*, s.start_station_name, s.station_lat, s.station_lng, s.grid_cell, s.area_label,
         {time_features('c.hour_start')}
  FROM counts c LEFT JOIN stations s ON c.start_station_id = s.start_station_id
)"""

HOLIDAYS = """
holidays AS (SELECT DATE '2024-01-01' AS date UNION ALL SELECT DATE '2024-01-15'),
fact_h AS (
  SELECT f.*, CAST(h1.date IS NOT NULL AS INTEGER) AS is_holiday,
         CAST(h2.date IS NOT NULL AS INTEGER) AS is_pre_holiday
  FROM fact f
  LEFT JOIN holidays h1 ON CAST(f.hour_start AS DATE) = h1.date
  LEFT JOIN holidays h2 ON CAST(f.hour_start AS DATE) + 1 = h2.date
)"""

WEATHER = """
weather AS (
  SELECT DATE '2024-01-01' + CAST(i AS INTEGER) AS date,
         CAST((i * 7) % 40 - 8 AS DOUBLE) AS temperature, CAST((i % 5) * 3 AS DOUBLE) AS precipitation,
         CAST((i % 7) * 10 AS DOUBLE) AS snow, CAST((i % 6) * 2 AS DOUBLE) AS wind_speed
  FROM range(29) t(i)
)"""

_W = "PARTITION BY start_station_id, rider_type ORDER BY hour_start"


def _rows(n):
    return f"(PARTITION BY start_station_id, rider_type ORDER BY hour_start ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


LAGS = f"""
lagged AS (
  SELECT *,
    CAST(lag(demand, 1) OVER ({_W}) AS DOUBLE) AS lag_1h,
    CAST(lag(demand, 24) OVER ({_W}) AS DOUBLE) AS lag_24h,
    CAST(lag(demand, 168) OVER ({_W}) AS DOUBLE) AS lag_168h,
    avg(demand) OVER {_rows(24)} AS rolling_mean_24h,
    avg(demand) OVER {_rows(3)} AS rolling_mean_3h,
    avg(demand) OVER {_rows(6)} AS rolling_mean_6h,
    avg(demand) OVER {_rows(168)} AS rolling_mean_168h,
    CAST(max(demand) OVER {_rows(24)} AS DOUBLE) AS rolling_max_24h,
    CAST(min(demand) OVER {_rows(24)} AS DOUBLE) AS rolling_min_24h,
    avg(demand) OVER (PARTITION BY start_station_id, rider_type, day_of_week, hour) AS historical_profile_demand,
    avg(demand) OVER (PARTITION BY start_station_id, rider_type, hour) AS station_hour_mean,
    median(demand) OVER (PARTITION BY start_station_id, rider_type, hour) AS station_hour_median,
    avg(demand) OVER (PARTITION BY start_station_id, rider_type) AS station_avg_demand,
    CAST(sum(demand) OVER (PARTITION BY start_station_id, rider_type) AS BIGINT) AS station_total_demand,
    avg(demand) OVER (PARTITION BY grid_cell, rider_type, hour) AS area_hour_mean,
    avg(demand) OVER (PARTITION BY grid_cell, rider_type) AS area_avg_demand,
    CAST(sum(demand) OVER (PARTITION BY grid_cell, rider_type) AS BIGINT) AS area_total_demand
  FROM fact_h
),
area_hourly AS (
  SELECT grid_cell, rider_type, hour_start, CAST(sum(demand) AS BIGINT) AS area_demand
  FROM fact_h GROUP BY grid_cell, rider_type, hour_start
),
area_lags AS (
  SELECT grid_cell, rider_type, hour_start,
    CAST(lag(area_demand, 1) OVER (PARTITION BY grid_cell, rider_type ORDER BY hour_start) AS DOUBLE) AS area_lag_1h,
    CAST(lag(area_demand, 24) OVER (PARTITION BY grid_cell, rider_type ORDER BY hour_start) AS DOUBLE) AS area_lag_24h,
    avg(area_demand) OVER (PARTITION BY grid_cell, rider_type ORDER BY hour_start
                           ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS area_rolling_mean_24h
  FROM area_hourly
),
med AS (SELECT median(demand) AS m FROM fact_h),
enriched0 AS (
  SELECT l.* EXCLUDE (lag_1h, lag_24h, lag_168h, rolling_mean_24h, rolling_mean_3h, rolling_mean_6h,
                      rolling_mean_168h, rolling_max_24h, rolling_min_24h),
    coalesce(l.lag_1h, med.m) AS lag_1h, coalesce(l.lag_24h, med.m) AS lag_24h,
    coalesce(l.lag_168h, med.m) AS lag_168h,
    coalesce(l.rolling_mean_24h, med.m) AS rolling_mean_24h, coalesce(l.rolling_mean_3h, med.m) AS rolling_mean_3h,
    coalesce(l.rolling_mean_6h, med.m) AS rolling_mean_6h, coalesce(l.rolling_mean_168h, med.m) AS rolling_mean_168h,
    coalesce(l.rolling_max_24h, med.m) AS rolling_max_24h, coalesce(l.rolling_min_24h, med.m) AS rolling_min_24h,
    coalesce(l.lag_1h - l.lag_24h, med.m) AS trend_24h,
    coalesce(a.area_lag_1h, med.m) AS area_lag_1h, coalesce(a.area_lag_24h, med.m) AS area_lag_24h,
    coalesce(a.area_rolling_mean_24h, med.m) AS area_rolling_mean_24h,
    {tier('l.station_avg_demand')} AS station_demand_tier,
    {tier('l.area_avg_demand')} AS area_demand_tier
  FROM lagged l
  LEFT JOIN area_lags a ON l.grid_cell = a.grid_cell AND l.rider_type = a.rider_type AND l.hour_start = a.hour_start
  CROSS JOIN med
),
enriched AS (
  SELECT e.*, w.temperature, w.precipitation, w.snow, w.wind_speed, {weather_categories('w.')}
  FROM enriched0 e LEFT JOIN weather w ON CAST(e.hour_start AS DATE) = w.date
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


BASE = with_ctes(TRIP_VIEW, clean())
BASE_FACT = with_ctes(TRIP_VIEW, clean(), STATIONS, FACT)
BASE_ENRICHED = with_ctes(TRIP_VIEW, clean(), STATIONS, FACT, HOLIDAYS, WEATHER, LAGS)
