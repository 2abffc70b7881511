"""Registered source / sink queries.

Inputs are derived from the driver's tables and written as files into the
shared checkpoint folder (``spark.checkpoint.dir`` on a cluster), then read
back through the engine's own readers, so every reader and writer runs on
data that grows with the tables.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from . import oracle as O
from .registry import KEYS, enriched_of, register, stations_of, trips_of
from ..constants import NUMERIC_FEATURES
from ..functions.weather import describe_weather
from ..operators.analysis import dynamic_bins
from ..operators.clean import clean_trips
from ..operators.enrich import merge_weather
from ..operators.models import prepare_numeric
from ..session import checkpoint_dir, materialize, written
from ..sources.addresses import attach_addresses, load_address_cache, upsert_addresses
from ..sources.fixtures import fixture_holidays, fixture_weather, trip_view
from ..sources.sinks import read_table, write_fact, write_small_csv
from ..sources.trips import read_trips
from ..sources.weather import pivot_long_weather, read_weather_csv

E = O.BASE_ENRICHED
T = O.BASE


def scratch(spark, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:8]}")


def _write_trip_csvs(spark, sf: str) -> str:
    """Trip view as text CSV: one file per source file, sorted by ride id, headers in two spellings."""
    root = scratch(spark, "raw-trips")
    raw = trip_view(spark, sf)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns if c != "source_file"],
                      F.col("source_file").alias("f"))
    cols = [c for c in text.columns if c != "f"]
    # keep surrounding spaces: the raw values carry them and cleaning must strip them
    w = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

    def write(part, folder):
        part.repartition("f").sortWithinPartitions("f", part.columns[0]).write.partitionBy("f").options(**w).csv(
            os.path.join(root, "2024", folder))

    # files of part-0 keep the canonical header; the others get "Title Case-with-dashes" headers
    write(text.filter(F.col("f") == "part-0.csv"), "canonical")
    fancy = text.filter(F.col("f") != "part-0.csv").toDF(
        *[c.replace("_", " ").title().replace("Id", "ID") for c in cols], "f")
    write(fancy.withColumnRenamed("Member Casual", "Member-Casual"), "renamed")
    # a generated folder that discovery must skip
    decoy = spark.range(1).select(*[F.lit("decoy").alias(c) for c in cols])
    decoy.write.options(**w).csv(os.path.join(root, "outputs", "skip_me"))
    return root


_RAW = O.with_ctes(O.TRIP_VIEW)
_PICKED = "ride_id, rideable_type, start_station_id, end_station_id, member_casual"


def _picked(df):
    return df.select(*_PICKED.split(", "))


def _sample_sql(order: str, quota: str) -> str:
    return f"""{_RAW}
SELECT {_PICKED} FROM (
  SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY {order}) AS rn FROM raw_trips)
WHERE rn <= {quota}"""


_CSV_COLS = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_id", "start_station_name",
             "end_station_id", "end_station_name", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
             "duration_min", "rider_type", "trip_distance_miles", "hour_start"]


@register("csv_trip_round_trip", T + f"\nSELECT {', '.join(_CSV_COLS)} FROM trips",
          ["start_lat", "start_lng", "end_lat", "end_lng", "duration_min", "trip_distance_miles"],
          ["S1", "S2", "S3", "S4", "U2", "C1", "C4", "C9"])
def q_csv_round_trip(spark, sf):
    root = _write_trip_csvs(spark, sf)
    raw = read_trips(spark, root)
    return clean_trips(raw).select(*_CSV_COLS)


_MD5 = "md5(ride_id || ':42'), ride_id"


@register("csv_head_rows_per_file", _sample_sql("ride_id", "100"), [], ["S5"])
def q_csv_head(spark, sf):
    return _picked(read_trips(spark, _write_trip_csvs(spark, sf), sample_rows=100))


@register("csv_sample_rows_per_file", _sample_sql(_MD5, "500"), [], ["S6", "Q1"])
def q_csv_sample(spark, sf):
    return _picked(read_trips(spark, _write_trip_csvs(spark, sf), sample_rows_per_file=500))


# 1,001 rows over three files: the two first files in path order get one more
@register("csv_balanced_sample",
          _sample_sql(_MD5, "CASE source_file WHEN 'part-2.csv' THEN 333 ELSE 334 END"), [], ["S7"])
def q_csv_balanced(spark, sf):
    return _picked(read_trips(spark, _write_trip_csvs(spark, sf), total_sample_rows=1001))


# ---------------------------------------------------------------------------
# weather: long rows derived from events -> pivot (S9, U3) -> CSV -> reader (S8) -> join
# ---------------------------------------------------------------------------
_TYPE_MAP = {"click": "TMAX", "view": "TMIN", "signup": "PRCP", "purchase": "SNOW", "error": "AWND"}


def _long_weather(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    mapping = F.create_map(*[F.lit(x) for kv in _TYPE_MAP.items() for x in kv])
    return ev.select(F.to_date("ts").alias("date"), mapping[F.col("event_type")].alias("datatype"),
                     (F.col("value") / 10).alias("value"))


_LONG_SQL = """
long_weather AS (
  SELECT CAST(ts AS DATE) AS date,
         CASE event_type WHEN 'click' THEN 'TMAX' WHEN 'view' THEN 'TMIN' WHEN 'signup' THEN 'PRCP'
                         WHEN 'purchase' THEN 'SNOW' WHEN 'error' THEN 'AWND' END AS datatype,
         value / 10 AS value
  FROM events
),
wide_weather AS (
  SELECT date, (avg(value) FILTER (WHERE datatype = 'TMAX') + avg(value) FILTER (WHERE datatype = 'TMIN')) / 2
              AS temperature,
         avg(value) FILTER (WHERE datatype = 'PRCP') AS precipitation,
         avg(value) FILTER (WHERE datatype = 'SNOW') AS snow,
         avg(value) FILTER (WHERE datatype = 'AWND') AS wind_speed
  FROM long_weather GROUP BY date
)"""


@register("weather_pivot", "WITH " + _LONG_SQL.strip() + "\nSELECT * FROM wide_weather",
          ["temperature", "precipitation", "snow", "wind_speed"], ["S9", "U3", "Q2"])
def q_weather_pivot(spark, sf):
    return pivot_long_weather(_long_weather(spark, sf))


@register("weather_csv_join", E.replace("WITH ", "WITH " + _LONG_SQL.strip() + ",", 1) + """
SELECT e.hour_start, e.start_station_id, e.rider_type, w.temperature, w.precipitation, w.snow, w.wind_speed
FROM enriched e LEFT JOIN wide_weather w ON CAST(e.hour_start AS DATE) = w.date""",
          ["temperature", "precipitation", "snow", "wind_speed"], ["S8", "J4"])
def q_weather_csv(spark, sf):
    path = scratch(spark, "weather-csv")
    write_small_csv(pivot_long_weather(_long_weather(spark, sf)).withColumn("date", F.col("date").cast("string")),
                    path)
    kind, weather = read_weather_csv(spark, path)
    return merge_weather(enriched_of(spark, sf), weather, kind).select(*KEYS, "temperature", "precipitation",
                                                                      "snow", "wind_speed")


# several readings per hour (or date), some of them partly null: their mean, whatever the order
def _repeated_weather(spark, sf, key):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    return ev.filter("event_id % 2 = 0").select(
        key, (F.col("value") / 10).alias("temperature"),
        F.when(F.col("event_id") % 4 == 0, F.col("value") / 100).alias("precipitation"),
        F.lit(None).cast("double").alias("snow"), (F.col("event_id") % 7).cast("double").alias("wind_speed"))


def _repeated_sql(key: str, fact_key: str) -> str:
    return E + f"""
SELECT e.hour_start, e.start_station_id, e.rider_type, w.temperature, w.precipitation, w.snow, w.wind_speed
FROM enriched e LEFT JOIN (
  SELECT {key} AS k, avg(value / 10) AS temperature, avg(value / 100) FILTER (event_id % 4 = 0) AS precipitation,
         CAST(NULL AS DOUBLE) AS snow, avg(event_id % 7) AS wind_speed
  FROM events WHERE event_id % 2 = 0 GROUP BY 1) w ON {fact_key} = w.k"""


_W4 = ["temperature", "precipitation", "snow", "wind_speed"]


@register("weather_hourly_duplicates", _repeated_sql("date_trunc('hour', ts)", "e.hour_start"), _W4, ["J3"])
def q_weather_hourly_duplicates(spark, sf):
    weather = _repeated_weather(spark, sf, F.date_trunc("hour", "ts").cast("timestamp").alias("hour_start"))
    return merge_weather(enriched_of(spark, sf), weather, "hourly").select(*KEYS, *_W4)


@register("weather_daily_duplicates", _repeated_sql("CAST(ts AS DATE)", "CAST(e.hour_start AS DATE)"), _W4, ["J4"])
def q_weather_daily_duplicates(spark, sf):
    weather = _repeated_weather(spark, sf, F.to_date("ts").alias("date"))
    return merge_weather(enriched_of(spark, sf), weather, "daily").select(*KEYS, *_W4)


# ---------------------------------------------------------------------------
# fact sink and pruned read
# ---------------------------------------------------------------------------
@register("fact_parquet_round_trip", E + "\nSELECT hour_start, start_station_id, rider_type, demand, "
          "CAST(hour_start AS DATE) AS date FROM enriched", [], ["S11", "S12"])
def q_fact_round_trip(spark, sf):
    path = scratch(spark, "fact")
    write_fact(enriched_of(spark, sf), path)
    return read_table(spark, path, ["hour_start", "start_station_id", "rider_type", "demand", "date"])


def _flow_artifact_sql() -> str:
    from .registry import REGISTRY
    return REGISTRY["flow_summary_artifact"].sql


def _saved_facts(spark, sf) -> str:
    """A folder with the batch build's trips, fact and area tables."""
    from .facts import enriched_area_hour, enriched_station_hour
    root = scratch(spark, "processed")
    # as in the batch build, the facts come from the saved trips: the events are cleaned once
    trips = written(trips_of(spark, sf), os.path.join(root, "clean_trips"))
    fact = enriched_station_hour(trips, fixture_holidays(spark), fixture_weather(spark), stations=stations_of(trips),
                                 cut_lineage=True).drop("region_cluster")
    fact = fact.withColumn("region_cluster", F.substring("start_station_id", 2, 10).cast("int") % 3)
    write_fact(fact, os.path.join(root, "station_hour_demand"))
    saved = read_table(spark, os.path.join(root, "station_hour_demand")).drop("date")
    write_fact(enriched_area_hour(saved, None), os.path.join(root, "area_hour_demand"))
    return root


@register("rebuild_flow_artifact", _flow_artifact_sql(), ["start_lat", "start_lng", "end_lat", "end_lng"],
          ["S13", "A25"])
def q_rebuild(spark, sf):
    """Saved trips alone -> the flow table, without the facts and without retraining."""
    from .pipeline import rebuild_app_artifacts
    root = scratch(spark, "processed")
    trips_of(spark, sf).write.parquet(os.path.join(root, "clean_trips"))
    rebuild_app_artifacts(spark, root)
    return read_table(spark, os.path.join(root, "app_flow_summary"))


_APP_ROWS = E + """,
clustered AS (SELECT *, CAST(substr(start_station_id, 2) AS INTEGER) % 3 AS region_cluster FROM enriched),
area_rows AS (SELECT hour_start, grid_cell, region_cluster, area_label, rider_type FROM clustered GROUP BY ALL)"""


@register("rebuild_after_one_change", _APP_ROWS + """
SELECT * FROM (VALUES
  ('app_area_hour', 'rebuilt'), ('app_area_map_hour', 'rebuilt'), ('app_flow_summary', 'no input'),
  ('app_holiday_patterns', 'current'), ('app_hourly_patterns', 'current'), ('app_rider_summary', 'current'),
  ('app_station_context', 'current'), ('app_station_map_hour', 'current'), ('app_top_station_summary', 'rebuilt'),
  ('app_weekday_patterns', 'current')) t(app_table, became)
WHERE (SELECT count(*) FROM area_rows) > 0""", [], ["S13"])
def q_rebuild_graph(spark, sf):
    """All tables rebuilt; then the area table changes, the trips go and one table is missing."""
    from .pipeline import rebuild_app_artifacts
    from ..sources.trips import _fs
    root = _saved_facts(spark, sf)
    rebuild_app_artifacts(spark, root)
    area = os.path.join(root, "area_hour_demand")
    materialize(read_table(spark, area)).write.mode("overwrite").partitionBy("date").parquet(area)
    for gone in ("clean_trips", "app_top_station_summary"):
        fs, p = _fs(spark, os.path.join(root, gone))
        fs.delete(p, True)
    return spark.createDataFrame(sorted(rebuild_app_artifacts(spark, root).items()), "app_table string, became string")


@register("artifacts_loaded", _APP_ROWS + """,
recent AS (SELECT 1 FROM enriched
  QUALIFY row_number() OVER (PARTITION BY start_station_id, rider_type ORDER BY hour_start DESC) <= 168),
patterns AS (SELECT 'hourly_patterns' AS artifact, count(*) AS n FROM (SELECT DISTINCT hour, rider_type, area_label FROM enriched)
  UNION ALL SELECT 'weekday_patterns', count(*) FROM (SELECT DISTINCT is_weekend, rider_type, area_label FROM enriched)
  UNION ALL SELECT 'holiday_patterns', count(*) FROM (SELECT DISTINCT is_holiday, rider_type, area_label FROM enriched))
SELECT 'station_hour' AS artifact, count(*) AS row_count FROM recent
UNION ALL SELECT 'area_hour', count(*) FROM area_rows
UNION ALL SELECT 'rider_summary', count(DISTINCT rider_type) FROM enriched
UNION ALL SELECT 'top_stations', count(*) FROM (SELECT DISTINCT rider_type, area_label, start_station_id FROM enriched)
UNION ALL SELECT artifact, n FROM patterns""", [], ["S14"])
def q_artifacts(spark, sf):
    """What the app loads, from rebuilt tables, with one table left to its fallback."""
    from .pipeline import load_artifacts, rebuild_app_artifacts
    from ..sources.trips import _fs
    root = _saved_facts(spark, sf)
    rebuild_app_artifacts(spark, root)
    fs, p = _fs(spark, os.path.join(root, "app_weekday_patterns"))
    fs.delete(p, True)
    found = load_artifacts(spark, root)
    names = ["station_hour", "area_hour", "rider_summary", "top_stations", "hourly_patterns", "weekday_patterns",
             "holiday_patterns"]
    counts = [found[n].agg(F.count("*").alias("row_count")).select(F.lit(n).alias("artifact"), "row_count") for n in names]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def _scored_sql() -> str:
    from . import queries_model  # noqa: F401  (registers the scores)
    from .registry import REGISTRY
    return REGISTRY["scenario_scores"].sql


@register("scored_results_round_trip", _scored_sql(), ["predicted_demand"], ["S18"])
def q_scored(spark, sf):
    """Scored stations and areas written as the app exports them, and read back."""
    from .pipeline import write_scored
    from .queries_model import SCENARIO, FixedScorer, written_fact
    from ..operators.scenario import predict_station_demand
    root = scratch(spark, "scored")
    preds = materialize(predict_station_demand(written_fact(spark, sf), [SCENARIO], FixedScorer(), fixture_holidays(spark)))
    areas = preds.groupBy("area_label").agg(F.sum("predicted_demand").alias("predicted_demand"))
    write_scored(preds.select("start_station_id", "start_station_name", "area_label", "predicted_demand"), areas, root)
    back = spark.read.option("header", True).schema(
        "start_station_id string, start_station_name string, area_label string, predicted_demand double").csv(
        os.path.join(root, "predicted_stations"))
    totals = spark.read.option("header", True).schema("area_label string, predicted_demand double").csv(
        os.path.join(root, "predicted_areas"))
    # an area's total must be that of its stations, else its rows are left out
    sums = back.groupBy("area_label").agg(F.sum("predicted_demand").alias("s"))
    same = totals.join(sums, "area_label").where(F.abs(F.col("s") - F.col("predicted_demand")) < 1e-6)
    return back.join(same.select("area_label"), "area_label", "left_semi").select("start_station_id", "predicted_demand")


# ---------------------------------------------------------------------------
# address cache
# ---------------------------------------------------------------------------
@register("station_addresses", T + """,
st AS (SELECT DISTINCT start_station_id FROM trips)
SELECT start_station_id,
       CASE WHEN CAST(substr(start_station_id, 2) AS INTEGER) % 3 = 0 THEN NULL
            WHEN CAST(substr(start_station_id, 2) AS INTEGER) % 2 = 0 THEN 'updated ' || start_station_id
            ELSE 'first ' || start_station_id END AS display_address
FROM st""", [], ["S15", "S16"])
def q_addresses(spark, sf):
    path = scratch(spark, "addresses")
    stations = trips_of(spark, sf).select("start_station_id").distinct()
    n = F.substring("start_station_id", 2, 10).cast("int")
    first = stations.filter(n % 3 != 0).select(
        F.col("start_station_id").alias("station_id"), F.lit("x").alias("station_name"),
        F.lit(40.7).alias("lat"), F.lit(-74.0).alias("lng"),
        F.concat(F.lit("first "), F.col("start_station_id")).alias("display_address"))
    upsert_addresses(spark, path, first)
    second = first.filter(n % 2 == 0).withColumn("display_address",
                                                 F.concat(F.lit("updated "), F.col("station_id")))
    upsert_addresses(spark, path, second)
    return attach_addresses(stations, load_address_cache(spark, path))


# ---------------------------------------------------------------------------
# model persistence
# ---------------------------------------------------------------------------
@register("model_save_load", E + """
SELECT hour_start, start_station_id, rider_type, true AS same_after_loading, true AS within_cap FROM enriched""",
          [], ["S17"])
def q_model_io(spark, sf):
    from ..operators.models import DemandModel
    from .queries_model import Trained
    t = Trained(spark, sf)
    model, path = t.model(), scratch(spark, "model")
    model.save(path)
    again = DemandModel.load(spark, path)
    both = again.predict(model.predict(t.table("fact"), "first"), "second")
    return both.select(*KEYS, (F.abs(F.col("first") - F.col("second")) < 1e-9).alias("same_after_loading"),
                       F.col("second").between(0.0, model.prediction_cap).alias("within_cap"))


# ---------------------------------------------------------------------------
# remaining column functions
# ---------------------------------------------------------------------------
@register("weather_description", E + """
SELECT hour_start, start_station_id, rider_type,
  CASE WHEN temperature IS NULL THEN 'Unknown temperature' WHEN temperature < 0 THEN 'Freezing'
       WHEN temperature < 10 THEN 'Cold' WHEN temperature < 22 THEN 'Mild' ELSE 'Hot' END || '; ' ||
  CASE WHEN precipitation IS NULL OR precipitation <= 0 THEN 'No rain' WHEN precipitation <= 2.5 THEN 'Light rain'
       WHEN precipitation <= 10 THEN 'Moderate rain' ELSE 'Heavy rain' END || '; ' ||
  CASE WHEN snow IS NULL OR snow <= 0 THEN 'No snow' WHEN snow <= 10 THEN 'Light snow'
       WHEN snow <= 50 THEN 'Moderate snow' ELSE 'Heavy snow' END || '; ' ||
  CASE WHEN wind_speed IS NULL THEN 'Unknown wind' WHEN wind_speed < 3 THEN 'Light wind'
       WHEN wind_speed < 8 THEN 'Moderate wind' ELSE 'Strong wind' END AS weather_description
FROM enriched""", [], ["F18"])
def q_weather_description(spark, sf):
    return enriched_of(spark, sf).select(
        *KEYS, describe_weather("temperature", "precipitation", "snow", "wind_speed").alias("weather_description"))


@register("dynamic_bins", E + """,
stats AS (SELECT min(avg_trip_distance_miles) AS lo, max(avg_trip_distance_miles) AS hi,
                 least(greatest(count(DISTINCT avg_trip_distance_miles), 3), 10) AS nb FROM enriched),
b AS (SELECT e.hour_start, e.start_station_id, e.rider_type, e.avg_trip_distance_miles AS v, s.lo, s.hi, s.nb,
             (s.hi - s.lo) / s.nb AS w FROM enriched e CROSS JOIN stats s WHERE e.avg_trip_distance_miles IS NOT NULL),
i AS (SELECT *, CAST(least(greatest(CASE WHEN w = 0 THEN 0 ELSE ceil((v - lo) / w) - 1 END, 0), nb - 1) AS INTEGER)
             AS bin_index FROM b)
SELECT hour_start, start_station_id, rider_type, bin_index,
       CASE WHEN bin_index = 0 THEN lo - (hi - lo) * 0.001 ELSE lo + bin_index * w END AS bin_lo,
       lo + (bin_index + 1) * w AS bin_hi
FROM i""", ["bin_lo", "bin_hi"], ["F20"])
def q_dynamic_bins(spark, sf):
    binned = dynamic_bins(enriched_of(spark, sf), "avg_trip_distance_miles")
    return binned.dropna(subset=["avg_trip_distance_miles"]).select(*KEYS, "bin_index", "bin_lo", "bin_hi")


_NUM = [c for c in NUMERIC_FEATURES]


@register("numeric_features", E + "\nSELECT hour_start, start_station_id, rider_type, " + ", ".join(
    # without KMeans ids: no cluster column (-> 0) and an all-null cluster mean (-> median fill)
    "CAST(0.0 AS DOUBLE) AS region_cluster" if c == "region_cluster" else
    "CAST((SELECT m FROM med) AS DOUBLE) AS cluster_hour_mean" if c == "cluster_hour_mean" else
    f"coalesce(CAST({c} AS DOUBLE), CAST(0.0 AS DOUBLE)) AS {c}" for c in _NUM) + " FROM enriched", _NUM, ["F25"])
def q_numeric(spark, sf):
    return prepare_numeric(enriched_of(spark, sf)).select(*KEYS, *_NUM)


# hourly weather (J3): one row per event hour, written with a ``timestamp`` column
_HOURLY_SQL = """
hourly_weather AS (
  SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS hour_start, max(value) / 10 AS temperature,
         min(value) / 100 AS precipitation, CAST(0.0 AS DOUBLE) AS snow, min(value) AS wind_speed
  FROM events GROUP BY 1
)"""


@register("weather_hourly_join", E.replace("WITH ", "WITH " + _HOURLY_SQL.strip() + ",", 1) + """
SELECT e.hour_start, e.start_station_id, e.rider_type, w.temperature, w.precipitation, w.snow, w.wind_speed,
  CASE WHEN w.wind_speed IS NULL THEN 'Unknown wind' WHEN w.wind_speed < 3 THEN 'Light wind'
       WHEN w.wind_speed < 8 THEN 'Moderate wind' ELSE 'Strong wind' END AS wind_intensity
FROM enriched e LEFT JOIN hourly_weather w ON e.hour_start = w.hour_start""",
          ["temperature", "precipitation", "snow", "wind_speed"], ["J3", "S8"])
def q_weather_hourly(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    hourly = ev.groupBy(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour")).agg(
        (F.max("value") / 10).alias("temperature"), (F.min("value") / 100).alias("precipitation"),
        F.lit(0.0).alias("snow"), F.min("value").alias("wind_speed"))
    path = scratch(spark, "weather-hourly-csv")
    write_small_csv(hourly.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
                                  "temperature", "precipitation", "snow", "wind_speed"), path)
    kind, weather = read_weather_csv(spark, path)
    out = merge_weather(enriched_of(spark, sf), weather, kind)
    return out.select(*KEYS, "temperature", "precipitation", "snow", "wind_speed", "wind_intensity")
