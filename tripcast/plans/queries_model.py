"""Registered clustering, model and scenario queries.

Model training and KMeans have no plain-SQL form; those queries are checked on
row counts (and by invariant tests).  The scenario feature frame -- everything
the model sees -- does have one, and is checked against DuckDB.
"""
from __future__ import annotations

import datetime as dt
import hashlib
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from . import oracle as O
from .queries_eval import _SPLIT_SQL
from .registry import enriched_of, register, trips_of
from ..operators.scenario import (Scenario, build_scenario_frame, forecast_trend, intensity_comparison,
                                  predict_station_demand, typical_weather_values, weather_profile_table)
from ..operators import analysis as A
from ..operators.stations import station_metadata
from ..operators import evaluation as EV
from ..session import checkpoint_dir, short_methods, written
from ..sources.fixtures import fixture_holidays, fixture_weather
from ..sources.sinks import path_exists
from .facts import enriched_station_hour
from .training import load_model, save_models, train_models

E = O.BASE_ENRICHED


def clustered_fact(spark, sf):
    """Enriched fact with KMeans cluster ids; who reads it more than once writes it first."""
    trips = written(trips_of(spark, sf))  # read by the stations' medians and the fact: cleaned once
    return enriched_station_hour(trips, fixture_holidays(spark), fixture_weather(spark),
                                 stations=station_metadata(trips, cluster=True), cut_lineage=True)


class Trained:
    """All candidates at full settings, trained once per application, input folder and kind of
    run; everything is saved in the shared folder and read from there."""

    def __init__(self, spark, sf, riders: bool = False):
        key = hashlib.md5(f"{spark.sparkContext.applicationId}|{sf}|{riders}".encode()).hexdigest()
        self.spark, self.folder = spark, f"{checkpoint_dir(spark).rstrip('/')}/trained-{key}"
        if path_exists(spark, f"{self.folder}/about"):
            return
        with short_methods(spark):
            fact = written(clustered_fact(spark, sf), f"{self.folder}/fact")
        res = train_models(fact, train_rider_models=riders)
        best = res["models"][res["best_model_name"]]
        tables = {"ranking": res["ranking"], "predictions": res["test_predictions"], "backtest": res["backtest"],
                  "importance": spark.createDataFrame(res["feature_importance"], "feature string, importance double")}
        if riders:
            tables["riders"] = res["rider_metrics"]
        # small tables: each is a few short jobs, so they are written beside one another
        write = inheritable_thread_target(spark)(
            lambda name: tables[name].write.mode("overwrite").parquet(f"{self.folder}/{name}"))
        with ThreadPoolExecutor(len(tables)) as pool:
            writing = [pool.submit(write, name) for name in tables]
            save_models(f"{self.folder}/models", best, res.get("rider_models", {}))
            for one in writing:
                one.result()
        # written last: it says that the rest is complete
        spark.createDataFrame([(best.name, float(res["prediction_cap"]))], "best string, prediction_cap double") \
            .write.mode("overwrite").parquet(f"{self.folder}/about")

    def table(self, name: str):
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def model(self, rider_type: str = "all"):
        return load_model(self.spark, f"{self.folder}/models", rider_type)


def written_fact(spark, sf):
    """Enriched fact for scenario plans, which read it once per grain: written once, all columns used."""
    return written(enriched_of(spark, sf, cut_lineage=True))


SCENARIO = Scenario(future_time=dt.datetime(2024, 2, 1, 8, 30), rider_type="member", temperature=5.0)


@register("station_clusters", None, [], ["A30", "A1", "H7"])
def q_clusters(spark, sf):
    return station_metadata(trips_of(spark, sf), cluster=True)


_CENTRES = [(40.60, -74.05), (40.65, -73.95), (40.70, -73.85), (40.75, -74.0), (40.80, -73.9)]


@register("station_clusters_fixed", O.with_ctes(O.TRIP_VIEW, O.clean(), O.STATIONS) + f""",
centres AS (SELECT * FROM (VALUES {', '.join(f'({i}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))' for i, (a, b) in enumerate(_CENTRES))}) c(i, a, b))
SELECT start_station_id, CAST(arg_min(i, pow(station_lat - a, 2) + pow(station_lng - b, 2)) AS INTEGER) AS region_cluster
FROM stations CROSS JOIN centres GROUP BY start_station_id""", [], ["A30"])
def q_clusters_fixed(spark, sf):
    from ..operators.stations import assign_clusters
    return assign_clusters(station_metadata(trips_of(spark, sf), cluster=False), _CENTRES).select(
        "start_station_id", "region_cluster")


@register("station_hour_enriched", None, [], ["A2", "W1", "A6", "J1", "J2", "J3", "J4", "J5"])
def q_enriched_full(spark, sf):
    return clustered_fact(spark, sf)


@register("model_ranking", None, [], ["M3", "M4", "M5", "M6", "M7", "M8", "M9", "M10", "M11", "M12", "M13",
                                      "M14", "M15", "H3", "H4", "Q12"])
def q_model_ranking(spark, sf):
    return Trained(spark, sf).table("ranking")


_RIDER_ROWS = """
riders AS (SELECT rider_type, count(*) AS n FROM enriched WHERE rider_type IN ('member', 'casual') GROUP BY rider_type)"""


@register("model_invariants", _SPLIT_SQL + """
SELECT model, (SELECT count(*) FROM labelled WHERE split = 'test') AS test_rows, true AS within_cap,
       true AS beats_mean
FROM (VALUES ('random_forest'), ('gbt'), ('gbt_smooth'), ('gbt_robust'), ('gbt_tweedie')) m(model)""", [],
          ["M5", "M6", "M7", "M8", "M12"])
def q_model_invariants(spark, sf):
    t = Trained(spark, sf)
    cap = t.table("about").select("prediction_cap").scalar()
    return t.table("predictions").groupBy("model").agg(
        F.count("*").alias("test_rows"), ((F.min("pred") >= 0) & (F.max("pred") <= F.max(cap))).alias("within_cap"),
        (F.sum((F.col("y") - F.col("pred")) ** 2) < F.var_pop("y") * F.count("*")).alias("beats_mean"))


@register("rider_model_invariants", E + "," + _RIDER_ROWS + """
SELECT rider_type, n >= 1000 AS trained, n AS n_rows, CASE WHEN n >= 1000 THEN true END AS beats_mean FROM riders""",
          [], ["M21"])
def q_rider_invariants(spark, sf):
    return Trained(spark, sf, riders=True).table("riders").select("rider_type", "trained", "n_rows",
                                                                 (F.col("R2") > 0).alias("beats_mean"))


@register("model_hotspot_metrics", None, [], ["M18"])
def q_model_hotspot(spark, sf):
    return EV.hotspot_classification(Trained(spark, sf).table("predictions"))


@register("model_backtest", None, [], ["M19", "U5"])
def q_model_backtest(spark, sf):
    return Trained(spark, sf).table("backtest")


@register("feature_importance", None, [], ["M20"])
def q_importance(spark, sf):
    return Trained(spark, sf).table("importance")


@register("rider_model_metrics", None, [], ["M21"])
def q_rider_models(spark, sf):
    return Trained(spark, sf, riders=True).table("riders")


@register("scenario_predictions", None, [], ["P5", "P1", "J9", "M14"])
def q_scenario_predictions(spark, sf):
    t = Trained(spark, sf)
    preds = predict_station_demand(t.table("fact"), [SCENARIO], t.model(), fixture_holidays(spark))
    return preds.select("scenario_id", "start_station_id", "start_station_name", "area_label",
                        "predicted_demand").orderBy(F.desc("predicted_demand"), "start_station_id")


@register("predicted_area_totals", None, [], ["A28", "P5"])
def q_predicted_area_totals(spark, sf):
    t = Trained(spark, sf)
    preds = predict_station_demand(t.table("fact"), [SCENARIO], t.model(), fixture_holidays(spark))
    return A.predicted_area_hotspots(preds).orderBy(F.desc("predicted_demand"))


@register("forecast_trend_24h", None, [], ["P6", "U4", "P9"])
def q_trend(spark, sf):
    t = Trained(spark, sf)
    return forecast_trend(t.table("fact"), SCENARIO, t.model(), periods=24, holidays=fixture_holidays(spark))


@register("intensity_comparison", None, [], ["P8", "P7"])
def q_intensity(spark, sf):
    t = Trained(spark, sf)
    fact = t.table("fact")
    return intensity_comparison(fact, SCENARIO, t.model(), "Rain", typical_weather_values(fact), fixture_holidays(spark))


@register("weather_profiles", E + """,
typical AS (SELECT coalesce(median(temperature), 0.0) AS temperature, coalesce(median(precipitation), 0.0) AS precipitation,
                   coalesce(median(snow), 0.0) AS snow, coalesce(median(wind_speed), 0.0) AS wind_speed FROM enriched),
profiles AS (SELECT * FROM (VALUES
  ('Clear', NULL, NULL, 0.0, 0.0, NULL),
  ('Rain', 'Light rain (0-2.5 mm)', NULL, 1.5, 0.0, NULL),
  ('Rain', 'Moderate rain (2.5-10 mm)', NULL, 6.0, 0.0, NULL),
  ('Rain', 'Heavy rain (>10 mm)', NULL, 15.0, 0.0, NULL),
  ('Snow', 'Light snow (0-10 mm)', -2.0, 0.0, 5.0, NULL),
  ('Snow', 'Moderate snow (10-50 mm)', -2.0, 0.0, 25.0, NULL),
  ('Snow', 'Heavy snow (>50 mm)', -5.0, 0.0, 75.0, NULL),
  ('Wind', 'Light wind (<3 m/s)', NULL, NULL, NULL, 2.0),
  ('Wind', 'Moderate wind (3-8 m/s)', NULL, NULL, NULL, 5.0),
  ('Wind', 'Strong wind (>=8 m/s)', NULL, NULL, NULL, 10.0),
  ('Temperature', 'Freezing (<0 C)', -5.0, NULL, NULL, NULL),
  ('Temperature', 'Cold (0-10 C)', 5.0, NULL, NULL, NULL),
  ('Temperature', 'Mild (10-22 C)', 15.0, NULL, NULL, NULL),
  ('Temperature', 'Hot (>=22 C)', 26.0, NULL, NULL, NULL)) AS t(weather_scenario, weather_intensity, pt, pp, ps, pw))
SELECT weather_scenario, weather_intensity, coalesce(CAST(pt AS DOUBLE), typical.temperature) AS temperature,
       coalesce(CAST(pp AS DOUBLE), typical.precipitation) AS precipitation, coalesce(CAST(ps AS DOUBLE), typical.snow) AS snow,
       coalesce(CAST(pw AS DOUBLE), typical.wind_speed) AS wind_speed
FROM profiles CROSS JOIN typical""", ["temperature", "precipitation", "snow", "wind_speed"], ["P7", "A23"])
def q_weather_profiles(spark, sf):
    return weather_profile_table(spark, A.typical_weather(enriched_of(spark, sf)))


# ---------------------------------------------------------------------------
# scenario feature frame, checked against DuckDB
# ---------------------------------------------------------------------------
_FRAME_COLS = ["scenario_id", "start_station_id", "start_station_name", "rider_type", "hour_start", "season",
               "day_of_week", "hour", "is_weekend", "is_holiday", "is_pre_holiday",
               "historical_profile_demand", "station_hour_mean", "station_hour_median", "area_hour_mean",
               "station_avg_demand", "station_total_demand", "area_avg_demand", "area_total_demand",
               "area_lag_1h", "area_lag_24h", "area_rolling_mean_24h", "lag_1h", "lag_24h", "lag_168h",
               "rolling_mean_24h", "rolling_mean_3h", "rolling_mean_6h", "rolling_mean_168h",
               "rolling_max_24h", "rolling_min_24h", "trend_24h", "station_demand_tier", "area_demand_tier",
               "temperature", "precipitation", "snow", "wind_speed", "temperature_band", "rain_intensity"]
_FRAME_DOUBLES = ["historical_profile_demand", "station_hour_mean", "station_hour_median", "area_hour_mean",
                  "station_avg_demand", "station_total_demand", "area_avg_demand", "area_total_demand",
                  "area_lag_1h", "area_lag_24h", "area_rolling_mean_24h", "lag_1h", "lag_24h", "lag_168h",
                  "rolling_mean_24h", "rolling_mean_3h", "rolling_mean_6h", "rolling_mean_168h",
                  "rolling_max_24h", "rolling_min_24h", "trend_24h", "temperature", "precipitation", "snow",
                  "wind_speed", "day_of_week", "hour", "is_weekend", "is_holiday", "is_pre_holiday"]

_FRAME_SQL = E + f""",
hist AS (SELECT * FROM enriched WHERE rider_type = 'member'),
meta AS (SELECT start_station_id, start_station_name, grid_cell, area_label FROM hist
         QUALIFY row_number() OVER (PARTITION BY start_station_id ORDER BY hour_start DESC, rider_type DESC) = 1),
f0 AS (SELECT 0 AS scenario_id, m.*, 'member' AS rider_type, TIMESTAMP '2024-02-01 08:00:00' AS hour_start FROM meta m),
f1 AS (SELECT *, {O.season('month(hour_start)')} AS season, isodow(hour_start) - 1 AS day_of_week,
              hour(hour_start) AS hour, CAST(isodow(hour_start) IN (6, 7) AS DOUBLE) AS is_weekend,
              CAST(CAST(hour_start AS DATE) IN (DATE '2024-01-01', DATE '2024-01-15') AS DOUBLE) AS is_holiday,
              CAST(CAST(hour_start AS DATE) + 1 IN (DATE '2024-01-01', DATE '2024-01-15') AS DOUBLE) AS is_pre_holiday
       FROM f0),
prof AS (SELECT start_station_id, rider_type, day_of_week, hour, avg(demand) AS v FROM hist GROUP BY ALL),
fb AS (SELECT start_station_id, day_of_week, hour, avg(demand) AS v FROM hist GROUP BY ALL),
overall AS (SELECT avg(demand) AS v FROM hist),
shm AS (SELECT start_station_id, rider_type, hour, avg(demand) AS mean_v, median(demand) AS med_v FROM hist GROUP BY ALL),
ahm AS (SELECT grid_cell, rider_type, hour, avg(demand) AS v FROM hist GROUP BY ALL),
sa AS (SELECT start_station_id, rider_type, avg(demand) AS mean_v, sum(demand) AS sum_v FROM hist GROUP BY ALL),
ga AS (SELECT grid_cell, rider_type, avg(demand) AS mean_v, sum(demand) AS sum_v FROM hist GROUP BY ALL),
ap AS (SELECT grid_cell, rider_type, day_of_week, hour, sum(demand) AS v FROM hist GROUP BY ALL),
ah AS (SELECT grid_cell, rider_type, hour_start, sum(demand) AS v FROM hist GROUP BY ALL),
al AS (SELECT grid_cell, rider_type, v FROM ah
       QUALIFY row_number() OVER (PARTITION BY grid_cell, rider_type ORDER BY hour_start DESC) = 1),
lt AS (SELECT start_station_id, rider_type, demand, rolling_mean_24h, rolling_mean_3h, rolling_mean_6h,
              rolling_mean_168h, rolling_max_24h, rolling_min_24h FROM hist
       QUALIFY row_number() OVER (PARTITION BY start_station_id, rider_type ORDER BY hour_start DESC) = 1),
f2 AS (
  SELECT f1.*, coalesce(prof.v, fb.v, overall.v) AS hpd,
         shm.mean_v AS shm_mean, shm.med_v AS shm_med, ahm.v AS ahm_v, sa.mean_v AS sa_mean, sa.sum_v AS sa_sum,
         ga.mean_v AS ga_mean, ga.sum_v AS ga_sum, ap.v AS ap_v, al.v AS al_v, lt.*
  FROM f1
  LEFT JOIN prof USING (start_station_id, rider_type, day_of_week, hour)
  LEFT JOIN fb USING (start_station_id, day_of_week, hour)
  CROSS JOIN overall
  LEFT JOIN shm USING (start_station_id, rider_type, hour)
  LEFT JOIN ahm USING (grid_cell, rider_type, hour)
  LEFT JOIN sa USING (start_station_id, rider_type)
  LEFT JOIN ga USING (grid_cell, rider_type)
  LEFT JOIN ap USING (grid_cell, rider_type, day_of_week, hour)
  LEFT JOIN al USING (grid_cell, rider_type)
  LEFT JOIN lt USING (start_station_id, rider_type)
),
f3 AS (
  SELECT scenario_id, start_station_id, start_station_name, rider_type, hour_start, season,
         CAST(day_of_week AS DOUBLE) AS day_of_week, CAST(hour AS DOUBLE) AS hour, is_weekend, is_holiday, is_pre_holiday, hpd AS historical_profile_demand,
         coalesce(shm_mean, hpd) AS station_hour_mean, coalesce(shm_med, hpd) AS station_hour_median,
         coalesce(ahm_v, hpd) AS area_hour_mean, coalesce(sa_mean, hpd) AS station_avg_demand,
         coalesce(CAST(sa_sum AS DOUBLE), hpd) AS station_total_demand, coalesce(ga_mean, hpd) AS area_avg_demand,
         coalesce(CAST(ga_sum AS DOUBLE), hpd) AS area_total_demand,
         coalesce(CAST(al_v AS DOUBLE), ahm_v, hpd) AS area_lag_1h,
         coalesce(CAST(ap_v AS DOUBLE), ahm_v, hpd) AS area_lag_24h,
         coalesce(ga_mean, ahm_v, hpd) AS area_rolling_mean_24h,
         coalesce(CAST(demand AS DOUBLE), hpd) AS lag_1h, hpd AS lag_24h, hpd AS lag_168h,
         coalesce(rolling_mean_24h, hpd) AS rolling_mean_24h, coalesce(rolling_mean_3h, hpd) AS rolling_mean_3h,
         coalesce(rolling_mean_6h, hpd) AS rolling_mean_6h, coalesce(rolling_mean_168h, hpd) AS rolling_mean_168h,
         coalesce(rolling_max_24h, hpd) AS rolling_max_24h, coalesce(rolling_min_24h, hpd) AS rolling_min_24h,
         coalesce(CAST(demand AS DOUBLE), hpd) - hpd AS trend_24h,
         {O.tier('coalesce(sa_mean, hpd)')} AS station_demand_tier,
         {O.tier('coalesce(ga_mean, hpd)')} AS area_demand_tier,
         CAST(5.0 AS DOUBLE) AS temperature, CAST(0.0 AS DOUBLE) AS precipitation, CAST(0.0 AS DOUBLE) AS snow,
         CAST(0.0 AS DOUBLE) AS wind_speed
  FROM f2
)
SELECT f3.*, 'Cold' AS temperature_band, 'No rain' AS rain_intensity FROM f3"""


@register("scenario_feature_frame", _FRAME_SQL, _FRAME_DOUBLES,
          ["P1", "P2", "P3", "P4", "C15", "W8", "W9", "J6", "J7", "J8", "Q11", "Q15", "Q18"])
def q_frame(spark, sf):
    fact = written_fact(spark, sf)
    frame = build_scenario_frame(fact, [SCENARIO], fixture_holidays(spark))
    return frame.select(*_FRAME_COLS)


# ---------------------------------------------------------------------------
# scenarios with filters of every kind in one batch, each against its own SQL
# ---------------------------------------------------------------------------
_CLUSTER = "CAST(substr(start_station_id, 2) AS INTEGER) % 4"  # the fixture's clusters
_BATCH = [("rider_type = 'member'", SCENARIO),
          ("start_station_id = 'S000003'", replace(SCENARIO, rider_type="all", station_id="S000003")),
          ("grid_cell = '{cell}' AND rider_type = 'member'", replace(SCENARIO, grid_cell="{cell}")),
          ("area_label = 'Queens' AND rider_type = 'casual'",
           replace(SCENARIO, rider_type="casual", area_label="Queens")),
          (f"{_CLUSTER} = 2", replace(SCENARIO, rider_type="all", region_cluster=2)),
          (f"{_CLUSTER} = 1 AND rider_type = 'member'", replace(SCENARIO, region_cluster=1)),
          ("true", replace(SCENARIO, rider_type="all"))]
_BATCH_CELL = "4060_-7408"


def _batch_sql() -> str:
    parts = []
    for i, (condition, s) in enumerate(_BATCH):
        own = _FRAME_SQL.replace("hist AS (SELECT * FROM enriched WHERE rider_type = 'member')",
                                 f"hist AS (SELECT * FROM enriched WHERE {condition.format(cell=_BATCH_CELL)})")
        own = own.replace("SELECT 0 AS scenario_id, m.*, 'member' AS rider_type",
                          f"SELECT {i} AS scenario_id, m.*, '{s.rider_type}' AS rider_type")
        parts.append(f"SELECT * FROM ({own})")
    return "\nUNION ALL\n".join(parts)


@register("scenario_batch", _batch_sql(), _FRAME_DOUBLES, ["C15", "P1", "P2", "P3", "W8", "W9", "J6", "J7", "J8"])
def q_batch(spark, sf):
    cluster = (F.substring("start_station_id", 2, 10).cast("int") % 4).alias("region_cluster")
    fact = written_fact(spark, sf).drop("region_cluster").select("*", cluster)
    scenarios = [replace(s, grid_cell=s.grid_cell and _BATCH_CELL) for _, s in _BATCH]
    return build_scenario_frame(fact, scenarios, fixture_holidays(spark)).select(*_FRAME_COLS)


# ---------------------------------------------------------------------------
# the scoring chain on fixed predictions, checked against DuckDB
# ---------------------------------------------------------------------------
_CAP = "greatest(quantile_cont(demand, 0.999) * 1.25, max(demand), 1.0)"


@register("prediction_cap", E + f"\nSELECT {_CAP} AS prediction_cap FROM enriched", ["prediction_cap"], ["M4"])
def q_prediction_cap(spark, sf):
    from ..operators.models import prediction_cap
    return spark.createDataFrame([(float(prediction_cap(enriched_of(spark, sf))),)], "prediction_cap double")


@register("ordinal_codes", E + """,
known AS (
  SELECT start_station_id, dense_rank() OVER (ORDER BY start_station_id) - 1 AS code
  FROM (SELECT DISTINCT start_station_id FROM enriched WHERE start_station_id < 'S000100')),
riders AS (
  SELECT rider_type, dense_rank() OVER (ORDER BY rider_type) - 1 AS code
  FROM (SELECT DISTINCT rider_type FROM enriched WHERE start_station_id < 'S000100' AND rider_type <> 'casual'))
SELECT e.hour_start, e.start_station_id, e.rider_type, CAST(coalesce(k.code, -1) AS DOUBLE) AS station_code,
       CAST(coalesce(r.code, -1) AS DOUBLE) AS rider_code
FROM enriched e LEFT JOIN known k USING (start_station_id) LEFT JOIN riders r USING (rider_type)""",
          ["station_code", "rider_code"], ["M3"])
def q_ordinal_codes(spark, sf):
    from pyspark.ml import Pipeline
    from ..operators.models import add_codes, encoder_stages
    fact = enriched_of(spark, sf).select("hour_start", "start_station_id", "rider_type")
    cats = ["start_station_id", "rider_type"]
    known = fact.filter("start_station_id < 'S000100' AND rider_type <> 'casual'")
    encoder = Pipeline(stages=encoder_stages(cats, [])[0]).fit(known)
    labels = {c: list(own) for c, own in zip(cats, encoder.stages[0].labelsArray)}
    out = add_codes(encoder.transform(fact), cats, labels)
    return out.select("hour_start", "start_station_id", "rider_type",
                      F.col("start_station_id__code").alias("station_code"),
                      F.col("rider_type__code").alias("rider_code"))


_LOG_RAW = "0.9 * ln(1 + demand) + 0.05 * (hour % 7) - 0.2"


@register("target_transform", E + f"""
SELECT hour_start, start_station_id, rider_type, ln(1 + CAST(demand AS DOUBLE)) AS target,
       least(greatest(exp({_LOG_RAW}) - 1, 0.0), 4.0) AS from_log, least(greatest(demand - 1.5, 0.0), 4.0) AS from_demand
FROM enriched""", ["target", "from_log", "from_demand"], ["M5"])
def q_target_transform(spark, sf):
    from ..operators.models import log_target, on_demand_scale
    fact = enriched_of(spark, sf).select("hour_start", "start_station_id", "rider_type", "demand", "hour")
    return fact.select("hour_start", "start_station_id", "rider_type", log_target("demand").alias("target"),
                       on_demand_scale(F.expr(_LOG_RAW), True, 4.0).alias("from_log"),
                       on_demand_scale(F.expr("demand - 1.5"), False, 4.0).cast("double").alias("from_demand"))


# a fixed raw prediction that is off by a station-dependent amount
_RAW = "least(demand * 0.8 + (hour % 5) * 0.31719 + 0.51313, 6.0)"
_SEGMENTS = """
scored AS (SELECT *, {raw} AS raw_p FROM enriched),
chain AS (
  SELECT *, least(greatest(1.0371737 * (0.75 * raw_p + 0.25 * historical_profile_demand) - 0.2137131, 0.0), 6.0) AS p FROM scored),
segments AS (
  SELECT rider_type, hour, median(demand - p) * (count(*) / (count(*) + 20.0)) AS correction
  FROM chain GROUP BY rider_type, hour HAVING count(*) >= 20)""".format(raw=_RAW)


def _fixed_chain(spark, sf):
    """A model without a regressor: the chain starts at ``_raw``."""
    from ..operators.models import DemandModel
    model = DemandModel(name="fixed", pipeline=None, cats=[], nums=[], labels={}, log_target=False, prediction_cap=6.0,
                        blend_weight=0.75, calibration="linear", slope=1.0371737, intercept=-0.2137131)
    fact = written_fact(spark, sf).withColumn("_raw", F.expr(_RAW).cast("double"))
    return model, fact


def _fixed_corrections(spark, sf):
    from ..operators.models import residual_corrections
    model, fact = _fixed_chain(spark, sf)
    scored = model.finish(fact, out="_base").withColumn("residual", F.col("demand") - F.col("_base"))
    return model, fact, residual_corrections(scored, ["rider_type", "hour"], min_rows=20)


@register("residual_corrections", E + "," + _SEGMENTS + "\nSELECT * FROM segments", ["correction"], ["M13"])
def q_residual_corrections(spark, sf):
    table = _fixed_corrections(spark, sf)[2]
    return table.select(F.col("_rk_rider_type").alias("rider_type"), F.col("_rk_hour").alias("hour"),
                        F.col("_correction").alias("correction"))


@register("scoring_chain", E + "," + _SEGMENTS + """
SELECT hour_start, start_station_id, rider_type,
       least(greatest(p + 0.35 * coalesce(correction, 0.125), 0.0), 6.0) AS predicted_demand
FROM chain LEFT JOIN segments USING (rider_type, hour)""", ["predicted_demand"], ["M12", "M14", "J9"])
def q_scoring_chain(spark, sf):
    model, fact, table = _fixed_corrections(spark, sf)
    model.residual_keys, model.residual_table, model.residual_bias = ["rider_type", "hour"], table, 0.125
    return model.finish(fact).select("hour_start", "start_station_id", "rider_type", "predicted_demand")


class FixedScorer:
    """A linear scorer in place of fitted trees: scenario scores then have an SQL form."""

    def predict(self, frame, out="predicted_demand"):
        return frame.withColumn(out, F.expr("0.5 * historical_profile_demand + 0.1 * hour + 0.2 * day_of_week"
                                            " + 0.01 * temperature + 0.02 * precipitation"))


_SCORED = ("0.5 * historical_profile_demand + 0.1 * hour + 0.2 * day_of_week + 0.01 * temperature"
           " + 0.02 * precipitation")


@register("scenario_scores", _FRAME_SQL.rsplit("SELECT f3.*", 1)[0]
          + f"SELECT start_station_id, {_SCORED} AS predicted_demand FROM f3", ["predicted_demand"], ["P5", "P1"])
def q_scenario_scores(spark, sf):
    preds = predict_station_demand(written_fact(spark, sf), [SCENARIO], FixedScorer(), fixture_holidays(spark))
    return preds.select("start_station_id", "predicted_demand")


@register("trend_168h", E + """,
hist AS (SELECT * FROM enriched WHERE rider_type = 'member'),
hours AS (SELECT TIMESTAMP '2024-02-01 08:00:00' + i * INTERVAL 1 HOUR AS hour_start FROM range(168) t(i)),
grid AS (SELECT hour_start, isodow(hour_start) - 1 AS day_of_week, hour(hour_start) AS hour, start_station_id
         FROM hours CROSS JOIN (SELECT DISTINCT start_station_id FROM hist)),
prof AS (SELECT start_station_id, day_of_week, hour, avg(demand) AS v FROM hist GROUP BY ALL),
overall AS (SELECT avg(demand) AS v FROM hist)
SELECT hour_start, sum(0.5 * coalesce(prof.v, overall.v) + 0.1 * hour + 0.2 * day_of_week + 0.05) AS predicted_demand
FROM grid LEFT JOIN prof USING (start_station_id, day_of_week, hour) CROSS JOIN overall
GROUP BY hour_start""", ["predicted_demand"], ["P6", "P9", "U4"])
def q_trend_168h(spark, sf):
    return forecast_trend(written_fact(spark, sf), SCENARIO, FixedScorer(), periods=168, holidays=fixture_holidays(spark))


@register("intensity_totals", _FRAME_SQL.rsplit("SELECT f3.*", 1)[0] + """
SELECT weather_intensity, round(total, 2) AS predicted_demand, round(total - chosen, 2) AS difference_from_selected
FROM (SELECT i.weather_intensity,
             sum(0.5 * historical_profile_demand + 0.1 * hour + 0.2 * day_of_week + 0.01 * 11.0 + 0.02 * i.rain) AS total,
             sum(0.5 * historical_profile_demand + 0.1 * hour + 0.2 * day_of_week + 0.01 * 5.0) AS chosen
      FROM f3 CROSS JOIN (VALUES ('Light rain (0-2.5 mm)', 1.5), ('Moderate rain (2.5-10 mm)', 6.0),
                                 ('Heavy rain (>10 mm)', 15.0)) AS i(weather_intensity, rain)
      GROUP BY i.weather_intensity)""", ["predicted_demand", "difference_from_selected"], ["P8"])
def q_intensity_totals(spark, sf):
    typical = {"temperature": 11.0, "precipitation": 0.5, "snow": 0.0, "wind_speed": 4.0}
    return intensity_comparison(written_fact(spark, sf), SCENARIO, FixedScorer(), "Rain", typical, fixture_holidays(spark))


# ---------------------------------------------------------------------------
# the first two levels of a tree for each loss, checked against DuckDB (M7, M8)
# ---------------------------------------------------------------------------
# few cuts that both engines can state: (column, cuts)
_LEVEL_CUTS = [("hour", [3.0, 6.0, 9.0, 12.0, 15.0, 18.0, 21.0]), ("day_of_week", [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]),
               ("rolling_mean_24h", [0.5, 1.0, 1.25, 1.5, 2.0, 3.0, 5.0]),
               ("historical_profile_demand", [0.75, 1.0, 1.25, 1.5, 2.0, 3.0, 5.0]),
               ("temperature", [-5.0, 0.0, 5.0, 10.0, 15.0, 20.0, 25.0])]
_LEVEL_LOSSES = {"squared": ("m - ln(1 + y)", "1.0"),
                 "pseudo_huber": ("(m - ln(1 + y)) / sqrt(1 + pow(m - ln(1 + y), 2))",
                                  "pow(1 + pow(m - ln(1 + y), 2), -1.5)"),
                 "tweedie": ("exp(0.5 * m) - y * exp(-0.5 * m)", "0.5 * exp(0.5 * m) + 0.5 * y * exp(-0.5 * m)")}


def _level_sql() -> str:
    """Sums left of every cut, the gain of each cut, and the best one per node; then its two halves."""
    values = ", ".join(f"({f}, {c}, CAST({x} AS DOUBLE))" for f, (_, cuts) in enumerate(_LEVEL_CUTS)
                       for c, x in enumerate(cuts))
    x_of = "CASE f " + " ".join(f"WHEN {i} THEN x{i}" for i in range(len(_LEVEL_CUTS))) + " END"
    name = "CASE f " + " ".join(f"WHEN {i} THEN '{c}'" for i, (c, _) in enumerate(_LEVEL_CUTS)) + " END"
    xs = ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS x{i}" for i, (c, _) in enumerate(_LEVEL_CUTS))
    # the shrunk sum T(G) with alpha 0.06, lambda 2.6, gamma 0.04
    worth = lambda g, h: f"pow(greatest(abs({g}) - 0.06, 0.0), 2) / ({h} + 2.6)"
    leaf = lambda g, h: f"-sign({g}) * greatest(abs({g}) - 0.06, 0.0) / ({h} + 2.6)"

    def level(i: int, rows: str) -> str:
        return f"""sums{i} AS (
  SELECT loss, node, f, c, cut, sum(g) AS g, sum(h) AS h, coalesce(sum(g) FILTER ({x_of} <= cut), 0.0) AS gl,
         coalesce(sum(h) FILTER ({x_of} <= cut), 0.0) AS hl
  FROM {rows} CROSS JOIN cand GROUP BY ALL),
best{i} AS (
  SELECT *, ({worth('gl', 'hl')} + {worth('(g - gl)', '(h - hl)')} - {worth('g', 'h')}) / 2 - 0.04 AS gain FROM sums{i}
  WHERE hl >= 2 AND h - hl >= 2
  QUALIFY row_number() OVER (PARTITION BY loss, node ORDER BY gain DESC, f, c) = 1)"""

    losses = "\n  UNION ALL ".join(f"SELECT '{n}' AS loss, 0 AS node, *, {g} AS g, {h} AS h FROM base, "
                                   f"(SELECT {'ln(avg(y))' if n == 'tweedie' else 'avg(ln(1 + y))'} AS m FROM base)"
                                   for n, (g, h) in _LEVEL_LOSSES.items())
    return E + f""",
base AS (SELECT CAST(demand AS DOUBLE) AS y, {xs} FROM enriched),
cand AS (SELECT * FROM (VALUES {values}) t(f, c, cut)),
top AS ({losses}),
{level(0, 'top')},
halves AS (
  SELECT t.* REPLACE (CASE WHEN {x_of} <= b.cut THEN 1 ELSE 2 END AS node)
  FROM top t JOIN best0 b ON t.loss = b.loss AND b.gain > 0),
{level(1, 'halves')},
found AS (SELECT * FROM best0 UNION ALL SELECT * FROM best1)
SELECT loss, node, {name} AS feature, cut, gain, {leaf('gl', 'hl')} AS left_value,
       {leaf('(g - gl)', '(h - hl)')} AS right_value
FROM found WHERE gain > 0"""


@register("boosting_level_splits", _level_sql(), ["cut", "gain", "left_value", "right_value"], ["M7", "M8"])
def q_level_splits(spark, sf):
    import numpy as np
    from ..operators import boosting
    from ..operators.models import prepare_numeric
    names = [c for c, _ in _LEVEL_CUTS]
    specs = [boosting.BoostSpec(loss, loss=loss, rounds=1, depth=2, eta=1.0, min_child_weight=2, gamma=0.04,
                                reg_lambda=2.6, reg_alpha=0.06) for loss in _LEVEL_LOSSES]
    fact = prepare_numeric(enriched_of(spark, sf).select(*names, "demand"))
    found = boosting.fit(fact, names, "demand", specs, {"all": F.lit(True)},
                         cuts=[np.array(cuts) for _, cuts in _LEVEL_CUTS])
    rows = [(loss, node, names[t.feature[0, node]], float(t.cut[0, node]), float(t.gain[0, node]),
             float(t.value[0, 2 * node + 1]), float(t.value[0, 2 * node + 2]))
            for (loss, _), t in found.items() for node in range(3) if t.feature[0, node] >= 0]
    return spark.createDataFrame(rows, "loss string, node int, feature string, cut double, gain double, "
                                       "left_value double, right_value double")
