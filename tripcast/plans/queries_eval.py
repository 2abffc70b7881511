"""Registered split and evaluation queries.

Predictions for the metric oracles are derived from the enriched fact
(fixture rule): model_a = 0.8*y + 0.3, model_b = rolling_mean_24h,
model_c = 1.0, with ``profile`` = historical_profile_demand.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import oracle as O
from .registry import KEYS, enriched_of, register
from ..session import materialize
from ..operators import evaluation as EV
from ..operators.split import split_summary, temporal_train_calibration_test_split, temporal_train_test_split, \
    latest_rows

E = O.BASE_ENRICHED


def fixture_predictions(enriched: DataFrame, more: list[str] | None = None) -> DataFrame:
    models = F.array(
        F.struct(F.lit("model_a").alias("model"), (F.lit(0.8) * F.col("demand") + F.lit(0.3)).alias("pred")),
        F.struct(F.lit("model_b").alias("model"), F.col("rolling_mean_24h").alias("pred")),
        F.struct(F.lit("model_c").alias("model"), F.lit(1.0).alias("pred")),
    )
    columns = KEYS + (more or [])
    return enriched.select(*columns, F.col("demand").cast("double").alias("y"),
                           F.col("historical_profile_demand").alias("profile"),
                           F.explode(models).alias("_m")).select(*columns, "y", "profile", "_m.model", "_m.pred")


def preds_of(spark, sf) -> DataFrame:
    # read several times by each evaluation: written once, with these few columns only
    return materialize(fixture_predictions(enriched_of(spark, sf)))


PREDS = E + """,
preds AS (
  SELECT hour_start, start_station_id, rider_type, CAST(demand AS DOUBLE) AS y, historical_profile_demand AS profile,
         'model_a' AS model, CAST(0.8 AS DOUBLE) * demand + CAST(0.3 AS DOUBLE) AS pred FROM enriched
  UNION ALL
  SELECT hour_start, start_station_id, rider_type, CAST(demand AS DOUBLE), historical_profile_demand,
         'model_b', rolling_mean_24h FROM enriched
  UNION ALL
  SELECT hour_start, start_station_id, rider_type, CAST(demand AS DOUBLE), historical_profile_demand,
         'model_c', CAST(1.0 AS DOUBLE) FROM enriched
)"""


def metrics_sql(src: str, group: str, pred: str = "pred") -> str:
    sse = f"sum((y - {pred}) * (y - {pred}))"
    sst = "(var_pop(y) * count(*))"
    return f"""SELECT {group},
  sum(abs(y - {pred})) / count(*) AS MAE,
  sqrt({sse} / count(*)) AS RMSE,
  CASE WHEN {sst} = 0 THEN CASE WHEN {sse} = 0 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END
       ELSE 1 - {sse} / {sst} END AS R2,
  sum(abs(y - {pred})) / greatest(sum(abs(y)), CAST(1e-9 AS DOUBLE)) * 100 AS WAPE,
  avg(CAST(2.0 AS DOUBLE) * abs(y - {pred}) / greatest(abs(y) + abs({pred}), CAST(1e-9 AS DOUBLE))) * 100 AS SMAPE,
  avg(CASE WHEN y <> 0 THEN abs(y - {pred}) / abs(y) END) * 100 AS MAPE_nonzero
FROM {src} GROUP BY {group}"""


METRIC_DOUBLES = ["MAE", "RMSE", "R2", "WAPE", "SMAPE", "MAPE_nonzero"]


def _score_sql(weights: dict[str, float]) -> str:
    parts = {"MAE": "MAE", "RMSE": "RMSE", "WAPE_ratio": "WAPE / 100",
             "R2_penalty": "greatest(CAST(0.0 AS DOUBLE), 1 - R2)"}
    return " + ".join(f"({parts[k]}) * {O.d(w)}" for k, w in weights.items())


# ---------------------------------------------------------------------------
# splits
# ---------------------------------------------------------------------------
_SPLIT_SQL = E + """,
ordered AS (
  SELECT hour_start, start_station_id, rider_type,
         row_number() OVER (ORDER BY hour_start, start_station_id, rider_type) - 1 AS pos,
         count(*) OVER () AS n
  FROM enriched
),
b1 AS (SELECT DISTINCT n,
         greatest(1, least(CAST(floor(n * (1 - CAST(0.1 AS DOUBLE) - CAST(0.2 AS DOUBLE))) AS BIGINT), n - 2)) AS te,
         CAST(floor(n * (1 - CAST(0.2 AS DOUBLE))) AS BIGINT) AS ce0,
         greatest(1, least(CAST(floor(n * (1 - CAST(0.2 AS DOUBLE))) AS BIGINT), n - 1)) AS split2
       FROM ordered),
b AS (SELECT *, greatest(te + 1, least(ce0, n - 1)) AS ce FROM b1),
labelled AS (
  SELECT o.hour_start, o.start_station_id, o.rider_type,
         CASE WHEN o.pos < b.te THEN 'train' WHEN o.pos < b.ce THEN 'calibration' ELSE 'test' END AS split,
         CASE WHEN o.pos < b.split2 THEN 'train' ELSE 'test' END AS split2
  FROM ordered o CROSS JOIN b
)"""


def keys_of(spark, sf):
    """The fact's keys, which a split reads for its cuts and again for its rows: written once."""
    return materialize(enriched_of(spark, sf).select(*KEYS))


@register("temporal_split", _SPLIT_SQL + "\nSELECT hour_start, start_station_id, rider_type, split FROM labelled",
          [], ["M1", "H2", "Q17"])
def q_split(spark, sf):
    return temporal_train_calibration_test_split(keys_of(spark, sf))


@register("temporal_split_80_20", _SPLIT_SQL + "\nSELECT hour_start, start_station_id, rider_type, split2 AS split FROM labelled",
          [], ["M2"])
def q_split2(spark, sf):
    return temporal_train_test_split(keys_of(spark, sf))


@register("split_summary", _SPLIT_SQL + """
SELECT split, count(*) AS row_count, min(hour_start) AS start_hour, max(hour_start) AS end_hour
FROM labelled GROUP BY split""",
          [], ["A29"])
def q_split_summary(spark, sf):
    return split_summary(temporal_train_calibration_test_split(keys_of(spark, sf)))


@register("latest_training_rows", E + """
SELECT hour_start, start_station_id, rider_type FROM enriched
QUALIFY row_number() OVER (ORDER BY hour_start DESC, start_station_id DESC, rider_type DESC) <= 5000""",
          [], ["T9"])
def q_latest_rows(spark, sf):
    return latest_rows(keys_of(spark, sf), 5000)


# ---------------------------------------------------------------------------
# metrics, ranking, hotspot classification
# ---------------------------------------------------------------------------
@register("regression_metrics", PREDS + "\n" + metrics_sql("preds", "model"), METRIC_DOUBLES, ["M9"])
def q_metrics(spark, sf):
    return EV.regression_metrics(preds_of(spark, sf))


_RANK_SQL = PREDS + f""",
metrics AS ({metrics_sql("preds", "model")}),
ranked AS (
  SELECT *, CAST(rank() OVER (ORDER BY MAE) AS DOUBLE) AS MAE_rank,
         CAST(rank() OVER (ORDER BY RMSE) AS DOUBLE) AS RMSE_rank,
         CAST(rank() OVER (ORDER BY R2 DESC) AS DOUBLE) AS R2_rank,
         CAST(rank() OVER (ORDER BY WAPE) AS DOUBLE) AS WAPE_rank,
         CAST(rank() OVER (ORDER BY SMAPE) AS DOUBLE) AS SMAPE_rank
  FROM metrics
),
ranking AS (
  SELECT *, MAE_rank * CAST(0.45 AS DOUBLE) + RMSE_rank * CAST(0.1 AS DOUBLE) + R2_rank * CAST(0.2 AS DOUBLE)
            + WAPE_rank * CAST(0.25 AS DOUBLE) AS combined_rank_score
  FROM ranked
)"""


@register("model_selection_ranking", _RANK_SQL + "\nSELECT * FROM ranking", METRIC_DOUBLES + ["combined_rank_score"],
          ["M15", "W10"])
def q_ranking(spark, sf):
    return EV.build_model_selection_table(EV.regression_metrics(preds_of(spark, sf)))


@register("top3_models", _RANK_SQL + "\nSELECT * FROM ranking ORDER BY combined_rank_score, MAE, model LIMIT 3",
          METRIC_DOUBLES + ["combined_rank_score"], ["T10"])
def q_top3(spark, sf):
    return EV.top_models(EV.build_model_selection_table(EV.regression_metrics(preds_of(spark, sf))))


@register("best_model_summary", _RANK_SQL + """
SELECT model AS best_model, 'weighted combined rank: MAE 45%, WAPE 25%, R2 20%, RMSE 10%' AS selection_rule,
       MAE, RMSE, R2, WAPE, SMAPE, MAPE_nonzero, combined_rank_score
FROM ranking ORDER BY combined_rank_score, MAE, model LIMIT 1""",
          METRIC_DOUBLES + ["combined_rank_score"], ["M17", "M16"])
def q_best(spark, sf):
    return EV.best_model_summary(EV.build_model_selection_table(EV.regression_metrics(preds_of(spark, sf))))


@register("best_by_mae", PREDS + f""",
metrics AS ({metrics_sql("preds", "model")})
SELECT (SELECT model FROM metrics ORDER BY MAE, model LIMIT 1) AS best_model""", [], ["M16"])
def q_best_mae(spark, sf):
    metrics = EV.regression_metrics(preds_of(spark, sf))
    return spark.range(1).select(EV.best_by_mae(metrics).alias("best_model"))


@register("hotspot_classification", PREDS + """,
thr AS (SELECT greatest(CAST(1.0 AS DOUBLE), quantile_cont(y, 0.9)) AS q FROM preds
        WHERE model = (SELECT min(model) FROM preds)),
flags AS (SELECT model, CAST(y >= q AS INTEGER) AS a, CAST(pred >= q AS INTEGER) AS f, q FROM preds CROSS JOIN thr),
hcounts AS (SELECT model, any_value(q) AS hotspot_threshold,
           CAST(sum(a * f) AS BIGINT) AS tp, CAST(sum((1 - a) * f) AS BIGINT) AS fp,
           CAST(sum(a * (1 - f)) AS BIGINT) AS fn, CAST(sum((1 - a) * (1 - f)) AS BIGINT) AS tn
           FROM flags GROUP BY model),
rates AS (SELECT *, CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS hotspot_accuracy,
          CASE WHEN tp + fp = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS hotspot_precision,
          CASE WHEN tp + fn = 0 THEN CAST(0.0 AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS hotspot_recall
          FROM hcounts)
SELECT *, CASE WHEN hotspot_precision + hotspot_recall = 0 THEN CAST(0.0 AS DOUBLE)
               ELSE 2 * hotspot_precision * hotspot_recall / (hotspot_precision + hotspot_recall) END AS hotspot_f1
FROM rates""", ["hotspot_threshold", "hotspot_accuracy", "hotspot_precision", "hotspot_recall", "hotspot_f1"], ["M18"])
def q_hotspot(spark, sf):
    return EV.hotspot_classification(preds_of(spark, sf))


# ---------------------------------------------------------------------------
# blending and calibration
# ---------------------------------------------------------------------------
_BLEND_BASE = PREDS + f""",
means AS (SELECT model, avg(y) AS my FROM preds GROUP BY model),
p2 AS (SELECT p.* REPLACE (coalesce(p.profile, m.my) AS profile) FROM preds p JOIN means m USING (model)),
weights AS (SELECT CASE WHEN i = 40 THEN CAST(1.0 AS DOUBLE) ELSE i * (CAST(1.0 AS DOUBLE) / 40) END AS blend_weight
            FROM range(41) t(i)),
cand AS (SELECT model, blend_weight, y,
                greatest(blend_weight * pred + (1 - blend_weight) * profile, CAST(0.0 AS DOUBLE)) AS b
         FROM p2 CROSS JOIN weights),
cand_m AS ({metrics_sql("cand", "model, blend_weight", "b")}),
cand_s AS (SELECT model, blend_weight, {_score_sql({"MAE": 0.6, "WAPE_ratio": 0.25, "R2_penalty": 0.15})} AS score
           FROM cand_m),
best AS (SELECT * FROM cand_s QUALIFY row_number() OVER (PARTITION BY model ORDER BY score, blend_weight) = 1),
base_m AS ({metrics_sql("p2", "model")}),
base AS (SELECT model, {_score_sql({"MAE": 0.6, "WAPE_ratio": 0.25, "R2_penalty": 0.15})} AS base_score FROM base_m),
chosen AS (SELECT model, CASE WHEN score < base_score THEN blend_weight ELSE CAST(1.0 AS DOUBLE) END AS blend_weight,
                  least(score, base_score) AS blend_score, base_score
           FROM best JOIN base USING (model))"""


@register("blend_weights", _BLEND_BASE + "\nSELECT * FROM chosen", ["blend_weight", "blend_score", "base_score"],
          ["M10"])
def q_blend(spark, sf):
    return EV.optimize_blend_weight(preds_of(spark, sf))


@register("blended_metrics", _BLEND_BASE + """,
blended AS (
  SELECT p.model, p.y, CASE WHEN c.blend_weight < 1
            THEN greatest(c.blend_weight * p.pred + (1 - c.blend_weight) * p.profile, CAST(0.0 AS DOUBLE))
            ELSE p.pred END AS pred
  FROM p2 p JOIN chosen c USING (model)
)
""" + metrics_sql("blended", "model"), METRIC_DOUBLES, ["M10", "M12"])
def q_blended_metrics(spark, sf):
    preds = preds_of(spark, sf)
    return EV.regression_metrics(EV.apply_blend(preds, EV.optimize_blend_weight(preds)))


@register("linear_calibration", PREDS + f""",
lines AS (
  SELECT model,
    CASE WHEN var_pop(pred) = 0 OR regr_slope(y, pred) IS NULL THEN avg(pred) * avg(y) / (avg(pred) * avg(pred) + 1)
         ELSE regr_slope(y, pred) END AS slope,
    CASE WHEN var_pop(pred) = 0 OR regr_slope(y, pred) IS NULL THEN avg(y) / (avg(pred) * avg(pred) + 1)
         ELSE regr_intercept(y, pred) END AS intercept
  FROM preds GROUP BY model
),
lin AS (SELECT p.model, p.y, greatest(l.slope * p.pred + l.intercept, CAST(0.0 AS DOUBLE)) AS pred
        FROM preds p JOIN lines l USING (model)),
lin_m AS ({metrics_sql("lin", "model")}),
none_m AS ({metrics_sql("preds", "model")})
SELECT l.model, l.slope, l.intercept,
       (SELECT {_score_sql({"MAE": 0.55, "RMSE": 0.10, "WAPE_ratio": 0.25, "R2_penalty": 0.10})} FROM lin_m
        WHERE lin_m.model = l.model) AS linear_score,
       (SELECT {_score_sql({"MAE": 0.55, "RMSE": 0.10, "WAPE_ratio": 0.25, "R2_penalty": 0.10})} FROM none_m
        WHERE none_m.model = l.model) AS none_score
FROM lines l""", ["slope", "intercept", "linear_score", "none_score"], ["M11"])
def q_linear_cal(spark, sf):
    preds = preds_of(spark, sf)
    lines = EV.linear_calibration(preds)
    lin = (preds.join(F.broadcast(lines), "model")
           .withColumn("pred", F.greatest(F.col("slope") * F.col("pred") + F.col("intercept"), F.lit(0.0))))
    lin_s = EV.regression_metrics(lin).select("model", EV.calibration_score().alias("linear_score"))
    none_s = EV.regression_metrics(preds).select("model", EV.calibration_score().alias("none_score"))
    return lines.join(lin_s, "model").join(none_s, "model")


# least upper and greatest lower means over all runs of predictions: no pooling
_ISOTONIC = PREDS + """,
points AS (SELECT model, pred, sum(y) AS s, count(*) AS w, row_number() OVER (PARTITION BY model ORDER BY pred) AS i
           FROM preds GROUP BY model, pred),
cum AS (SELECT *, sum(s) OVER (PARTITION BY model ORDER BY i) AS cs, sum(w) OVER (PARTITION BY model ORDER BY i) AS cw
        FROM points),
runs AS (SELECT a.model, a.i AS a, b.i AS b, (b.cs - a.cs + a.s) / CAST(b.cw - a.cw + a.w AS DOUBLE) AS m
         FROM cum a JOIN cum b ON a.model = b.model AND b.i >= a.i),
lower AS (SELECT model, a, b AS i, min(m) OVER (PARTITION BY model, a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS m FROM runs),
fit AS (SELECT l.model, l.i, max(l.m) AS value FROM lower l GROUP BY l.model, l.i),
fitted AS (SELECT p.model, p.pred, p.w, f.value FROM points p JOIN fit f ON p.model = f.model AND p.i = f.i)"""


@register("isotonic_fit", _ISOTONIC + """
SELECT model, min(pred) AS lo, max(pred) AS hi, value, CAST(sum(w) AS DOUBLE) AS weight FROM fitted
GROUP BY model, value""", ["lo", "hi", "value", "weight"], ["M11"])
def q_isotonic(spark, sf):
    from ..operators.isotonic import isotonic_blocks
    # many small chunks, so that blocks pool across their borders
    return isotonic_blocks(preds_of(spark, sf), chunk_blocks=64)


_CALIBRATION = _score_sql({"MAE": 0.55, "RMSE": 0.10, "WAPE_ratio": 0.25, "R2_penalty": 0.10})


@register("prediction_calibration", _ISOTONIC + f""",
lines AS (
  SELECT model,
    CASE WHEN var_pop(pred) = 0 OR regr_slope(y, pred) IS NULL THEN avg(pred) * avg(y) / (avg(pred) * avg(pred) + 1)
         ELSE regr_slope(y, pred) END AS slope,
    CASE WHEN var_pop(pred) = 0 OR regr_slope(y, pred) IS NULL THEN avg(y) / (avg(pred) * avg(pred) + 1)
         ELSE regr_intercept(y, pred) END AS intercept,
    min(pred) < max(pred) AS several
  FROM preds GROUP BY model),
lin AS (SELECT p.model, p.y, greatest(l.slope * p.pred + l.intercept, CAST(0.0 AS DOUBLE)) AS pred
        FROM preds p JOIN lines l USING (model)),
iso AS (SELECT p.model, p.y, greatest(f.value, CAST(0.0 AS DOUBLE)) AS pred
        FROM preds p JOIN fitted f ON p.model = f.model AND p.pred = f.pred),
lin_m AS ({metrics_sql("lin", "model")}), none_m AS ({metrics_sql("preds", "model")}), iso_m AS ({metrics_sql("iso", "model")}),
scores AS (
  SELECT l.*, (SELECT {_CALIBRATION} FROM none_m n WHERE n.model = l.model) AS none_score,
         (SELECT {_CALIBRATION} FROM lin_m n WHERE n.model = l.model) AS linear_score,
         CASE WHEN several THEN (SELECT {_CALIBRATION} FROM iso_m n WHERE n.model = l.model) END AS isotonic_score
  FROM lines l),
chosen AS (
  SELECT *, CASE WHEN isotonic_score < least(none_score, linear_score) THEN 'isotonic'
                 WHEN linear_score < none_score THEN 'linear' ELSE 'none' END AS method FROM scores)
SELECT model, method, CASE WHEN method = 'linear' THEN slope ELSE 1.0 END AS slope,
       CASE WHEN method = 'linear' THEN intercept ELSE 0.0 END AS intercept, none_score, linear_score, isotonic_score
FROM chosen""", ["slope", "intercept", "none_score", "linear_score", "isotonic_score"], ["M11", "H5"])
def q_calibration(spark, sf):
    return EV.optimize_prediction_calibration(preds_of(spark, sf))


_TRIAL_KEYS = [["hour", "day_of_week", "rider_type", "station_demand_tier"],
               ["month", "hour", "day_of_week", "rider_type", "station_demand_tier"],
               ["hour", "day_of_week", "rider_type", "area_label", "station_demand_tier"],
               ["hour", "day_of_week", "rider_type", "station_demand_tier", "rain_level"],
               ["hour", "day_of_week", "rider_type", "station_demand_tier", "temperature_level"],
               ["hour", "day_of_week", "rider_type", "area_label", "temperature_level"],
               ["hour", "day_of_week", "rider_type", "station_demand_tier", "rain_level", "snow_level", "wind_level",
                "temperature_level"]]
_TRIAL_ROWS, _TRIAL_CAP = 20, 25.0


def _trials_sql() -> str:
    columns = sorted({c for keys in _TRIAL_KEYS for c in keys} - {"rider_type"})
    parts = []
    for i, keys in enumerate(_TRIAL_KEYS):
        same = " AND ".join(f"r.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
        parts.append(f"""
  SELECT r.model, {i} AS key_set, r.y, least(greatest(r.pred + 0.35 * coalesce(s.c, b.bias), 0.0), {_TRIAL_CAP}) AS pred
  FROM keyed r JOIN bias b USING (model) LEFT JOIN (
    SELECT model, {', '.join(keys)}, median(y - pred) * (count(*) / (count(*) + {_TRIAL_ROWS}.0)) AS c
    FROM keyed GROUP BY ALL HAVING count(*) >= {_TRIAL_ROWS}) s ON r.model = s.model AND {same}
  WHERE r.model IN (SELECT model FROM keyed GROUP BY model, {', '.join(keys)} HAVING count(*) >= {_TRIAL_ROWS})""")
    return PREDS + f""",
keyed AS (SELECT p.model, p.y, p.pred, p.rider_type, {', '.join('e.' + c for c in columns)}
          FROM preds p JOIN enriched e USING (hour_start, start_station_id, rider_type)),
bias AS (SELECT model, median(y - pred) AS bias FROM keyed GROUP BY model),
tried AS (SELECT model, -1 AS key_set, y, pred FROM keyed UNION ALL {' UNION ALL '.join(parts)}),
trial_m AS ({metrics_sql("tried", "model, key_set")}),
trials AS (SELECT *, {_CALIBRATION} AS score FROM trial_m)"""


def _trials(spark, sf):
    columns = sorted({c for keys in _TRIAL_KEYS for c in keys} - set(KEYS))
    enriched = enriched_of(spark, sf)
    preds = materialize(fixture_predictions(enriched, columns))
    return EV.residual_trials(preds, _TRIAL_KEYS, _TRIAL_CAP, _TRIAL_ROWS, 0.35)


@register("residual_trials", _trials_sql() + "\nSELECT * FROM trials", METRIC_DOUBLES + ["score"], ["M13"])
def q_trials(spark, sf):
    return _trials(spark, sf)


@register("residual_choice", _trials_sql() + """
SELECT b.model, coalesce(first(t.key_set ORDER BY round(t.score, 12), t.key_set) FILTER (kept), -1) AS key_set,
       any_value(b.score) AS base_score, coalesce(min(t.score) FILTER (kept), any_value(b.score)) AS score
FROM trials b LEFT JOIN (
  SELECT t.*, t.MAE <= n.MAE + 1e-12 * n.MAE AND t.WAPE <= n.WAPE + 1e-12 * n.WAPE AND t.R2 >= n.R2 - 1e-12 * abs(n.R2)
           AND t.score < n.score - 1e-12 * n.score AS kept
  FROM trials t JOIN trials n ON t.model = n.model AND n.key_set = -1 WHERE t.key_set >= 0) t ON t.model = b.model
WHERE b.key_set = -1 GROUP BY b.model""", ["base_score", "score"], ["M13"])
def q_residual_choice(spark, sf):
    return EV.choose_residual_keys(materialize(_trials(spark, sf)))


@register("backtest_wide", E + """
SELECT hour_start, start_station_id, rider_type, CAST(demand AS DOUBLE) AS y,
       CAST(0.8 AS DOUBLE) * demand + CAST(0.3 AS DOUBLE) AS pred_model_a, rolling_mean_24h AS pred_model_b,
       CAST(1.0 AS DOUBLE) AS pred_model_c
FROM enriched""", ["y", "pred_model_a", "pred_model_b", "pred_model_c"], ["U5", "M19"])
def q_backtest(spark, sf):
    return EV.backtest_wide(preds_of(spark, sf), KEYS, ["model_a", "model_b", "model_c"])


@register("scatter_points", PREDS + "\nSELECT y, pred FROM preds WHERE model = 'model_b'", ["y", "pred"], ["M22"])
def q_scatter(spark, sf):
    return EV.scatter_points(preds_of(spark, sf), "model_b")


# ---------------------------------------------------------------------------
# options of the reference's quirks, each against its own SQL
# ---------------------------------------------------------------------------
from .registry import LAG_DOUBLES  # noqa: E402

_PROFILE_FILLED = [c for c in LAG_DOUBLES if c != "historical_profile_demand"]


@register("lags_profile_fill", E.replace("coalesce(l.lag_1h, med.m)", "coalesce(l.lag_1h, l.historical_profile_demand, med.m)")
          .replace("coalesce(l.lag_24h, med.m)", "coalesce(l.lag_24h, l.historical_profile_demand, med.m)")
          .replace("coalesce(l.lag_168h, med.m)", "coalesce(l.lag_168h, l.historical_profile_demand, med.m)")
          .replace("coalesce(l.lag_1h - l.lag_24h, med.m)",
                   "coalesce(l.lag_1h - l.lag_24h, l.historical_profile_demand, med.m)")
          + "\nSELECT hour_start, start_station_id, rider_type, lag_1h, lag_24h, lag_168h, trend_24h FROM enriched",
          ["lag_1h", "lag_24h", "lag_168h", "trend_24h"], ["Q3", "F24"])
def q_profile_fill(spark, sf):
    return enriched_of(spark, sf, fill="profile").select(*KEYS, "lag_1h", "lag_24h", "lag_168h", "trend_24h")


@register("lags_dense_hours", E + """,
bounds AS (SELECT start_station_id, rider_type, min(hour_start) AS lo, max(hour_start) AS hi
           FROM fact_h GROUP BY start_station_id, rider_type),
spine AS (SELECT start_station_id, rider_type, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_start
          FROM bounds),
dense AS (SELECT s.start_station_id, s.rider_type, s.hour_start, coalesce(f.demand, 0) AS demand,
                 f.demand IS NOT NULL AS observed
          FROM spine s LEFT JOIN fact_h f USING (start_station_id, rider_type, hour_start)),
dense_lags AS (
  SELECT *, CAST(lag(demand, 1) OVER w AS DOUBLE) AS l1, CAST(lag(demand, 24) OVER w AS DOUBLE) AS l24,
         avg(demand) OVER (PARTITION BY start_station_id, rider_type ORDER BY hour_start
                           ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS r24
  FROM dense WINDOW w AS (PARTITION BY start_station_id, rider_type ORDER BY hour_start)
)
SELECT hour_start, start_station_id, rider_type, coalesce(l1, (SELECT m FROM med)) AS lag_1h,
       coalesce(l24, (SELECT m FROM med)) AS lag_24h, coalesce(r24, (SELECT m FROM med)) AS rolling_mean_24h
FROM dense_lags WHERE observed""", ["lag_1h", "lag_24h", "rolling_mean_24h"], ["Q4", "H1", "W1", "U4"])
def q_dense(spark, sf):
    return enriched_of(spark, sf, densify=True, cut_lineage=True).select(*KEYS, "lag_1h", "lag_24h", "rolling_mean_24h")


@register("station_hotspots_with_rollup", E + """
SELECT start_station_id, start_station_name, station_lat, station_lng, CAST(sum(demand) AS BIGINT) AS demand
FROM enriched GROUP BY ALL ORDER BY demand DESC, start_station_id, start_station_name, station_lat, station_lng
LIMIT 20""", ["station_lat", "station_lng"], ["Q5", "T1"])
def q_hot_rollup(spark, sf):
    from ..operators.analysis import station_hotspots
    return station_hotspots(enriched_of(spark, sf), "all", 20, include_rollup=True)


@register("station_metadata_fan_out", O.with_ctes(O.TRIP_VIEW, O.RAW_RENAMED, O.clean("raw_renamed"))
          + """
SELECT start_station_id, start_station_name, median(start_lat) AS station_lat, median(start_lng) AS station_lng,
       count(ride_id) AS trips FROM trips GROUP BY start_station_id, start_station_name""",
          ["station_lat", "station_lng"], ["Q9", "A1"])
def q_fan_out(spark, sf):
    from ..operators.clean import clean_trips
    from ..operators.stations import station_metadata
    from ..sources.fixtures import trip_view_renamed_station
    trips = clean_trips(trip_view_renamed_station(spark, sf))
    return station_metadata(trips, one_name_per_id=False, cluster=False).select(
        "start_station_id", "start_station_name", "station_lat", "station_lng", "trips")
