"""Model training, calibration, ranking and publishing.

All candidates are trained from one encoded table, scored in one long table (model, row)
and calibrated together.  Only tiny results reach the driver: the row count, the
prediction cap, a few settings per model and the metric rows.
"""
from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import (RESIDUAL_KEY_SETS, RESIDUAL_MIN_SEGMENT_ROWS, RESIDUAL_SHRINKAGE, RIDER_MODEL_MIN_ROWS,
                         RIDER_MODEL_TYPES)
from ..operators import evaluation as EV
from ..operators.boosting import predictions
from ..operators.isotonic import IsotonicFit, isotonic_blocks
from ..operators.models import (DemandModel, Encoder, feature_importance, feature_names, fit_candidates, model_specs,
                                on_demand_scale, prediction_cap, prepare_numeric, residual_corrections)
from ..operators.split import label_by_key, latest_rows, split_bounds, train_end
from ..session import checkpoint_dir, materialize, short_methods, written
from ..sources.sinks import path_exists

KEYS = ["hour_start", "start_station_id", "rider_type"]
RESIDUAL_COLUMNS = sorted({c for keys in RESIDUAL_KEY_SETS for c in keys} - set(KEYS))
GENERAL = "general"


def _station_names(data: DataFrame) -> DataFrame | None:
    """One name per station: that of its latest hour."""
    if "start_station_name" not in data.columns:
        return None
    return data.groupBy("start_station_id").agg(
        F.max_by("start_station_name", F.struct("hour_start", "start_station_name")).alias("start_station_name"))


def split_rows(data: DataFrame, riders: list[str], min_rows: int = RIDER_MODEL_MIN_ROWS) -> tuple[DataFrame, dict]:
    """Rows with ``split`` (train, calibration, test) and ``rider_split`` (train, test; null where
    the rider type has no model of its own), and the rows of each rider type.

    Rows are unique by (hour, station, rider type).  The labels are columns over ``data``, so that
    every reader takes only the columns that it uses."""
    counts = dict(data.groupBy("rider_type").count().collect())  # one row per rider type
    sizes = {r: counts.get(r, 0) for r in riders}
    train, calibration = split_bounds(sum(counts.values()))
    split = label_by_key(data, [(train, "train"), (calibration, "calibration")], "test")
    rider_split = F.lit(None).cast("string")
    for rider in riders:
        if sizes[rider] >= min_rows:
            rows = F.col("rider_type") == rider
            rider_split = F.when(rows, label_by_key(data.where(rows), [(train_end(sizes[rider]), "train")],
                                                    "test")).otherwise(rider_split)
    return data.withColumns({"split": split, "rider_split": rider_split}), sizes


def score_candidates(coded: DataFrame, models: list[DemandModel], keep: list[str], target: str) -> DataFrame:
    """One row per (model, row): model, the columns to keep, y, ``_raw`` on the demand scale, profile.

    All models score a row in one pass over its features.
    """
    scored = coded.withColumn("_scores", predictions([m.regressor_model for m in models]))
    raw = [(m, F.col("_scores")[i]) for i, m in enumerate(models)]
    each = F.explode(F.array(*[F.struct(F.lit(m.name).alias("model"), on_demand_scale(
        p, m.log_target, m.prediction_cap).alias("_raw")) for m, p in raw])).alias("_m")
    return scored.select(*keep, F.col(target).cast("double").alias("y"), "historical_profile_demand", each).select(
        "_m.model", *keep, "y", "_m._raw", "historical_profile_demand")


def calibrate(scored: DataFrame, models: dict[str, DemandModel], cap: float) -> dict[str, dict]:
    """M10 + M11 + M13 for all models at once; ``scored`` is the calibration split's long table.

    Sets every model's blend weight, calibration and residual table; returns their descriptions.
    """
    profile = F.col("historical_profile_demand")
    pred = scored.select("model", "y", F.col("_raw").alias("pred"), profile.alias("profile"))
    for r in EV.optimize_blend_weight(pred).collect():
        models[r["model"]].blend_weight = float(r["blend_weight"])

    def own(setting):  # a column that holds each model's setting
        value = F.lit(None).cast("double")
        for name, m in models.items():
            value = F.when(F.col("model") == name, F.lit(float(setting(m)))).otherwise(value)
        return value

    w = own(lambda m: m.blend_weight)
    keys = [c for c in KEYS + RESIDUAL_COLUMNS if c in scored.columns]
    blended = materialize(scored.select("model", "y", *keys, F.when(
        (w < 1) & profile.isNotNull(), w * F.col("_raw") + (1 - w) * profile).otherwise(F.col("_raw")).alias("pred")))
    blocks = isotonic_blocks(blended)
    for r in EV.optimize_prediction_calibration(blended, blocks).collect():
        m = models[r["model"]]
        m.calibration, m.slope, m.intercept = r["method"], float(r["slope"]), float(r["intercept"])
        if m.calibration == "isotonic":
            m.isotonic = IsotonicFit.of(blocks, m.name)
    fitted = F.col("pred")
    for name, m in models.items():
        if m.calibration != "none":
            line = F.lit(m.slope) * F.col("pred") + F.lit(m.intercept)
            fitted = F.when(F.col("model") == name, line if m.calibration == "linear" else m.isotonic.column(
                F.col("pred"))).otherwise(fitted)
    base = materialize(blended.withColumn("pred", F.least(F.greatest(fitted, F.lit(0.0)), F.lit(cap))))
    key_sets = [[c for c in s if c in base.columns] for s in RESIDUAL_KEY_SETS]
    trials = materialize(EV.residual_trials(base, key_sets, cap, RESIDUAL_MIN_SEGMENT_ROWS, RESIDUAL_SHRINKAGE))
    out = {}
    from ..operators.stats import exact_median
    residual = base.withColumn("residual", F.col("y") - F.col("pred"))
    for r in EV.choose_residual_keys(trials).collect():
        m, method = models[r["model"]], "none"
        if r["key_set"] >= 0:
            m.residual_keys = key_sets[r["key_set"]]
            rows = residual.where(F.col("model") == m.name)
            m.residual_table = materialize(residual_corrections(rows, m.residual_keys))
            m.residual_bias = float(exact_median(rows, [], "residual").first()[0] or 0.0)
            method = "segment_median:" + ",".join(m.residual_keys)
        out[m.name] = {"method": m.calibration, "slope": m.slope, "intercept": m.intercept,
                       "residual_adjustment": method}
    return out


def final_predictions(scored: DataFrame, models: dict[str, DemandModel], keys: list[str]) -> DataFrame:
    """model, keys, y, pred, profile after each model's whole chain."""
    out = None
    for name, m in models.items():
        own = m.finish(scored.where(F.col("model") == name), out="pred").select(
            "model", *keys, "y", "pred", F.col("historical_profile_demand").alias("profile"))
        out = own if out is None else out.unionByName(own)
    return out


def train_models(station_hour: DataFrame, target: str = "demand", max_train_rows: int | None = None,
                 fast: bool = False, selection_metric: str = "combined", train_rider_models: bool = True,
                 names: list[str] | None = None) -> dict:
    spark = station_hour.sparkSession
    checkpoint_dir(spark)
    data = prepare_numeric(latest_rows(station_hour.dropna(subset=[target]), max_train_rows))
    riders = RIDER_MODEL_TYPES if train_rider_models else []
    split, sizes = split_rows(data, riders)
    train = split.where(F.col("split") == "train")
    cap = prediction_cap(train, target)
    specs = {k: v for k, v in model_specs(fast).items() if not names or k in names}
    encoder = Encoder.fit(train)
    coded = encoder.codes(split)
    # read by every step from here on: labelled and encoded once, with the columns that they use
    used = ["split", "rider_split", *KEYS, *RESIDUAL_COLUMNS, target, *feature_names(encoder.cats, encoder.nums)]
    with short_methods(spark):
        coded = written(coded.select(*dict.fromkeys(c for c in used if c in coded.columns)))
    scopes = {GENERAL: F.col("split") == "train"} | {
        r: (F.col("rider_type") == r) & (F.col("rider_split") == "train") for r in riders
        if sizes[r] >= RIDER_MODEL_MIN_ROWS}
    grown = fit_candidates(coded, encoder, list(specs.values()), cap, scopes, target)
    fitted = {n: grown[n, GENERAL] for n in specs}

    keep = [c for c in ["split", *KEYS, *RESIDUAL_COLUMNS] if c in coded.columns]
    scored = materialize(score_candidates(coded.where(F.col("split") != "train"), list(fitted.values()), keep, target))
    settings = calibrate(scored.where(F.col("split") == "calibration"), fitted, cap)
    keys = [k for k in KEYS if k in coded.columns]
    preds = materialize(final_predictions(scored.where(F.col("split") == "test"), fitted, keys))
    metrics = EV.regression_metrics(preds)
    ranking = EV.build_model_selection_table(metrics)
    extra = spark.createDataFrame([(n, fitted[n].blend_weight, json.dumps(settings[n])) for n in fitted],
                                  "model string, blend_weight double, calibration string")
    ranking = materialize(ranking.join(extra, "model", "left"))
    if selection_metric == "MAE":
        best = ranking.orderBy("MAE", "model").first()["model"]
    else:
        best = ranking.orderBy("combined_rank_score", "MAE", "model").first()["model"]
    out = {
        "split": split, "prediction_cap": cap, "models": fitted, "best_model_name": best,
        "metrics": metrics, "ranking": ranking, "top3": EV.top_models(ranking),
        "best_summary": EV.best_model_summary(ranking),
        "hotspot": EV.hotspot_classification(preds),
        "backtest": EV.backtest_wide(preds, KEYS, list(fitted), _station_names(data)),
        "feature_importance": feature_importance(fitted[best]),
        "test_predictions": preds,
    }
    if train_rider_models:
        out["rider_metrics"], out["rider_models"] = rider_specific_models(coded, encoder, specs[best], cap, sizes,
                                                                          grown, target)
    return out


def rider_specific_models(coded: DataFrame, encoder: Encoder, spec, cap: float, sizes: dict[str, int],
                          grown: dict | None = None, target: str = "demand") -> tuple[DataFrame, dict]:
    """The best candidate per rider type, 80/20, blend tuned on its test rows (Q13).

    Boosted candidates have grown beside the general ones (``grown``); a forest is fitted
    here.  Returns the metrics (one row per rider type; ``trained`` is false, and the metrics
    null, where a type has too few rows) and the fitted models by rider type.
    """
    spark = coded.sparkSession
    models = {}
    for rider, n in sizes.items():
        if n < RIDER_MODEL_MIN_ROWS:
            continue
        found = (grown or {}).get((spec.name, rider))
        if found is None:
            rows = (F.col("rider_type") == rider) & (F.col("rider_split") == "train")
            found = fit_candidates(coded, encoder, [spec], cap, {rider: rows}, target)[spec.name, rider]
        models[rider] = found
    scored = None
    for rider, m in models.items():
        test = coded.where((F.col("rider_type") == rider) & (F.col("rider_split") == "test"))
        own = score_candidates(test, [m], KEYS, target).withColumn("model", F.lit(rider))
        scored = own if scored is None else scored.unionByName(own)
    metrics: dict[str, dict] = {}
    if scored is not None:
        scored = materialize(scored)
        pred = scored.select("model", "y", F.col("_raw").alias("pred"), F.col("historical_profile_demand").alias("profile"))
        for r in EV.optimize_blend_weight(pred).collect():
            models[r["model"]].blend_weight = float(r["blend_weight"])
        metrics = {r["model"]: r.asDict() for r in EV.regression_metrics(final_predictions(scored, models, KEYS)).collect()}
    names = ["MAE", "RMSE", "R2", "WAPE", "SMAPE", "MAPE_nonzero"]
    rows = [(*[metrics.get(r, {}).get(c) for c in names], r, spec.name,
             models[r].blend_weight if r in models else None, r in models, n) for r, n in sizes.items()]
    table = spark.createDataFrame(rows, "MAE double, RMSE double, R2 double, WAPE double, SMAPE double, "
                                        "MAPE_nonzero double, rider_type string, model string, blend_weight double, "
                                        "trained boolean, n_rows long")
    return table, models


def rider_model_path(models_dir: str, rider_type: str) -> str:
    return f"{models_dir}/{rider_type}_station_demand_model"


def general_model_path(models_dir: str) -> str:
    return f"{models_dir}/best_station_demand_model"


def save_models(models_dir: str, best, rider_models: dict) -> None:
    """The general model and one per rider type that has its own, beside one another: each is a few short jobs."""
    spark = SparkSession.getActiveSession()
    save = inheritable_thread_target(spark)(lambda model, path: model.save(path, spark))
    with ThreadPoolExecutor(1 + len(rider_models)) as pool:
        saving = [pool.submit(save, best, general_model_path(models_dir))]
        saving += [pool.submit(save, m, rider_model_path(models_dir, rider)) for rider, m in rider_models.items()]
        for one in saving:
            one.result()


def load_model(spark, models_dir: str, rider_type: str = "all"):
    """The rider type's own model if it was saved, else the general one."""
    own = rider_model_path(models_dir, rider_type)
    return DemandModel.load(spark, own if path_exists(spark, own) else general_model_path(models_dir))
