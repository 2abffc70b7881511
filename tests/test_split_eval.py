"""Split invariants and evaluation edge cases."""
import datetime as dt

from pyspark.sql import functions as F

from tripcast.operators import evaluation as EV
from tripcast.operators.split import latest_rows, split_bounds, temporal_train_calibration_test_split


def _fact(spark, hours_rows):
    rows = []
    for h, n in hours_rows:
        for i in range(n):
            rows.append((dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), f"S{i:02d}", "all", 1))
    return spark.createDataFrame(rows, "hour_start timestamp, start_station_id string, rider_type string, demand long")


def test_split_bounds_clamps():
    assert split_bounds(3) == (1, 2)
    assert split_bounds(10) == (7, 8)
    assert split_bounds(15440) == (10808, 12352)


def test_split_counts_and_order(spark):
    # many rows in one hour at the cut: the hour is split by station order
    fact = _fact(spark, [(0, 3), (1, 10), (2, 2)])
    out = temporal_train_calibration_test_split(fact)
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    te, ce = split_bounds(15)
    assert counts == {"train": te, "calibration": ce - te, "test": 15 - ce}
    mx = {r["split"]: r["m"] for r in out.groupBy("split").agg(F.max(F.struct("hour_start", "start_station_id")).alias("m")).collect()}
    mn = {r["split"]: r["m"] for r in out.groupBy("split").agg(F.min(F.struct("hour_start", "start_station_id")).alias("m")).collect()}
    assert mx["train"] < mn["calibration"] and mx["calibration"] < mn["test"]


def test_split_needs_three_rows(spark):
    import pytest
    with pytest.raises(ValueError):
        temporal_train_calibration_test_split(_fact(spark, [(0, 2)]))


def test_latest_rows(spark):
    fact = _fact(spark, [(0, 5), (1, 5)])
    kept = latest_rows(fact, 7).collect()
    assert len(kept) == 7
    assert sum(1 for r in kept if r["hour_start"].hour == 0) == 2


def test_blend_and_calibration_fallbacks(spark):
    rows = [("m", float(y), 1.0, None) for y in range(10)]
    pred = spark.createDataFrame(rows, "model string, y double, pred double, profile double")
    w = EV.optimize_blend_weight(pred).first()
    assert 0.0 <= w["blend_weight"] <= 1.0
    lines = EV.linear_calibration(pred).first()  # constant prediction: minimum-norm solution
    assert abs(lines["slope"] * 1.0 + lines["intercept"] - 4.5) < 1e-9
    choice = EV.optimize_prediction_calibration(pred).first()
    assert choice["method"] in ("none", "linear") and choice["isotonic_score"] is None


def test_blend_curve_equals_all_weights_row_by_row(spark):
    import numpy as np
    rng = np.random.default_rng(2)
    y = rng.poisson(3, 300).astype(float)
    pred, profile = y + rng.normal(size=300) * 2 - 1, rng.normal(2, 3, 300)  # some below 0
    pred[:20] = profile[:20]
    rows = [("m", *map(float, r)) for r in zip(y, pred, profile)]
    df = spark.createDataFrame(rows, "model string, y double, pred double, profile double")
    for r in EV.blend_curve(df, ["model"]).collect():
        w = r["blend_weight"]
        b = np.maximum(w * pred + (1 - w) * profile, 0)
        assert abs(r["MAE"] - np.abs(y - b).mean()) < 1e-9
        assert abs(r["R2"] - (1 - ((y - b) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9
    same = df.withColumn("profile", F.col("pred")).where("pred >= 0")
    assert EV.optimize_blend_weight(same).first()["blend_weight"] == 1.0  # nothing beats the prediction itself


def test_residual_choice_takes_the_first_set_that_helps(spark):
    # residuals depend on the hour alone: a = hour explains them, b is constant
    rows = [("m", float(h % 2) * 4 + 1, 2.0, h, 0) for h in range(24) for _ in range(30)]
    rows += [("fine", 2.0, 2.0, h, 0) for h in range(24) for _ in range(30)]
    df = spark.createDataFrame(rows, "model string, y double, pred double, a int, b int")
    trials = EV.residual_trials(df, [["b"], ["a"], ["a", "b"]], 50.0, 20, 0.35)
    got = {r["model"]: r["key_set"] for r in EV.choose_residual_keys(trials).collect()}
    assert got == {"m": 1, "fine": -1}
    none = EV.choose_residual_keys(EV.residual_trials(df, [["a"]], 50.0, 1000, 0.35)).collect()
    assert {r["key_set"] for r in none} == {-1}


def test_hotspot_zero_predicted(spark):
    rows = [("m", float(y), 0.0) for y in range(20)]
    out = EV.hotspot_classification(spark.createDataFrame(rows, "model string, y double, pred double")).first()
    assert out["hotspot_precision"] == 0.0 and out["hotspot_recall"] == 0.0 and out["hotspot_f1"] == 0.0


def test_labels_by_key_are_those_by_position(spark):
    """Without a join or a shuffle of the rows: each row's key tells its label."""
    from tripcast.operators.split import label_by_key, label_by_position
    rows = [(f"2024-01-0{1 + h // 24} {h % 24:02d}:00:00", f"S{s}", r) for h in range(40) for s in range(5)
            for r in ("all", "casual", "member") if (h + s) % 4]
    df = spark.createDataFrame(rows, "t string, start_station_id string, rider_type string").select(
        F.col("t").cast("timestamp").alias("hour_start"), "start_station_id", "rider_type")
    n = df.count()
    for cuts in ([(7, "train"), (9, "calibration")], [(1, "train"), (n - 1, "calibration")], [(n // 2, "train")],
                 [(n // 3, "train"), (n, "calibration")]):
        labelled = df.withColumn("split", label_by_key(df, cuts, "test"))
        want = label_by_position(df, cuts, "test").select(*labelled.columns)
        assert sorted(labelled.collect()) == sorted(want.collect())
        plan = labelled._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan
