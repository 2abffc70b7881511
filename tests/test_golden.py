"""Golden input/output pairs published with the reference outputs (copied as literals)."""
import pytest

from tripcast.operators import evaluation as EV
from tripcast.sources.holidays import holiday_table

# Published per-model metrics (input of the ranking).
METRICS = [
    ("xgboost", 1.1637585598369955, 2.1564598904756687, 0.7369691170294288, 34.75547135533942, 33.19163650818697, 36.555368733846485),
    ("xgboost_smooth", 1.1720394411915713, 2.171071678507171, 0.7333925400132859, 35.00277861016746, 33.46238272327844, 36.73218707603929),
    ("xgboost_tweedie", 1.181152061383693, 2.207963710448417, 0.7242548798104242, 35.27492561813768, 33.51693949095689, 36.1652447939431),
    ("random_forest", 1.400079638277658, 2.856515305289303, 0.5384730308167003, 41.813164210082235, 37.022828320286045, 36.05206070391802),
]
SCHEMA = "model string, MAE double, RMSE double, R2 double, WAPE double, SMAPE double, MAPE_nonzero double"

# Published hotspot metrics: (model, precision, recall, f1).
HOTSPOT = [
    ("xgboost_smooth", 0.8311871907557086, 0.5386281372758911, 0.6536659345572752),
    ("xgboost", 0.8440017577266735, 0.5163827912233446, 0.6407423309661855),
    ("xgboost_tweedie", 0.8571453487865073, 0.48935778263488855, 0.6230223123732251),
    ("random_forest", 0.8935269992056674, 0.2744273117883406, 0.41989350113126483),
]


def test_ranking_matches_published(spark):
    ranking = EV.build_model_selection_table(spark.createDataFrame(METRICS, SCHEMA))
    rows = {r["model"]: r for r in ranking.collect()}
    expected = {"xgboost": 1.0, "xgboost_smooth": 2.0, "xgboost_tweedie": 3.0, "random_forest": 4.0}
    for model, rank in expected.items():
        for c in ("MAE_rank", "RMSE_rank", "R2_rank", "WAPE_rank", "SMAPE_rank", "combined_rank_score"):
            assert rows[model][c] == pytest.approx(rank)


def test_best_model_summary_matches_published(spark):
    ranking = EV.build_model_selection_table(spark.createDataFrame(METRICS, SCHEMA))
    best = EV.best_model_summary(ranking).first()
    assert best["best_model"] == "xgboost"
    assert best["selection_rule"] == "weighted combined rank: MAE 45%, WAPE 25%, R2 20%, RMSE 10%"
    assert best["MAE"] == pytest.approx(1.1637585598369955)
    assert best["combined_rank_score"] == pytest.approx(1.0)
    top = [r["model"] for r in EV.top_models(ranking).collect()]
    assert top == ["xgboost", "xgboost_smooth", "xgboost_tweedie"]


def test_hotspot_f1_consistent():
    for _, p, r, f1 in HOTSPOT:
        assert 2 * p * r / (p + r) == pytest.approx(f1, rel=1e-12)


def test_holiday_table(spark):
    rows = holiday_table(spark).orderBy("date").collect()
    assert len(rows) == 25
    assert (str(rows[0]["date"]), rows[0]["holiday_name"]) == ("2025-01-01", "New Year's Day")
    assert (str(rows[-1]["date"]), rows[-1]["holiday_name"]) == ("2026-12-25", "Christmas Day")
    assert {r["source"] for r in rows} == {"NYC official holiday calendar"}


def test_metric_floors(spark):
    # actual all zero: WAPE uses the 1e-9 floor, MAPE on non-zero is null; equal predictions: R2 rule
    df = spark.createDataFrame([("m", 0.0, 0.0), ("m", 0.0, 0.0)], "model string, y double, pred double")
    row = EV.regression_metrics(df).first()
    assert row["MAE"] == 0.0 and row["WAPE"] == 0.0 and row["MAPE_nonzero"] is None and row["R2"] == 1.0
    df2 = spark.createDataFrame([("m", 0.0, 1.0), ("m", 0.0, 1.0)], "model string, y double, pred double")
    assert EV.regression_metrics(df2).first()["R2"] == 0.0


def test_blend_weights_grid():
    w = EV.blend_weights()
    assert len(w) == 41 and w[0] == 0.0 and w[-1] == 1.0 and w[1] == 0.025


def test_scenario_frame_reads_the_history_only_to_reduce_it(spark, tmp_dir):
    """The frame's plan joins the reduced tables; no grain or pattern scans the history again."""
    import datetime as dt
    from pyspark.sql import functions as F
    from data_folders import SF_SMALL
    from tripcast.operators.scenario import Scenario, build_scenario_frame
    from tripcast.plans.registry import enriched_of
    where = f"{tmp_dir}/history"
    enriched_of(spark, SF_SMALL).withColumn("region_cluster", F.lit(1)).write.parquet(where)
    base = Scenario(future_time=dt.datetime(2024, 2, 1, 8))
    frame = build_scenario_frame(spark.read.parquet(where), [base, Scenario(base.future_time, rider_type="member")])
    assert where not in frame._jdf.queryExecution().optimizedPlan().toString() and frame.inputFiles()
    assert not [f for f in frame.inputFiles() if where in f]
    assert frame.where("scenario_id = 0").count() >= frame.where("scenario_id = 1").count() > 0
