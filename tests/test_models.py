"""Model invariants: predictions inside [0, cap], monotone isotonic, save/load, scenarios."""
import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from tripcast.operators.models import DemandModel, fit_model, model_specs, prediction_cap
from tripcast.operators.scenario import Scenario, build_scenario_frame, hourly_scenarios, predict_station_demand
from tripcast.operators.stations import station_metadata
from tripcast.plans.facts import enriched_station_hour
from tripcast.session import materialize
from tripcast.sources.fixtures import fixture_holidays, fixture_weather, trip_view
from tripcast.operators.clean import clean_trips


def _fact(spark):
    trips = clean_trips(trip_view(spark, "/root/testdata/sf0.001"))
    return materialize(enriched_station_hour(trips, fixture_holidays(spark), fixture_weather(spark),
                                             stations=station_metadata(trips, cluster=True)))


def test_clusters_stable(spark):
    trips = clean_trips(trip_view(spark, "/root/testdata/sf0.001"))
    st = station_metadata(trips, cluster=True).collect()
    ids = {r["region_cluster"] for r in st}
    assert ids == set(range(min(12, len(st))))


def test_model_scores_within_cap(spark, tmp_dir):
    fact = _fact(spark)
    cap = prediction_cap(fact)
    spec = model_specs(fast=True)["gbt"]
    model = fit_model(fact, "gbt", spec, cap)
    preds = model.predict(fact)
    lo, hi = preds.agg(F.min("predicted_demand"), F.max("predicted_demand")).first()
    assert 0.0 <= lo and hi <= cap
    model.save(f"{tmp_dir}/model")
    again = DemandModel.load(spark, f"{tmp_dir}/model")
    a = sorted(r[0] for r in model.predict(fact).select("predicted_demand").collect())
    b = sorted(r[0] for r in again.predict(fact).select("predicted_demand").collect())
    assert a == b


def test_scenarios(spark):
    fact = _fact(spark)
    model = fit_model(fact, "gbt", model_specs(fast=True)["gbt"], prediction_cap(fact))
    base = Scenario(future_time=dt.datetime(2024, 2, 3, 10), rider_type="all", is_holiday=1)
    frame = build_scenario_frame(fact, hourly_scenarios(base, 3))
    n_stations = fact.select("start_station_id").distinct().count()
    assert frame.count() == 3 * n_stations
    assert {r[0] for r in frame.select("is_holiday").distinct().collect()} == {1.0}
    preds = predict_station_demand(fact, [base], model)
    assert preds.filter(F.col("predicted_demand") < 0).count() == 0


CANDIDATES = ["random_forest", "gbt", "gbt_smooth", "gbt_robust", "gbt_tweedie"]


def test_candidates_at_full_settings():
    full = model_specs()
    assert list(full) == CANDIDATES
    assert full["random_forest"].trees == 160 and full["random_forest"].regressor().getNumTrees() == 160
    assert {n: s.loss for n, s in full.items() if n != "random_forest"} == {
        "gbt": "squared", "gbt_smooth": "squared", "gbt_robust": "pseudo_huber", "gbt_tweedie": "tweedie"}
    assert {n: round(s.rounds * s.eta, 6) for n, s in full.items() if n in CANDIDATES[1:4]} == {
        "gbt": 16.0, "gbt_smooth": 16.8, "gbt_robust": 18.0}
    assert not full["gbt_tweedie"].log_target and full["gbt"].log_target


def test_registered_queries_train_every_candidate_once(spark, monkeypatch):
    from tripcast.plans import queries_model as Q, training

    asked = []
    few = {n: (replace(s, rounds=3) if n != "random_forest" else replace(s, trees=3, depth=3))
           for n, s in model_specs().items()}
    monkeypatch.setattr(training, "model_specs", lambda fast=False: asked.append(fast) or few)
    monkeypatch.setattr(Q, "clustered_fact", lambda spark, sf: _fact(spark))
    cap = Q.Trained(spark, "any").table("about").first()["prediction_cap"]
    ranking = Q.Trained(spark, "any").table("ranking")
    assert asked == [False]  # saved, then read
    assert {r["model"] for r in ranking.collect()} == set(CANDIDATES)
    preds = Q.Trained(spark, "any").table("predictions")
    lo, hi = preds.agg(F.min("pred"), F.max("pred")).first()
    assert 0.0 <= lo <= hi <= cap and preds.select("model").distinct().count() == 5
    riders = Q.Trained(spark, "any", riders=True).table("riders").collect()
    assert asked == [False, False] and {r["rider_type"] for r in riders} == {"member", "casual"}
    for r in riders:
        assert r["trained"] == (r["n_rows"] >= 1000) and (r["MAE"] is not None) == r["trained"]


def test_tweedie_candidate_scores_on_the_demand_scale(spark):
    fact = _fact(spark)
    cap = prediction_cap(fact)
    model = fit_model(fact, "gbt_tweedie", replace(model_specs()["gbt_tweedie"], rounds=10), cap)
    lo, mean, hi = model.predict(fact).agg(F.min("predicted_demand"), F.avg("predicted_demand"),
                                           F.max("predicted_demand")).first()
    assert 0.0 <= lo <= hi <= cap
    assert abs(mean - fact.agg(F.avg("demand")).first()[0]) < 0.2 * mean


def test_training_rows_are_labelled_and_encoded_once(spark, monkeypatch):
    """What all later steps read is a stored table, not the fact with its labels and codes made anew."""
    import pytest
    from tripcast.plans import training

    class Enough(Exception):
        pass

    seen, limit = [], spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    fact = _fact(spark)

    def stop(coded, *more):
        seen.append(coded)
        raise Enough

    monkeypatch.setattr(training, "fit_candidates", stop)
    with pytest.raises(Enough):
        training.train_models(fact)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" in plan and "UDF" not in plan and "CASE" not in plan and len(plan.splitlines()) == 1
    assert seen[0].count() == fact.count() and {"split", "rider_split", "demand"} <= set(seen[0].columns)
    assert seen[0].groupBy("split").count().count() == 3
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
