"""The histogram-narrowed median equals the plain median, with ties, gaps and tiny groups."""
import random

import pytest
from pyspark.sql import functions as F

from tripcast.operators.stats import exact_median


def test_exact_median_matches(spark):
    rng = random.Random(7)
    rows = [("a", rng.lognormvariate(2, 1)) for _ in range(5001)]
    rows += [("b", float(rng.randint(0, 3))) for _ in range(1000)]            # heavy ties
    rows += [("c", 5.0)] + [("d", 1.0), ("d", 2.0)] + [("e", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v", buckets=16).collect()}
    want = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    for g in got:
        assert got[g] == pytest.approx(want[g], rel=1e-12)
    whole = exact_median(df, [], "v").first()[0]
    assert whole == pytest.approx(df.select(F.median("v")).first()[0], rel=1e-12)


def test_segment_medians_count_rows_without_a_value(spark):
    from tripcast.operators.stats import segment_medians
    rows = [("a", 1.0), ("a", 4.0), ("a", 9.0), ("a", None), ("b", 2.0), ("b", float("nan")), ("c", None), ("c", None),
            (None, 3.0), (None, 5.0), ("d", 7.0)]
    got = segment_medians(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", 2, "m", "n").collect()
    assert {r["g"]: (r["n"], r["m"]) for r in got} == {"a": (4, 4.0), "b": (2, 2.0), "c": (2, None), None: (2, 4.0)}


def test_residual_trials_do_not_shuffle_the_rows_of_every_key_set(spark):
    """The few corrected segments go to the rows: only counts, medians and metrics are shuffled."""
    from tripcast.operators import evaluation as EV
    rows = [("m", float(i % 5), float(i % 3), i % 7, "x" if i % 2 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "model string, y double, pred double, hour int, level string").repartition(4)
    trials = EV.residual_trials(df, [["hour"], ["hour", "level"]], 9.0, 20, 0.35)
    plan = trials._jdf.queryExecution().executedPlan().toString()
    assert "key_set" in plan and "SortMergeJoin" not in plan and "LeftSemi" not in plan
    assert sorted(r["key_set"] for r in trials.collect()) == [-1, 0, 1]
