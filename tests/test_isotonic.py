"""Pooling in small chunks against a direct fit, interpolation, odd cases."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripcast.operators import isotonic as I


def direct(x, y):
    """[lo, hi, value, weight] by pooling one sorted list."""
    points = {}
    for a, b in zip(x, y):
        s, w = points.get(a, (0.0, 0))
        points[a] = (s + b, w + 1)
    out = []
    for a in sorted(points):
        out.append([a, a, *points[a]])
        while len(out) > 1 and out[-2][2] / out[-2][3] >= out[-1][2] / out[-1][3]:
            lo, _, s, w = out.pop(-2)
            out[-1] = [lo, out[-1][1], out[-1][2] + s, out[-1][3] + w]
    return [(lo, hi, s / w, w) for lo, hi, s, w in out]


def frame(spark, models):
    rows = [(m, float(a), float(b)) for m, (x, y) in models.items() for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "model string, pred double, y double")


def data(kind, n=700, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 400, n) / 8
    y = {"rising": x + rng.normal(size=n) * 3, "falling": -x, "level": np.ones(n), "noise": rng.poisson(2, n),
         "late_fall": np.where(x < 45, x, -500.0)}[kind]
    return x, y


@pytest.mark.parametrize("chunk", [4, 64, 100_000])
def test_equals_direct_pooling(spark, chunk):
    models = {k: data(k) for k in ("rising", "falling", "level", "noise", "late_fall")}
    blocks = I.isotonic_blocks(frame(spark, models).repartition(5), chunk).collect()
    for name, (x, y) in models.items():
        got = sorted((r["lo"], r["hi"], r["value"], r["weight"]) for r in blocks if r["model"] == name)
        want = direct(x, y)
        assert len(got) == len(want)
        assert np.allclose(np.array(got), np.array(want))


def test_interpolation_equals_the_knots(spark):
    models = {"a": data("rising", seed=4), "b": data("noise", seed=5)}
    pred = frame(spark, models)
    blocks = I.isotonic_blocks(pred)
    asked = spark.createDataFrame([(m, float(v), 0.0) for m in models for v in np.linspace(-3, 60, 150).tolist()
                                   + [3.125, 3.125]], "model string, pred double, y double")
    for cells in (2, 50):
        got = I.interpolate(asked, blocks, cells=cells).collect()
        assert len(got) == 2 * 152
        for m in models:
            fit = I.IsotonicFit.of(blocks, m)
            for r in got:
                if r["model"] == m:
                    assert r["fitted"] == pytest.approx(np.interp(r["pred"], fit.x, fit.value))


def test_one_point_nulls_and_no_rows(spark):
    odd = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 4.0), ("a", None, 1.0), ("b", 2.0, None)],
                                "model string, pred double, y double")
    assert [tuple(r) for r in I.isotonic_blocks(odd).collect()] == [("a", 1.0, 1.0, 3.0, 2.0)]
    assert I.isotonic_blocks(odd.where("model = 'c'")).count() == 0


def test_saved_fit_gives_the_same_column(spark, tmp_dir):
    fit = I.IsotonicFit(np.array([0.0, 1.0, 3.0]), np.array([0.5, 0.5, 2.0]))
    fit.save(spark, f"{tmp_dir}/fit")
    again = I.IsotonicFit.load(spark, f"{tmp_dir}/fit")
    rows = spark.range(5).select(again.column(F.col("id") - 1)).collect()
    assert [r[0] for r in rows] == [0.5, 0.5, 0.5, 1.25, 2.0]
