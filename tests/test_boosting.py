"""Boosted trees against a plain grower, losses, several scopes, save and load."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripcast.operators import boosting as B

LOSSES = ["squared", "pseudo_huber", "tweedie"]


def table(spark, n=900, seed=3):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 12, n), rng.normal(size=n), rng.integers(0, 3, n)
    y = rng.poisson(np.exp(0.3 * (a > 5) + 0.5 * (b > 0.2) * (c == 1)))
    rows = [(float(p), float(q), float(r), float(t), "m" if i % 3 else "c", "extra")
            for i, (p, q, r, t) in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, demand double, rider string, block string"), rows


def plain_tree(spec, x, y, margin, cuts):
    """Direct search over all cuts, node by node: {node: (feature, cut, gain)} and leaf values."""
    g, h = B.gradients(spec, y, margin)
    worth = lambda s, t: max(abs(s) - spec.reg_alpha, 0) ** 2 / (t + spec.reg_lambda)
    leaf = lambda s, t: -np.sign(s) * max(abs(s) - spec.reg_alpha, 0) / (t + spec.reg_lambda)
    splits, values, todo = {}, {}, [(0, np.arange(len(y)), 0)]
    while todo:
        node, rows, level = todo.pop()
        values[node] = leaf(g[rows].sum(), h[rows].sum())
        if level == spec.depth:
            continue
        best = (0.0, None, None, None)
        for f, own in enumerate(cuts):
            for cut in own:
                left = rows[x[f, rows] <= cut]
                right = rows[x[f, rows] > cut]
                if h[left].sum() < spec.min_child_weight or h[right].sum() < spec.min_child_weight:
                    continue
                gain = (worth(g[left].sum(), h[left].sum()) + worth(g[right].sum(), h[right].sum())
                        - worth(g[rows].sum(), h[rows].sum())) / 2 - spec.gamma
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut, (left, right))
        if best[1] is not None:
            splits[node] = best[:3]
            todo += [(2 * node + 1, best[3][0], level + 1), (2 * node + 2, best[3][1], level + 1)]
    return splits, values


@pytest.mark.parametrize("loss", LOSSES)
def test_first_tree_equals_a_plain_search(spark, loss, monkeypatch):
    monkeypatch.setattr(B, "GROUP_FEATURES", 2)
    df, rows = table(spark)
    spec = B.BoostSpec("v", loss=loss, rounds=1, depth=3, eta=1.0, min_child_weight=3, gamma=0.02, reg_lambda=1.5,
                       reg_alpha=0.1)
    cuts = [np.arange(0.0, 11.0), np.array([-1.0, -0.5, 0.2, 0.5, 1.0]), np.array([0.0, 1.0])]
    tree = B.fit(df, ["a", "b", "c"], "demand", [spec], {"all": F.lit(True)}, cuts=cuts)["v", "all"]
    x = np.array([r[:3] for r in rows]).T
    y = np.array([r[3] for r in rows])
    start = np.log(y.mean()) if loss == "tweedie" else np.log1p(y).mean()
    assert tree.start == pytest.approx(start)
    splits, values = plain_tree(spec, x, y, np.full(len(y), start), cuts)
    assert {n: tree.feature[0, n] for n in range(15) if tree.feature[0, n] >= 0} == {n: s[1] for n, s in splits.items()}
    for node, (gain, f, cut) in splits.items():
        assert tree.gain[0, node] == pytest.approx(gain) and tree.cut[0, node] == cut
    for node, value in values.items():
        assert tree.value[0, node] == pytest.approx(value)


def test_variants_and_scopes_grow_together_as_they_grow_alone(spark):
    df, _ = table(spark)
    specs = [B.BoostSpec("first", rounds=4, depth=3, subsample=0.8, colsample=0.7),
             B.BoostSpec("second", loss="tweedie", rounds=2, depth=2)]
    scopes = {"all": F.lit(True), "m": F.col("rider") == "m"}
    both = B.fit(df, ["a", "b", "c"], "demand", specs, scopes)
    assert set(both) == {(s.name, k) for s in specs for k in scopes}
    cuts = B.quantile_cuts(df, ["a", "b", "c"])
    alone = B.fit(df, ["a", "b", "c"], "demand", [specs[1]], {"m": scopes["m"]}, cuts=cuts)["second", "m"]
    assert np.array_equal(alone.feature, both["second", "m"].feature)
    assert np.allclose(alone.value, both["second", "m"].value)
    assert len(both["first", "all"].feature) == 4 and len(both["second", "all"].feature) == 2


def test_deviance_falls_every_round_and_beats_the_mean_on_held_out_rows(spark):
    df, _ = table(spark, 1500)
    held, rows = table(spark, 700, seed=8)
    specs = [B.BoostSpec(loss, loss=loss, rounds=12, depth=3, eta=0.3) for loss in LOSSES]
    trace = []
    models = B.fit(df, ["a", "b", "c"], "demand", specs, {"all": F.lit(True)}, trace=trace)
    for i in range(len(specs)):
        assert all(after[i] < before[i] for before, after in zip(trace, trace[1:]))
    y = np.array([r[3] for r in rows])
    got = np.array([r[0] for r in held.select(B.predictions([models[s, "all"] for s in LOSSES])).collect()])
    for i, loss in enumerate(LOSSES):
        pred = got[:, i] if loss == "tweedie" else np.expm1(got[:, i])
        assert ((y - pred) ** 2).mean() < y.var() and (pred >= 0).all()


def test_saved_trees_score_alike(spark, tmp_dir):
    df, _ = table(spark, 300)
    spec = B.BoostSpec("v", rounds=3, depth=2)
    model = B.fit(df, ["a", "b", "c"], "demand", [spec], {"all": F.lit(True)})["v", "all"]
    model.save(spark, f"{tmp_dir}/trees")
    again = B.BoostedTrees.load(spark, f"{tmp_dir}/trees")
    assert again.spec == spec and again.features == ["a", "b", "c"]
    pairs = df.select(model.score().alias("p"), again.score().alias("q")).collect()
    assert all(r["p"] == r["q"] for r in pairs)
    assert model.importances().sum() == pytest.approx(1.0)


def test_odd_features_and_an_empty_scope(spark):
    df = spark.createDataFrame([(1.0, None, float(i % 4)) for i in range(40)], "a double, b double, demand double")
    df = df.fillna(0.0)
    got = B.fit(df, ["a", "b"], "demand", [B.BoostSpec("v", rounds=2)], {"all": F.lit(True), "none": F.lit(False)})
    assert set(got) == {("v", "all")}
    model = got["v", "all"]
    assert (model.feature == -1).all()  # constant features cannot split
    mean = np.log1p([i % 4 for i in range(40)]).mean()
    assert df.select(model.score()).first()[0] == pytest.approx(mean)


def test_level_sums_hold_one_feature_at_a_time():
    """Sums by (node, feature, bin) equal a direct count; temporaries do not grow with the features."""
    import tracemalloc
    rng, n, features, bins = np.random.default_rng(5), 32_768, 20, 64
    codes = rng.integers(0, bins, (features, n)).astype(np.uint8)
    y, member, margins = rng.poisson(2.0, n).astype(float), np.ones(n, np.int32), np.full((1, n), 0.5)
    spec = B.BoostSpec("gbt", loss="tweedie", depth=2)
    tree = B.Tree(2)
    tree.feature[0], tree.cut[0] = 3, 20
    args = ([(0, codes, y, member, margins)], [B._Model(spec, 0)], [tree], [np.array([1, 2])], 0, 1, bins)
    tracemalloc.start()
    found = dict(B._sums(*args))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20
    g, h = B.gradients(spec, y, margins[0])
    node = (codes[3] > 20).astype(int)
    for f in (0, 15, 16, 19):
        first = f // B.GROUP_FEATURES * B.GROUP_FEATURES
        own = found[0, first].reshape(2, -1, 2, bins)[:, f - first]
        for i in (0, 1):
            for b in (0, 20, 63):
                rows = (node == i) & (codes[f] == b)
                assert np.allclose(own[:, i, b], (g[rows].sum(), h[rows].sum()), rtol=1e-12, atol=1e-12)


def test_level_sums_skip_features_without_cuts_and_walks_go_node_by_node(monkeypatch):
    """Sums of usable features and nodes' totals stay as they are; the others are not counted."""
    rng, n, bins = np.random.default_rng(6), 4000, 16
    codes = rng.integers(0, bins, (20, n)).astype(np.uint8)
    y, member, margins = rng.poisson(2.0, n).astype(float), np.ones(n, np.int32), np.full((1, n), 0.5)
    tree = B.Tree(4)
    for node, f in ((0, 3), (1, 5), (2, 7), (5, 17), (6, 2)):
        tree.feature[node], tree.cut[node] = f, 3 + node
    for levels in range(5):
        want = np.zeros(n, np.int64)
        for _ in range(levels):
            f = tree.feature[want]
            want = np.where(f >= 0, 2 * want + 1 + (codes[f, np.arange(n)] > tree.cut[want]), want)
        assert np.array_equal(tree.walk(codes, levels), want)
    usable = [np.where(np.arange(20) % 4 == 1, bins - 1, 0)]
    for loss in LOSSES:
        args = ([(0, codes, y, member, margins)], [B._Model(B.BoostSpec("v", loss=loss, depth=4, subsample=0.9), 0)],
                [tree], [np.array([3, 4, 5, 6])], 0, 2, bins)
        full = dict(B._sums(*args))
        calls, count = [], np.bincount
        with monkeypatch.context() as patch:
            patch.setattr(np, "bincount", lambda *a: calls.append(1) or count(*a))
            some = dict(B._sums(*args, usable))
        assert len(calls) == 2 * 7  # five usable features, and the first of each group
        for (m, first), sums in full.items():
            shape = (2, -1, 4, bins)
            for i, (a, b) in enumerate(zip(sums.reshape(shape).swapaxes(0, 1), some[m, first].reshape(shape).swapaxes(0, 1))):
                assert np.array_equal(a, b) if not i or usable[0][first + i] else not b.any()


def test_bundled_features_give_each_features_own_sums_with_fewer_counts(monkeypatch):
    rng, n = np.random.default_rng(7), 3000
    widths = np.array([2, 1, 64, 3, 5, 2, 7, 22, 4, 2, 1, 6])
    codes = np.stack([rng.integers(0, w, n) for w in widths]).astype(np.uint8)
    groups = B.bundles(widths)
    assert sorted(f for g in groups for f in g) == np.flatnonzero(widths > 1).tolist()
    assert len(groups) <= 4 and all(np.prod(widths[g]) <= B.BUNDLE_CELLS for g in groups)
    y, member, margins = rng.poisson(2.0, n).astype(float), np.ones(n, np.int32), np.full((1, n), 0.5)
    tree, nodes = B.Tree(3), [np.array([1, 2])]
    tree.feature[0], tree.cut[0] = 2, 20
    model = [B._Model(B.BoostSpec("v", loss="tweedie", depth=3), 0)]
    calls, count = [], np.bincount
    with monkeypatch.context() as patch:
        patch.setattr(np, "bincount", lambda *a: calls.append(1) or count(*a))
        block = (0, codes, y, member, margins, B.bundled(codes, groups, widths))
        sums = B._sums([block], model, [tree], nodes, 0, 1, B.BUNDLE_CELLS)
        (key, got), = B._by_feature(sums, B.parts_of(groups, widths), [2])
    assert key == (0, 0) and len(calls) == 2 * len(groups)
    plain = dict(B._sums([block[:5]], model, [tree], nodes, 0, 1, 64))[0, 0].reshape(2, -1, 2, 64)
    want = np.concatenate([plain[:, f, :, :widths[f]] for g in groups for f in g], axis=2)
    assert np.allclose(got, want, rtol=1e-12, atol=1e-12)


def test_training_tasks_get_equally_many_rows(spark):
    rows = spark.range(40_000).repartition(5).selectExpr("double(id % 7) a", "double(id % 3) demand")
    table = B.bin_rows(rows, ["a"], "demand", {"all": F.lit(True)})
    sizes = [sum(part) for part in table.state().map(lambda b: len(b[2])).glom().collect()]
    assert sum(sizes) == 40_000 and len(sizes) == spark.sparkContext.defaultParallelism
    assert max(sizes) < 1.5 * 40_000 / len(sizes)


def test_only_a_scopes_own_rows_walk_its_trees():
    rng, n = np.random.default_rng(8), 500
    codes, y = rng.integers(0, 9, (3, n)).astype(np.uint8), rng.poisson(1.0, n).astype(float)
    tree = B.Tree(2)
    for node, f in ((0, 1), (1, 2), (2, 0)):
        tree.feature[node], tree.cut[node] = f, 4
    tree.value[:] = np.arange(7.0)
    member = np.where(np.arange(n) % 3, 1, 3).astype(np.int32)
    rows = np.flatnonzero(member & 2)
    assert np.array_equal(tree.walk(codes, 2, rows), tree.walk(codes, 2)[rows])
    seen = []
    tree.walk = lambda c, levels, chosen: seen.append(len(chosen)) or B.Tree.walk(tree, c, levels, chosen)
    models = [B._Model(B.BoostSpec("v", depth=2, eta=1.0), scope) for scope in (0, 1)]
    after = B._advance((0, codes, y, member, np.zeros((2, n)), codes), models, [tree, tree])[4]
    assert seen == [n, len(rows)] and np.array_equal(after[1][rows], after[0][rows])


def test_a_table_is_written_once_where_it_is_wanted(spark, tmp_dir):
    from tripcast.session import written
    back = written(spark.range(5), f"{tmp_dir}/fact")
    assert back.count() == 5 and spark.read.parquet(f"{tmp_dir}/fact").count() == 5


class Local:
    """Blocks in place of an RDD of them."""

    def __init__(self, blocks):
        self.blocks = blocks

    def mapPartitions(self, f):
        return Local(list(f(iter(self.blocks))))

    def getNumPartitions(self):
        return 1

    def collect(self):
        return self.blocks


@pytest.mark.parametrize("loss", LOSSES)
def test_of_two_siblings_only_the_lighter_one_is_counted(loss, monkeypatch):
    """Trees equal a plain search, with at most half of the rows counted on each level below the root."""
    rng, n = np.random.default_rng(11), 6000
    widths = np.array([2, 12, 40, 1, 3, 7])
    codes = np.stack([rng.integers(0, w, n) for w in widths]).astype(np.uint8)
    y = rng.poisson(np.exp(0.8 * (codes[1] > 8) + 0.6 * (codes[2] > 25) * (codes[4] == 1))).astype(float)
    spec = B.BoostSpec("v", loss=loss, depth=4, eta=1.0, min_child_weight=3, gamma=0.02, reg_lambda=1.5, reg_alpha=0.1)
    start, groups = B.start_margin(spec, y.mean(), np.log1p(y).mean()), B.bundles(widths)
    packed = B.Packed(B.bundled(codes, groups, widths), groups, widths)
    member, counted, count = np.ones(n, np.int32), [], np.bincount
    with monkeypatch.context() as patch:
        patch.setattr(np, "bincount", lambda x, *a: counted.append(len(x)) or count(x, *a))
        state = Local([(0, packed, y, member, np.full((1, n), start))])
        tree, = B._grow(state, [B._Model(spec, 0, start, B._unit(n, y.mean()))], 0, widths - 1, groups)
    assert sum(counted) <= 2 * len(groups) * n * (1 + (spec.depth - 1) / 2)
    cuts = [np.arange(w - 1.0) for w in widths]
    splits, values = plain_tree(spec, codes.astype(float), y, np.full(n, start), cuts)
    assert {k: int(tree.feature[k]) for k in np.flatnonzero(tree.feature >= 0)} == {k: s[1] for k, s in splits.items()}
    assert all(tree.cut[k] == s[2] and tree.gain[k] == pytest.approx(s[0]) for k, s in splits.items())
    assert all(tree.value[k] == pytest.approx(v) for k, v in values.items())
    plain = tree.walk(codes, 4)
    assert np.array_equal(packed.walk(tree, 4, np.arange(n)), plain)
    some = np.flatnonzero(y > 1)
    assert np.array_equal(tree.walk(packed, 3, some), tree.walk(codes, 3, some))


def test_equal_gains_go_to_the_first_feature_in_any_order_of_rows(spark):
    """The second feature is the first one backwards: rounding may not choose between them."""
    rng, n = np.random.default_rng(12), 3000
    a = rng.integers(0, 30, n)
    y = rng.poisson(np.exp(0.05 * a))
    df = spark.createDataFrame([(float(p), float(29 - p), float(t)) for p, t in zip(a, y)],
                               "a double, b double, demand double").repartition(3)
    cuts = [np.arange(29.0)] * 2
    for loss in LOSSES:
        spec = B.BoostSpec(loss, loss=loss, rounds=4, depth=3)
        tree = B.fit(df, ["a", "b"], "demand", [spec], {"all": F.lit(True)}, cuts=cuts)[loss, "all"]
        assert set(tree.feature[tree.feature >= 0].tolist()) == {0}


def test_bins_are_bounded_by_exact_quantiles(spark, monkeypatch):
    """Against sorted values, over several partitions and batches; an approximate sketch misses some."""
    monkeypatch.setattr(B, "HELD_VALUES", 700)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "900")
    try:
        rng, n = np.random.default_rng(13), 60_000
        x = np.stack([rng.normal(size=n), rng.integers(0, 5, n).astype(float), np.full(n, 2.0), rng.gamma(0.3, size=n)])
        df = spark.createDataFrame([(*map(float, r), None) for r in x.T],
                                   "a double, b double, c double, d double, e double").repartition(5)
        got = B.quantile_cuts(df, list("abcde"), 64)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for own, cuts in zip(x, got):
        values = np.sort(own)
        want = np.unique(values[[int(np.ceil(n * k / 64)) - 1 for k in range(1, 64)]])
        assert np.array_equal(cuts, want[want < values[-1]])
    assert len(got) == 5 and not len(got[2]) and not len(got[4])
    assert [len(c) for c in B.quantile_cuts(df.limit(0), ["a", "e"])] == [0, 0]


def test_a_models_margins_are_those_of_its_own_rows_and_scopes_share_a_sample(spark, monkeypatch):
    """Blocks that tasks are handed hold no more than that, and trees are those of margins for all rows."""
    df, _ = table(spark)
    specs = [B.BoostSpec("first", rounds=3, depth=3, subsample=0.8), B.BoostSpec("second", loss="tweedie", rounds=3, depth=2)]
    scopes = {"all": F.lit(True), "m": F.col("rider") == "m", "c": F.col("rider") == "c"}
    held, advance = [], B._advance

    def grow(state, models, *more, real=B._grow):
        held.extend(state.map(lambda b: (len(b[2]), [len(m) for m in b[4]], b[2].itemsize, b[3].itemsize,
                                         [int((b[3] & (1 << k) > 0).sum()) for k in range(3)])).collect())
        return real(state, models, *more)

    monkeypatch.setattr(B, "_grow", grow)
    slim = B.fit(df, ["a", "b", "c"], "demand", specs, scopes)
    assert held and all(sizes == own * 2 and (y, member) == (2, 1) for _, sizes, y, member, own in held)
    assert all(sum(own[1:]) == n == own[0] for n, _, _, _, own in held)
    rng, n = np.random.default_rng(14), 5000
    codes, member = rng.integers(0, 9, (4, n)).astype(np.uint8), np.where(rng.random(n) < 0.4, 3, 1).astype(np.int32)
    y, wide = rng.poisson(1.0, n).astype(float), rng.normal(size=(2, n))
    models = [B._Model(B.BoostSpec("v", depth=2, subsample=0.7), scope, unit=B._unit(n, 1.0)) for scope in (0, 1)]
    tree, drawn = B.Tree(2), []
    tree.feature[0], tree.cut[0] = 2, 4
    tree.value[1:3] = -1.0, 1.0
    monkeypatch.setattr(B, "_sampled", lambda *a, real=B._sampled: drawn.append(a) or real(*a))
    own = [wide[0], wide[1][member & 2 > 0]]
    for level, nodes in ((0, [0]), (1, [1, 2])):
        for kind in (y, B._small(y)):
            args = models, [tree, tree], [np.array(nodes)] * 2, 0, level, 16
            full, some = (dict(B._sums([(0, codes, kind, member, m)], *args)) for m in (wide, own))
            assert full.keys() == some.keys() and all(np.array_equal(full[k], some[k]) for k in full)
    assert len(drawn) == 8  # one sample a call, not one a model
    after = advance((0, codes, y, member, own), models, [tree, tree])[4]
    plain = advance((0, codes, y, member, wide), models, [tree, tree])[4]
    assert np.array_equal(after[0], plain[0]) and np.array_equal(after[1], plain[1][member & 2 > 0])
    assert set(slim) == {(s.name, k) for s in specs for k in scopes}


def test_lanes_give_the_sums_of_one_lane():
    rng, n = np.random.default_rng(15), 9001
    cell, values = np.where(rng.random(n) < 0.9, 3, rng.integers(0, 64, n)), rng.integers(0, 50, n) / 8
    starts, lanes = B.in_lanes(n, 64)
    assert lanes == B.LANES and len(np.unique(starts)) == lanes
    for own in (values, None):
        assert np.array_equal(B.summed(cell + starts, own, 64, lanes), np.bincount(cell, own, 64))
    assert B.in_lanes(100, 64)[1] == 1 and B.in_lanes(n, B.LANE_CELLS)[1] == 1
