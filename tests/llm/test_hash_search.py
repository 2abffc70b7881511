import numpy as np
import pytest

from tripcast.llm import hash_search


def brute(rows, k=10, every=100):
    """Exact neighbours by a plain loop: {query position: [(distance, id)]}."""
    kept = [(i, None if v is None else np.array([np.nan if x is None else x for x in v], float)) for i, v in rows]
    kept = [(i, v) for i, v in kept if v is not None and len(v) and np.isfinite(v).all() and (v != 0).any()]
    out = []
    for a, (i, v) in enumerate(kept):
        if i is None or i % every:
            continue
        near = sorted((np.sqrt(((w - v) ** 2).sum()), float("inf") if j is None else j)
                      for b, (j, w) in enumerate(kept) if b != a)
        out.append((i, near[:k]))
    return out


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, score string")


def per_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    return out


def test_recall_and_scores_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + 0.7 * rng.normal(size=24)).astype(np.float32).tolist()) for i in range(3000)]
    got = per_query(hash_search.nearest(frame(spark, rows)))
    want = dict(brute(rows))
    assert set(got) == set(want)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.9
    for q, found in got.items():
        assert len(found) == 10 and q not in {i for _, i in found}
        near = {i for _, i in found}
        exact = {i: d for d, i in dict(brute([r for r in rows if r[0] == q or r[0] in near]))[q]}
        assert [i for _, i in found] == [i for _, i in sorted((exact[i], i) for _, i in found)]
        assert [d for d, _ in found] == pytest.approx([exact[i] for _, i in found], abs=1e-12)


def test_pigeonhole_finds_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 1 << 16, (400, 16)).astype(np.uint16)
    codes[200:] = codes[rng.integers(0, 200, 200)] ^ (rng.random((200, 16)) < 0.4).astype(np.uint16)
    block = hash_search.Block(np.arange(400), np.arange(400), np.zeros((400, 2)), codes)
    words = codes.view(np.uint64)
    for radius in (0, 1, 5, 15, 16, 17, 40, 100, 128, 255, 256):
        for q in (0, 7, 399):
            apart = np.bitwise_count(words ^ words[q]).sum(axis=1)
            assert block.within(codes[q], radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_odd_vectors_ties_repeated_rows_and_few_candidates(spark):
    one = [1.0, 0.0, 2.0]
    rows = [(0, one), (3, one), (2, one), (0, one), (None, [1.0, 0.0, 2.5]), (5, None), (6, [0.0, 0.0, 0.0]),
            (7, [1.0, None, 2.0]), (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (10, []),
            (100, [1.0, 0.0, 3.0]), (11, [1.0, 2.0])]
    got = hash_search.nearest(frame(spark, rows, "double")).collect()
    own = [(r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == 100]
    assert sorted(own) == [(1, None, 0.5), (2, 0, 1.0), (3, 0, 1.0), (4, 2, 1.0), (5, 3, 1.0)]
    twice = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 0 and r["vec_id"] is not None)
    assert twice == [(1, 0), (1, 0), (2, 2), (2, 2), (3, 3), (3, 3), (5, 100), (5, 100)]


def test_queries_far_from_all_codes_are_asked_again(spark):
    rng = np.random.default_rng(1)
    close = rng.normal(size=8)
    rows = [(i, (close + 1e-3 * rng.normal(size=8)).tolist()) for i in range(1, 400)] + [(400, (-50 * close).tolist())]
    got = per_query(hash_search.nearest(frame(spark, rows, "double"), k=5))
    want = dict(brute(rows, 5))[400]
    assert [i for _, i in got[400]] == [i for _, i in want]
    assert [d for d, _ in got[400]] == pytest.approx([d for d, _ in want])
    assert all(len(x) == 5 for x in got.values())


def test_empty_table_and_single_row(spark):
    assert hash_search.nearest(frame(spark, [])).count() == 0
    assert hash_search.nearest(frame(spark, [(0, [1.0, 2.0])])).count() == 0
    assert hash_search.nearest(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
