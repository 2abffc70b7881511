import hashlib
import math

import numpy as np

from tripcast.llm import lloyd_codes


def plain(rows, parts=8, entries=16, rounds=6):
    """Codes by a direct loop over Python integers: {row number: (id, code, error, label_error, digest)}."""
    kept = [(i, [math.floor(4096 * c) for c in v], lab) for i, v, lab in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    d = len(kept[0][1])
    ends = [d * p // parts for p in range(parts + 1)]
    part = lambda v, p: v[ends[p]:ends[p + 1]]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[part(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(part(v, p), c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = [[] for _ in books[p]]
            for _, v, _ in kept:
                members[nearest(v, p)[1]].append(part(v, p))
            new.append([[sum(c) // len(own) for c in zip(*own)] if own else books[p][e]
                        for e, own in enumerate(members)])
        books = new
    out = []
    for i, v, lab in kept:
        found = [nearest(v, p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(x for x, _ in found), lab))
    by_label = {}
    for _, _, err, lab in out:
        by_label[lab] = by_label.get(lab, 0) + err
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(i), code, err, by_label[lab], sha) for i, code, err, lab in out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows],
                               "vec_id long, embedding array<double>, label int, x string, e int")
    out = lloyd_codes.compress(df, **kw)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((str(r[0]), r[1], r[2], r[3], r[4]) for r in out.collect())


def test_equals_a_plain_loop(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 16))
    rows = [(i, (centres[i % 9] + 0.4 * rng.normal(size=16)).tolist(), i % 3 if i % 5 else None) for i in range(600)]
    # a hot group of equal vectors, spread over several owners by salts
    rows += [(1000 + i, rows[7][1], 1) for i in range(300)]
    monkeypatch.setattr(lloyd_codes, "OWNER_ROWS", 100)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(7)
    got = sorted((str(r[0]), *r[1:]) for r in lloyd_codes.compress(df).collect())
    assert got == plain(rows)


def test_odd_rows_repeated_ids_and_odd_length(spark):
    rng = np.random.default_rng(9)
    rows = [(i // 2, rng.normal(size=11).tolist(), None if i % 4 else 1) for i in range(60)]
    rows += [(None, rng.normal(size=11).tolist(), 2), (70, None, 1), (71, [1.0] * 10 + [None], 1),
             (72, [1.0] * 10 + [float("nan")], 1), (73, [float("-inf")] + [0.0] * 10, 1), (74, [], 1),
             (75, [0.0] * 11, 1), (75, [0.0] * 11, 1)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows + [(0, [1.0, 2.0], 1)]) == plain(rows)


def test_fewer_rows_than_entries_single_row_and_empty_table(spark):
    few = [(5, [0.25, -0.5, 1.0, 2.0, 0.1, 0.2, 0.3, -0.4], 1), (3, [0.0] * 8, None)]
    assert run(spark, few) == plain(few)
    short = [(1, [0.5, -1.5], 0)]
    assert run(spark, short)[0][:4] == ("1", "00" * 8, 0, 0)
    assert run(spark, []) == []


def test_huge_components_are_bounded(spark):
    rows = [(i, [1e300 if i % 2 else -1e300] * 8, 0) for i in range(20)]
    got = run(spark, rows)
    assert len(got) == 20 and all(r[2] >= 0 for r in got)
