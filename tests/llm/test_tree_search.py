import math
import random
import re

import numpy as np

from odd_texts import ODD
from tripcast.llm import tree_search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(docs, items, k=50):
    """All scores by a direct loop."""
    terms = [(i, TERM.findall(lower(t))) for i, t in docs]
    terms = [(i, t) for i, t in terms if t]
    n, length = len(terms), sum(len(t) for _, t in terms)
    df = {}
    for _, t in terms:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(lower(t)))
    out = []
    for item, own in asked.items():
        scored = []
        for i, t in terms:
            m = 50 + 50 * len(t) * n // length
            s = 0
            for w in own & set(t):
                tf = t.count(w)
                s += math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (
                    1_000_000_000 * tf // (1000 * tf + 20 * m))
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def run(spark, docs_of, docs, items, **kw):
    asked = spark.createDataFrame([(i, t, 0, 0) for i, t in items], "item_id long, text string, rank int, item int")
    out = tree_search.rank(docs_of(docs, clash=True), asked, **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus(n, seed=2):
    rng = random.Random(seed)
    word = lambda: f"w{min(int(rng.paretovariate(0.6)), 900)}"
    docs = [(i, " ".join(word() for _ in range(rng.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[i % 7][1].upper()) for i in range(n // 3)]  # a third are copies
    items = [(i, " ".join(word() for _ in range(rng.randint(1, 25)))) for i in range(12)]
    return docs, items


def test_equals_all_scores(spark, docs_of, monkeypatch):
    monkeypatch.setattr(tree_search, "TREE_ROWS", 300)
    monkeypatch.setattr(tree_search, "LEAF", 8)
    docs, items = corpus(1200)
    assert run(spark, docs_of, docs, items) == plain(docs, items)


def test_items_in_several_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(tree_search, "ITEM_BYTES", 300)
    docs, items = corpus(150, seed=6)
    assert run(spark, docs_of, docs, items, k=7) == plain(docs, items, 7)


def test_odd_texts_ties_repeated_rows_and_null_ids(spark, docs_of):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(900, "same words"), (899, "same words"), (899, "same words"),
                                                 (None, "Same-words"), (901, None), (902, "")]
    items = [(1, "same"), (1, "WORDS"), (2, None), (3, ""), (4, "absentterm"), (None, "words of none")]
    items += [(10 + i, t) for i, t in enumerate(ODD)]
    assert run(spark, docs_of, docs, items) == plain(docs, items)


def test_bounds_hold_for_every_node():
    rng = np.random.default_rng(0)
    items = tree_search.Items([(i, " ".join(f"t{j}" for j in rng.integers(0, 60, 8))) for i in range(5)])
    size = len(items.number)
    cols = [np.sort(rng.choice(size, rng.integers(1, 10), replace=False)) for _ in range(500)]
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in cols])])
    x = rng.integers(1, 1_000_000, bounds[-1])
    tree = tree_search.Tree(np.arange(500), bounds, np.concatenate(cols), x, items, rng.integers(0, 20_000, size))

    def below(node):
        return tree.leaf[node] if tree.kids[node] is None else np.concatenate([below(k) for k in tree.kids[node]])

    for i, own in enumerate(items.terms):
        score = np.array([sum(int(tree.weights[c]) * int(v) for c, v in zip(cols[r], x[bounds[r]:bounds[r + 1]])
                              if c in own) for r in range(500)])
        for node in range(len(tree.kids)):
            assert score[below(node)].max() <= tree.bound[node, i]


def test_empty_tables(spark, docs_of):
    assert run(spark, docs_of, [], [(1, "a")]) == []
    assert run(spark, docs_of, [(1, "a")], []) == []
    assert run(spark, docs_of, [(1, "..."), (2, None)], [(1, "a")]) == []
