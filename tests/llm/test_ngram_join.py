import random
import re
from itertools import combinations

import numpy as np
import pytest
from odd_texts import ODD

from tripcast.llm import ngram_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k=4, num=85, den=100):
    sets = [shingles(t, k) for _, t in rows]
    head = list(range(len(rows)))

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and den * both >= num * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)), key=lambda i: rows[i][0])
            head[y] = x
    return sorted((i, len(s), rows[top(n)][0]) for n, ((i, _), s) in enumerate(zip(rows, sets)))


def variants(rng, n, words, edits):
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            at, how = rng.randrange(len(own)), rng.random()
            if how < 0.4:
                own[at] = f"x{rng.randint(0, 9999)}"
            elif how < 0.7:
                own.insert(at, "new")
            else:
                del own[at]
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("k, num, den", [(4, 85, 100), (5, 80, 100)])
def test_components_match_brute_force(docs_of, k, num, den):
    rng = random.Random(11)
    texts = list(ODD) + ["one two three", "One  TWO three", "one two"]
    for words, edits in [(6, 1), (9, 2), (14, 2), (25, 3), (60, 5), (200, 12), (700, 40)]:
        texts += variants(rng, 25, words, edits)
    shared = " ".join(f"p{i}" for i in range(80))  # a passage that many different texts have
    texts += [shared + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(30)) for _ in range(60)]
    rows = list(enumerate(texts))
    got = ngram_join.join_components(docs_of(texts, clash=True), k, num, den).collect()
    assert sorted(map(tuple, got)) == brute(rows, k, num, den)


def test_chain_of_links_is_one_component(docs_of):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(f"z{j}" if j < 4 * i else w for j, w in enumerate(words)) for i in range(40)]
    rows = list(enumerate(texts))
    got = sorted(map(tuple, ngram_join.join_components(docs_of(texts)).collect()))
    assert got == brute(rows) and len({c for _, _, c in got}) == 1


def test_rtree_finds_what_the_bound_admits():
    rng = np.random.default_rng(3)
    vec = rng.poisson(3, (300, 16)).astype(np.uint8)
    vec[150:] = vec[:150] + (rng.random((150, 16)) < 0.1)
    vec[:, 0] = 255
    size = vec.sum(axis=1, dtype=np.int64) + rng.integers(0, 9, 300)
    over = ngram_join.excess(size, vec)
    tree = ngram_join.RTree(size, vec)
    for i in range(300):
        want = np.flatnonzero(np.minimum(vec, vec[i]).sum(axis=1, dtype=np.int64) + np.minimum(over, over[i]) >= ngram_join.least_overlap(size + size[i], 85, 100))
        assert sorted(tree.search(int(size[i]), vec[i], 85, 100)) == want.tolist()


def test_large_groups_are_cut_into_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    texts = variants(random.Random(2), 60, 40, 6)
    got = sorted(map(tuple, ngram_join.join_components(docs_of(texts)).collect()))
    assert got == brute(list(enumerate(texts)))


def test_odd_ids_repeated_rows_and_empty_table(docs_of):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (3, "A b c d e"), (9, None)]
    got = ngram_join.join_components(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == [(0, 3), (3, 3), (5, 3), (5, 3), (9, 9)]
    docs = docs_of([(5, "a b c d e"), (5, "a b c d e"), (6, "A b c d e"), (9, None)])
    kept = ngram_join.keep_one_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [5, 9]
    assert ngram_join.join_components(docs_of([])).count() == 0


def test_rows_of_one_id_are_told_apart(docs_of):
    base = [f"w{i}" for i in range(60)]
    near = base[:-1] + ["other"]
    rows = [(0, " ".join(base)), (1, "quite another text of several words"), (1, " ".join(near)),
            (2, " ".join(near) + " "), (2, " ".join(near)), (3, None), (3, None), (3, ""), (4, "..")]
    kept = ngram_join.keep_one_each(docs_of(rows, clash=True)).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in kept) == [
        (0, rows[0][1]), (1, rows[1][1]), (3, ""), (3, ""), (4, "..")]
