import random
import zlib

import numpy as np
import pytest
from odd_texts import ODD

from tripcast.llm import toxicity


def corpus(n=900, seed=4):
    """Invented prose; toxic texts also hold forms of two stems."""
    rng = random.Random(seed)
    parts = ["an", "er", "on", "the", "st", "re", "ing", "ti", "es", "ou"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))
    texts, toxic = [], []
    for _ in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        bad = rng.random() < 0.2
        if bad:
            for _ in range(max(2, len(words) // 15)):
                words[rng.randrange(len(words))] = rng.choice(["grumf", "blorst"]) + rng.choice(parts)
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


@pytest.fixture(scope="module")
def scored(spark, docs_of):
    texts, toxic = corpus()
    texts = texts + ODD
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(3, 1, None), (10**6, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs_of(texts, clash=True), labels).collect()
    return {r["doc_id"]: r for r in rows}, toxic, texts, labels


def test_held_out_accuracy(scored):
    got, toxic, texts, _ = scored
    assert len(got) == len(texts)
    held = [i for i in range(len(toxic)) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(len(toxic)))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    hit = sum(got[i]["predicted"] == toxic[i] for i in held)
    assert hit / len(held) > 0.97


def test_labels_of_held_out_rows_are_never_read(spark, docs_of, scored):
    got, toxic, texts, _ = scored
    flip = [(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in enumerate(toxic)]
    labels = spark.createDataFrame(flip, "doc_id long, quality int, toxic int")
    again = {r["doc_id"]: r["score"] for r in toxicity.score(docs_of(texts), labels).collect()}
    assert all(abs(again[i] - got[i]["score"]) < 1e-6 for i in again)


def test_ratios_match_a_plain_model(spark):
    """The slot tables give the log-likelihood ratio of a directly written Kneser-Ney model."""
    toxic, plain, K, D = ["abca", "abd", "xab"] * 3, ["abc", "bca", "cab", "axb"] * 4, toxicity.ORDER, toxicity.DISCOUNT

    def grams(words):
        out = {}
        for w in words:
            s = "\x01" + w + "\x02"
            for i in range(1, len(s)):
                g = s[max(0, i - K + 1):i + 1]
                out[g] = out.get(g, 0) + 1
        return out

    t, o = grams(toxic), grams(plain)
    level, levels = set(t) | set(o), {}
    for k in range(K - 1, 0, -1):
        count = {}
        for g in level:
            s = g[1:] if len(g) == k + 1 else g
            count[s] = count.get(s, 0) + 1
        levels[k], level = count, set(count)

    def shared(g):
        own = {s: n for s, n in levels[len(g)].items() if len(s) == len(g) and s[:-1] == g[:-1]}
        low = shared(g[1:]) if len(g) > 1 else 1 / (len(own) + 1)
        return (max(own[g] - D, 0) + D * len(own) * low) / sum(own.values())

    def prob(g, counts):
        low = shared(g[1:] if len(g) == K else g)
        own = {s: n for s, n in counts.items() if s[:-1] == g[:-1]}
        return (max(counts.get(g, 0) - D, 0) + D * len(own) * low) / sum(own.values()) if own else low

    want = {g: np.log(prob(g, t) / prob(g, o)) for g in set(t) | set(o)}
    rows = spark.createDataFrame([(w, 1, h) for w in toxic for h in (0, 1)] + [(w, 0, h) for w in plain for h in (0, 1)],
                                 "text string, toxic int, half int")
    seen, _ = toxicity.ratios(toxicity.gram_counts(rows))
    got = {r["g"]: r["llr"] for r in seen.where("m = 0").collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[g] - want[g]) < 1e-9 for g in want)


def test_slots_agree_between_engines(spark):
    grams = ["\x01a", "abc", "é日😀x", "\x01abcd"[:toxicity.ORDER]]
    got = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "g string").select(toxicity._slot(toxicity.F.col("g"))).collect()]
    for g, slot in zip(grams, got):
        h = 0
        for c in g:
            h = (h * toxicity._BASE + ord(c) + 1) % toxicity._PRIME
        assert slot == h % toxicity.SLOTS


def test_without_labels_and_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(docs_of(ODD), none).collect()} == {0.0}
    assert toxicity.score(docs_of([]), none).count() == 0
    docs = docs_of(ODD)
    kept = toxicity.keep_ordinary(docs, none)
    assert kept.columns == docs.columns and kept.count() == len(ODD)


def plain_features(words, seen, contexts, m):
    """mean_ratio, over_1, over_2, words by looking each n-gram up under its own name."""
    def ratio(w):
        s, out = "\x01" + w + "\x02", 0.0
        for i in range(1, len(s)):
            g = s[max(0, i - toxicity.ORDER + 1):i + 1]
            out += seen.get((m, g), contexts.get((m, g[:-1]), 0.0))
        return out

    r = [ratio(w) for w in words]
    n = max(len(r), 1)
    return [sum(r) / n, *(sum(min(max(x - k, 0.0), 6.0) for x in r) / n for k in (1, 2)), len(r)]


@pytest.mark.parametrize("dictionary_bytes", [toxicity.DICTIONARY_BYTES, 2_000, 0])
def test_every_ngram_keeps_its_own_ratio(spark, docs_of, dictionary_bytes):
    """Also n-grams that shared a slot of the hash, and words that no dictionary holds."""
    def slot(g):
        h = 0
        for c in g:
            h = (h * toxicity._BASE + ord(c) + 1) % toxicity._PRIME
        return h % toxicity.SLOTS

    # begins of words that share a slot, one in the toxic texts and one in the ordinary ones
    rng, first, pair = random.Random(1), {}, None
    for _ in range(200_000):
        w = "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(toxicity.ORDER - 1))
        if first.setdefault(slot("\x01" + w), w) != w:
            pair = (first[slot("\x01" + w)], w)
            break
    assert pair
    texts, toxic = corpus(200, seed=9)
    texts = [t + " " + pair[1 - bad] for t, bad in zip(texts, toxic)] + ODD + [pair[0], pair[1], "unseen" * 3]
    docs = docs_of(texts, clash=True)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels, dictionary_bytes=dictionary_bytes).collect()}
    train = [(t, toxic[i], zlib.crc32(str(i).encode()) // 4 % 2) for i, t in enumerate(texts[:200])
             if zlib.crc32(str(i).encode()) % 4 != 2]
    seen, contexts = ({(r["m"], r["g"]): r["llr"] for r in t.collect()} for t in toxicity.ratios(
        toxicity.gram_counts(spark.createDataFrame(train, "text string, toxic int, half int"))))
    for i, t in enumerate(texts):
        want = plain_features(toxicity.words_of(t or ""), seen, contexts, toxicity.ALL)
        assert np.allclose([got[i][c] for c in toxicity.FEATURES], want, atol=1e-9), (i, t)


def test_kept_rows_are_those_below_the_threshold(spark, docs_of, scored):
    got, toxic, texts, labels = scored
    docs = docs_of(texts, clash=True)
    for most in (toxicity.DICTIONARY_BYTES, 2_000):
        kept = toxicity.keep_ordinary(docs, labels, dictionary_bytes=most).collect()
        assert sorted(r["doc_id"] for r in kept) == sorted(i for i, r in got.items() if not r["predicted"])
