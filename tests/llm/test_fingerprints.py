import hashlib

import pytest
from odd_texts import ODD
from pyspark.sql import functions as F

from tripcast.llm import fingerprints as fp


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_edits_and_order(docs_of):
    texts = {i * 3 - 40: t for i, t in enumerate(ODD + [f"doc {i} " + "some words here " * i for i in range(120)])}
    ids = sorted(texts)
    own = {i: texts[i] or "" for i in ids}
    got = {r["doc_id"]: r for r in fp.with_edits(docs_of(list(texts.items()), clash=True)).collect()}
    assert sorted(got) == ids
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        n = len(own[i]) // 4
        new = own[i][:len(own[i]) - n] + own[nxt][:n]
        assert got[i]["n_chars"] == len(own[i])
        assert got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert got[i]["fingerprint"] == fp.as_text(fp.sketches([own[i].encode()])[0])
        assert got[i]["edited_fingerprint"] == fp.as_text(fp.sketches([new.encode()])[0])
        assert 0 <= got[i]["near_edited"] <= 1
        same_next = got[i]["fingerprint"] == got[nxt]["fingerprint"]
        assert (got[i]["near_next"] == 1) == same_next


def test_estimates_follow_true_similarity():
    words = [f"w{i}" for i in range(20000)]
    a, b = " ".join(words), " ".join(words[:15000] + [f"v{i}" for i in range(5000)])
    part = " ".join(words[3000:5000])
    sa, sb, sp = fp.sketches([a.encode(), b.encode(), part.encode()])
    true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert fp.likeness(sa, sb) == pytest.approx(true, abs=0.05)
    assert len(set(sp) & set(sa)) / len(sp) == 1.0 and len(sp) > 150


def test_columns_merge_and_contain(spark, docs_of):
    texts = ["a b c d e f g h " * 200, "x y z " * 300, "", None, "one"]
    df = fp.fingerprint(docs_of(texts)).withColumn("whole", F.lit(None))
    rows = {r["doc_id"]: r["sketch"] for r in df.collect()}
    assert rows[2] == [] == rows[3] and len(rows[4]) == 1 and rows[0] == sorted(rows[0], key=lambda v: v % 2**64)
    pair = spark.createDataFrame([(rows[0], rows[1])], "a array<long>, b array<long>")
    got = pair.select(fp.merged(F.col("a"), F.col("b")).alias("m"), "a", "b").select(
        fp.containment(F.col("a"), F.col("m")).alias("c"), fp.jaccard(F.col("a"), F.col("a")).alias("j")).first()
    assert got["c"] == 1.0 and got["j"] == 1.0


def test_repeated_ids_single_row_and_empty_table(docs_of):
    got = fp.with_edits(docs_of([(1, "same text"), (1, "same text"), (None, "first one here")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_chars"]) for r in got) == [(0, 14), (1, 9), (1, 9)]
    one = fp.with_edits(docs_of(["abcdefgh"])).collect()
    assert len(one) == 1 and one[0]["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()
    assert fp.with_edits(docs_of([])).count() == 0


MASK, MULT, ODD_MULT = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def plain_mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def plain_sketch(text):
    """The sketch by a direct loop over bytes, words and shingles."""
    words = []
    for w in text.encode().split():
        acc = sum((b + 33 if 65 <= b <= 90 else b + 1) * pow(MULT, i, 1 << 64) for i, b in enumerate(w)) & MASK
        words.append(plain_mix(acc ^ len(w) * ODD_MULT & MASK))
    out = set()
    for i in range(max(len(words) - 4, min(len(words), 1))):
        h = len(words) if len(words) < 5 else 0  # a short text's only shingle also tells its length
        for w in words[i:i + 5]:
            h = (h * MULT + w) & MASK
        out.add(plain_mix(h ^ ODD_MULT if len(words) < 5 else h))
    kept = sorted(h for h in out if h < 1 << 61)
    return kept or sorted(out)[:1]


def test_fingerprints_equal_a_direct_loop(docs_of):
    texts = [t or "" for t in ODD] + [f"Some TEXT number {i} " + "of many words " * (i % 9) for i in range(60)]
    got = {r["doc_id"]: r for r in fp.with_edits(docs_of(texts)).collect()}
    for i, t in enumerate(texts):
        nxt = texts[(i + 1) % len(texts)]
        n = len(t) // 4
        own, new, following = (plain_sketch(x) for x in (t, t[:len(t) - n] + nxt[:n], nxt))
        assert got[i]["fingerprint"] == "".join(f"{h:016x}" for h in own)
        assert got[i]["edited_fingerprint"] == "".join(f"{h:016x}" for h in new)
        for column, other in (("near_edited", new), ("near_next", following)):
            both, union = len(set(own) & set(other)), len(set(own) | set(other))
            assert got[i][column] == pytest.approx(both / union if union else 1.0)
