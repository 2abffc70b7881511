import zlib
from collections import defaultdict

import numpy as np
import pytest
from odd_texts import ODD

from tripcast.llm import packing
from tripcast.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")
PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def check(rows, texts, library, window=1024):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for i, own in by_doc.items():
        ids, at = library.encode(texts[i] or "", add_special_tokens=False).ids + [0], 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:at], "<u4").tobytes())
        assert at == len(ids)
    short = 0
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
        short += at < window
    return by_seq, short


def test_encoder_matches_library(library):
    texts = [t or "" for t in ODD] + ["<|endoftext|>", " x", "x ", "a  b\n\n c", "it's\tCAFÉ １２", "\n", "  "]
    got = packing.encoder(PATH).encode(texts)
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_whole_and_gapless(docs_of, library):
    texts = dict(enumerate(ODD + [f"text number {i} " * (i % 40) for i in range(300)]))
    rows = packing.pack(docs_of(list(texts.items()), clash=True), PATH).collect()
    _, short = check(rows, texts, library)
    assert short <= 2


def test_windows_keep_the_mixture(docs_of, library):
    texts = {i: "some words of a text " * (20 + i % 7) for i in range(600)}
    sources = {i: "abc"[0 if i % 10 < 7 else 1 + i % 2] for i in texts}
    rows = packing.pack(docs_of(list(texts.items()), sources), PATH).collect()
    by_seq, _ = check(rows, texts, library)
    total, share = 0, defaultdict(int)
    for r in rows:
        share[sources[r["doc_id"]]] += r["length"]
        total += r["length"]
    full = {s: own for s, own in by_seq.items() if sum(r["length"] for r in own) == 1024}
    assert len(full) > 50
    for own in full.values():
        for s in share:
            assert abs(sum(r["length"] for r in own if sources[r["doc_id"]] == s) - 1024 * share[s] / total) <= 4


def test_targets_hold_until_a_queue_is_empty(docs_of, library):
    texts = {i: "some words of a text " * 30 for i in range(200)}
    sources = {i: "ab"[i % 2] for i in texts}
    rows = packing.pack(docs_of(list(texts.items()), sources), PATH, targets={"a": 3, "b": 1}).collect()
    by_seq, _ = check(rows, texts, library)
    first = by_seq[min(by_seq)]
    assert abs(sum(r["length"] for r in first if sources[r["doc_id"]] == "a") - 768) <= 1


def test_blocks_follow_each_other():
    totals = np.array([5_000_000, 1_234_567, 89, 1], np.int64)
    plan = packing.Schedule(np.arange(4), totals, block_windows=64)
    whole = [plan.lay(b) for b in range(plan.n_blocks)]
    assert (whole[0][0][0] == 0).all() and (whole[-1][0][-1] == totals).all()
    for (paid, _), (then, _) in zip(whole, whole[1:]):
        assert (paid[-1] == then[0]).all()
    for paid, _ in whole:
        size = np.diff(paid, axis=0)
        assert (size >= 0).all() and (size.sum(axis=1)[:-1] == 1024).all()


def test_repeated_rows_and_empty_table(docs_of, library):
    rows = packing.pack(docs_of([(7, "same text"), (7, "same text"), (None, None)]), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["doc_tokens"]) for r in rows) == [(0, 1), (7, 3), (7, 3)]
    assert packing.pack(docs_of([]), PATH).count() == 0


def test_sources_of_one_hash_keep_their_own_targets(spark, docs_of, library):
    from pyspark.sql import functions as F
    names = spark.range(3000).select(F.concat(F.lit("site-"), "id").alias("s"))
    same = names.groupBy(F.pmod(F.xxhash64("s"), F.lit(packing.QUEUES))).agg(F.sort_array(F.collect_list("s")).alias("s"))
    a, b = same.where(F.size("s") > 1).orderBy("s").first()["s"][:2]
    texts = {i: "some words of a text " * 30 for i in range(200)}
    # all of a's documents come first, so that a shared queue would pack them first
    sources = {i: a if i < 100 else b for i in texts}
    for targets, share in ((None, 512), ({a: 3, b: 1}, 768)):
        rows = packing.pack(docs_of(list(texts.items()), sources), PATH, targets=targets).collect()
        by_seq, _ = check(rows, texts, library)
        first = by_seq[min(by_seq)]
        assert abs(sum(r["length"] for r in first if sources[r["doc_id"]] == a) - share) <= 1


def test_null_source_is_a_queue_of_its_own(docs_of, library):
    texts = {i: "some words of a text " * 30 for i in range(100)}
    sources = {i: None if i % 2 else "a" for i in texts}
    rows = packing.pack(docs_of(list(texts.items()), sources), PATH).collect()
    by_seq, _ = check(rows, texts, library)
    assert abs(sum(r["length"] for r in by_seq[min(by_seq)] if sources[r["doc_id"]] is None) - 512) <= 1


def test_new_chunks_are_encoded_in_one_go(monkeypatch):
    """Ids are the tokenizer's, whatever stands beside the spaces; only odd chunks are encoded alone."""
    import random
    from tokenizers import Tokenizer
    path = tokenizer_path("byte_bpe_50k.json")
    plain, enc = Tokenizer.from_file(path), packing.Encoder(path)
    rnd = random.Random(3)
    bits = ["a", "the", "It's", "x\n", "\ny", "\n", "1234", "don't", "--", "é", "ZqX7", " ", "  ", "end.\n\n", "'s", "(b)"]
    texts = [" ".join(rnd.choices(bits, k=rnd.randint(1, 12))) for _ in range(400)] + ["", " ", "a", "\n", "word " * 50]
    for a in range(0, len(texts), 90):
        for t, ids in zip(texts[a:a + 90], enc.encode(texts[a:a + 90])):
            assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)

    class Counted:
        calls = 0

        def __init__(self, bpe):
            self.bpe = bpe

        def encode_ordinary(self, text):
            Counted.calls += 1
            return self.bpe.encode_ordinary(text)

        def encode_to_numpy(self, *args, **kw):
            Counted.calls += 1
            return self.bpe.encode_to_numpy(*args, **kw)

    enc.forget()
    enc.bpe = Counted(enc.bpe)
    enc.encode(["first " + " ".join(f"w{i}" for i in range(500))])
    assert Counted.calls == 2  # the first word, and all others together


def test_no_chunks_are_held_after_a_task(docs_of):
    """Workers outlive their tasks: what one has learned must not stay through later stages."""
    packing.tokenised(docs_of(["some words here", "and there"]), PATH, "doc_id", "text", "source").count()

    def held(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(e.number) for e in packing._ENCODERS.values())])], ["n"])

    spark = docs_of(["x"]).sparkSession
    packing.tokenised(docs_of(["some words here", "and there"] * 8), PATH, "doc_id", "text", "source").collect()
    assert {r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(held, "n long").collect()} == {0}
