import zlib
from collections import defaultdict

import xxhash
from odd_texts import ODD
from tripcast.llm import sharding


def check(rows, texts, shards, row_bytes=16):
    size = lambda t: (0 if t is None else len(t.encode())) + row_bytes
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted(
        (size(t), zlib.crc32((t or "").encode())) for t in texts)
    per = defaultdict(list)
    for r in rows:
        per[r["shard"]].append(r)
    assert all(0 <= s < shards for s in per)
    for own in per.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    total, largest = sum(map(size, texts)), max(map(size, texts))
    for s in range(shards):
        assert abs(sum(r["size"] for r in per[s]) - total / shards) <= largest


def test_shards_are_balanced_and_gapless(docs_of):
    texts = [f"text {i} " * (i % 17 + 1) for i in range(400)] + ["copy " * 40] * 200 + ODD[:6]
    check(sharding.byte_shards(docs_of(texts, clash=True), shards=8).collect(), texts, 8)


def test_few_rows_long_text_and_repeated_rows(docs_of):
    check(sharding.byte_shards(docs_of(ODD), shards=4).collect(), ODD, 4)
    same = [(1, "a"), (1, "a"), (None, "b"), (None, None)]
    rows = sharding.byte_shards(docs_of(same), shards=2).collect()
    check(rows, [t for _, t in same], 2)


def test_empty_table(docs_of):
    assert sharding.byte_shards(docs_of([]), shards=4).count() == 0


def test_every_document_lies_where_a_plain_sum_puts_it(docs_of):
    texts = [t or "" for t in ODD] + [f"text {i} " * (i % 23) for i in range(150)] + ["copy " * 30] * 60
    rows = list(enumerate(texts))
    signed = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) ^ 1 << 63) - (1 << 63)
    total, shards = sum(len(t.encode()) + 16 for t in texts), 7
    want, before, slots = {}, 0, {}
    for i, t in sorted(rows, key=lambda r: (signed(r[1]), r[0])):
        size = len(t.encode()) + 16
        shard = min((before + size // 2) * shards // total, shards - 1)
        want[i] = (size, zlib.crc32(t.encode()), shard, slots.setdefault(shard, 0))
        slots[shard] += 1
        before += size
    got = {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"], r["slot"])
           for r in sharding.byte_shards(docs_of(rows, clash=True), shards=shards).collect()}
    assert got == want
