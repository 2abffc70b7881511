"""Document fingerprints: sketches that keep every shingle hash below a fixed fraction.

A text's sketch holds the 64-bit hashes of its five-word shingles (A-Z lower-cased,
words split at ASCII white space; fewer words make one shingle) that lie below
``FRACTION`` of the hash range, and the least hash if none does.  The fraction is
the same for all texts, so sketches can be merged by union, and containment can be
estimated between texts of very different length.

``with_edits`` compares each text with an edited one, whose last quarter is replaced
by the start of the next document's text in id order (the first after the last).
Rows are dealt to partitions by id ranges; each range also gets a copy of the next
range's first row, so no row waits for another partition.

Defined cases: a null text counts as empty; a text without words has an empty sketch;
two empty sketches are alike (1), an empty and another are not (0); a null id sorts
first; rows with the same id follow each other in the order of their texts; a single
row is its own next; an empty table gives an empty table; other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import chunks, distinct_per_text, shingle_hashes, text_of, word_hashes

WORDS, FRACTION = 5, 1 / 8
_FIRST = -(1 << 63)
CHUNK_CHARS = 2_000_000


def sketches(texts: list[bytes], words: int = WORDS, fraction: float = FRACTION) -> list[np.ndarray]:
    """Sorted hashes that each text keeps."""
    out = []
    limit = np.uint64(int(fraction * 2.0**64))
    for a, b in chunks(texts):
        hashes, owner = shingle_hashes(*word_hashes(texts[a:b]), words)
        n = b - a
        kept, bounds = distinct_per_text(hashes[hashes < limit], owner[hashes < limit], n)
        least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, owner, hashes)
        some = np.bincount(owner, minlength=n) > 0
        for i in range(n):
            own = kept[bounds[i]:bounds[i + 1]]
            out.append(own if len(own) or not some[i] else least[i:i + 1])
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sketches."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - both
    return both / union if union else 1.0


def as_text(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                fraction: float = FRACTION) -> DataFrame:
    """id, sketch (sorted hashes as long)."""
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = sketches([t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()], words, fraction)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.astype(np.int64) for s in own], pa.list_(pa.int64()))],
                names=["id", "sketch"])

    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, sketch array<long>").withColumnRenamed("id", id_col)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has, whatever their lengths."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts together (without shingles across their border)."""
    return F.array_sort(F.array_union(a, b))


# ---------------------------------------------------------------------------
def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def _ranges(keys: DataFrame, n: int) -> list[int]:
    """Upper bounds that cut the keys into about n equal ranges (at most n - 1 numbers)."""
    if n < 2:
        return []
    cuts = keys.agg(F.percentile_approx("key", [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0]
    return sorted(set(cuts or []))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
               fraction: float = FRACTION) -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    key = F.coalesce(docs[id_col].cast("long"), F.lit(_FIRST))
    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("t"), key.alias("key"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.array(_ranges(rows.select("key"), n), np.int64)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), side="left").astype(np.int32))

    placed = rows.withColumn("range", range_of("key"))
    # one row per range: its first key goes also to the range before (the first one's to the last)
    heads = placed.groupBy("range").agg(F.min("key").alias("key")).orderBy("range").collect()
    before = {heads[i]["key"]: heads[i - 1]["range"] for i in range(len(heads))}
    if before:
        to = spark.createDataFrame([(k, r) for k, r in before.items()], "key long, range int")
        extra = rows.where(F.col("key").isin(list(before))).join(F.broadcast(to), "key")
        placed = placed.withColumn("ahead", F.lit(0)).unionByName(extra.withColumn("ahead", F.lit(1)))
    else:
        placed = placed.withColumn("ahead", F.lit(0))
    parts = placed.repartitionById(len(bounds) + 1, F.col("range")).sortWithinPartitions("ahead", "key", "t")
    kind = dict(rows.dtypes)["id"]
    id_type = to_arrow_type(rows.schema["id"].dataType)

    def finish(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Results of all texts but the last, which is only the next of the one before."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        new = [edited(a, b).encode("utf-8", "surrogatepass") for a, b in zip(texts, texts[1:])]
        own, other = sketches(raw, words, fraction), sketches(new, words, fraction)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_type), pa.array([len(t) for t in texts[:-1]], pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in new], pa.string()),
             pa.array([as_text(s) for s in own[:-1]], pa.string()), pa.array([as_text(s) for s in other], pa.string()),
             pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
             pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64())],
            names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, over = [], [], 0, False
        for batch in batches:
            for i, t, ahead in zip(*(batch.column(c).to_pylist() for c in ("id", "t", "ahead"))):
                if over:
                    continue
                texts.append(t)
                size += len(t)
                if ahead:
                    over = True
                else:
                    ids.append(i)
                if size > CHUNK_CHARS and len(texts) > 1:
                    yield finish(ids[:len(texts) - 1], texts)
                    ids, texts, size = ids[len(texts) - 1:], texts[-1:], 0
        if len(texts) > 1:
            yield finish(ids[:len(texts) - 1], texts)

    out = parts.select("id", "t", "ahead").mapInArrow(
        run, f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
