"""Balanced contiguous shards by global prefix sums of byte sizes.

Rows are range-partitioned on (content hash, id), so equal texts lie side by
side and even a huge group of copies is cut where a target falls.  Each
partition reports its totals; their prefix sums give every row its global byte
position, and shard i takes the rows whose middle byte lies in the i-th equal
share of all bytes.

Defined cases: a null text has no bytes (its row still weighs ``row_bytes``); a
null id sorts first; repeated rows take one place each; fewer rows than shards
leave shards empty; an empty table gives an empty table; other columns of the
input are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import written

_PLACED = "doc_id {id}, size long, text_crc32 long, part int, pos long, before long"


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the rows of a sorted partition and sum the bytes before each."""
    part, rows, total = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        size = batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
        n, ends = len(size), np.cumsum(size) + total
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("size"), batch.column("text_crc32"),
             pa.array(np.full(n, part, np.int32)), pa.array(np.arange(rows, rows + n)), pa.array(ends - size)],
            names=["doc_id", "size", "text_crc32", "part", "pos", "before"])
        rows, total = rows + n, int(ends[-1]) if n else total


def byte_shards(docs: DataFrame, shards: int = 40, row_bytes: int = 16, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: slots count from 0 in each shard."""
    spark = docs.sparkSession
    raw = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("t"))
    sized = raw.select(
        "doc_id", (F.coalesce(F.octet_length("t"), F.lit(0)) + F.lit(row_bytes)).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("t").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce("t", F.lit(""))).alias("__h"))
    ordered = sized.repartitionByRange("__h", "doc_id").sortWithinPartitions("__h", "doc_id")
    kind = dict(sized.dtypes)["doc_id"]
    placed = written(ordered.drop("__h").mapInArrow(_place, _PLACED.replace("{id}", kind)), "shards")

    # one row per partition: bounded by the number of shuffle partitions
    parts = placed.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("n")).orderBy("part").collect()
    total = sum(r["b"] for r in parts)
    bases, b, n = [], 0, 0
    for r in parts:
        bases.append((r["part"], b, n))
        b, n = b + r["b"], n + r["n"]
    base = F.broadcast(spark.createDataFrame(bases, "part int, base_bytes long, base_rows long"))
    middle = F.col("base_bytes") + F.col("before") + F.expr("size div 2")
    share = F.expr(f"least(cast(__middle as decimal(38,0)) * {shards} div {max(total, 1)}, {shards - 1})")
    rows = (placed.join(base, "part").withColumn("__middle", middle)
            .select("doc_id", "size", "text_crc32", share.cast("int").alias("shard"),
                    (F.col("base_rows") + F.col("pos")).alias("__at")))
    # one row per shard
    first = F.broadcast(rows.groupBy("shard").agg(F.min("__at").alias("__first")))
    return rows.join(first, "shard").select("doc_id", "size", "text_crc32", "shard",
                                            (F.col("__at") - F.col("__first")).alias("slot"))
