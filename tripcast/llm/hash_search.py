"""Nearest neighbours by multi-index hashing over learned binary codes.

Codes: several rotations are learned on a bounded sample (at most ``SAMPLE_ROWS`` rows,
those with the least row hashes), each from another random start, by turning the
principal axes until the signs lose least; the signs under all of them make a code of
``BITS`` bits.  The Hamming radius is learned on the same sample: the ``COVERED``
quantile of the code distances between sample rows and their true nearest ones there.
In the whole table neighbours lie nearer than in a sample, so the share covered grows.

Index: every row is dealt to a block of bounded bytes.  A block cuts its codes into
``SUBS`` substrings and keeps, for each, the rows sorted by the substring's value.  A
code within radius r = SUBS * p + a of the query's differs by at most p in one of the
first a + 1 substrings or by at most p - 1 in one of the others, so probing those values
retrieves every code within the radius; the codes found are compared in full, and the
vectors within the radius are ranked by their exact distance in double precision.

Queries travel in blocks to every index block; a block answers with at most k rows per
query.  A query with fewer than k rows in all is asked again with twice the radius, and
at last with all bits, which retrieves every row.

Defined cases: ids are long; vectors that are null, empty, all zero or hold null or
non-finite components take no part, nor do vectors of another length than the most
frequent one (of several, the longest); a row is never its own neighbour, other rows
with its id or its vector are; equal distances go by id (null last); a null id is no
query; with fewer candidates than k all are returned; an empty table gives an empty
table; other columns of the input are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import small_batches, written

BITS, SUBS = 256, 16
SAMPLE_ROWS, COVERED = 4096, 0.98
BLOCK_BYTES, QUERY_ROWS = 8 * 1024 * 1024, 2048
_WIDTH = BITS // SUBS
_POP = np.bitwise_count(np.arange(1 << _WIDTH, dtype=np.uint32)).astype(np.uint8)
#: all substrings by their number of set bits, and how many have at most so many
_MASKS = np.argsort(_POP, kind="stable").astype(np.uint16)
_BALL = np.cumsum(np.bincount(_POP, minlength=_WIDTH + 1))
_ROWS = "block int, kind int, keys array<long>, ids array<long>, vecs binary, codes binary"


# ---------------------------------------------------------------------------
# learned codes
# ---------------------------------------------------------------------------
def learn(sample: np.ndarray, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, int]:
    """(mean, projections to BITS signs, radius) from the sample's rows."""
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    axes = axes[:BITS].T
    flat, columns = centred @ axes, []
    while sum(c.shape[1] for c in columns) < BITS:
        turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))
        for _ in range(15):
            u, _, v = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (u @ v).T
        columns.append(axes @ turn)
    planes = np.concatenate(columns, axis=1)[:, :BITS]
    words = codes_of(sample, mean, planes).view(np.uint64)
    far = []
    asked = rng.permutation(len(sample))[:256]
    for q in asked:
        d = np.square(sample - sample[q]).sum(axis=1)
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(sample) - 1)]
        far.append(np.bitwise_count(words[near] ^ words[q]).sum(axis=1))
    far = np.concatenate(far) if far else np.zeros(0)
    return mean, planes, int(np.quantile(far, COVERED, method="higher")) if len(far) else BITS


def codes_of(vectors: np.ndarray, mean: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Substrings (uint16) of each vector's code."""
    bits = (vectors.astype(np.float64) - mean) @ planes >= 0
    return np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.uint16)


# ---------------------------------------------------------------------------
# a block's index
# ---------------------------------------------------------------------------
class Block:
    """Rows of one block with a table of substring values for each substring."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.keys, self.ids, self.vectors = keys, ids, vectors
        self.words = codes.view(np.uint64)
        self.tables = []
        for j in range(SUBS):
            order = np.argsort(codes[:, j], kind="stable")
            values, first = np.unique(codes[order, j], return_index=True)
            self.tables.append((values, np.append(first, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code lies within the radius."""
        found = np.zeros(len(self.keys), bool)
        p, a = divmod(min(radius, BITS), SUBS)
        for j, (values, bounds, order) in enumerate(self.tables):
            near = p if j <= a else p - 1
            if near < 0:
                break
            if _BALL[min(near, _WIDTH)] < len(values):
                probes = _MASKS[:_BALL[near]] ^ code[j]
                at = np.searchsorted(values, probes)
                at = at[values[np.minimum(at, len(values) - 1)] == probes]
            else:  # fewer values are held than there are probes
                at = np.flatnonzero(_POP[values ^ code[j]] <= near)
            size = bounds[at + 1] - bounds[at]
            spot = np.arange(size.sum()) + np.repeat(bounds[at] - (np.cumsum(size) - size), size)
            found[order[spot]] = True
        rows = np.flatnonzero(found)
        apart = np.bitwise_count(self.words[rows] ^ code.view(np.uint64)).sum(axis=1)
        return rows[apart <= radius]

    def nearest(self, key: int, vector: np.ndarray, code: np.ndarray, radius: int, k: int):
        rows = self.within(code, radius)
        rows = rows[self.keys[rows] != key]
        d = np.sqrt(np.square(self.vectors[rows].astype(np.float64) - vector.astype(np.float64)).sum(axis=1))
        if len(rows) > k:
            least = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
            rows, d = rows[least], d[least]
        order = np.lexsort((self.keys[rows], self.ids[rows], d))[:k]
        return rows[order], d[order]


_NO_ID = np.iinfo(np.int64).max  # a null id: sorts last


def _longs(column) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _ids(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == _NO_ID)


def _unpacked(row: dict, dtype: str):
    """(keys, ids, vectors, codes) of a packed row."""
    keys = row["keys"].values.to_numpy(zero_copy_only=False)
    ids = _longs(row["ids"].values)
    vecs = np.frombuffer(row["vecs"].as_buffer(), dtype)
    return keys, ids, vecs.reshape(len(keys), -1), np.frombuffer(row["codes"].as_buffer(), np.uint16).reshape(-1, SUBS)


def _packed(block: int, kind: int, keys, ids, vecs, codes) -> pa.RecordBatch:
    one = pa.array([0, len(keys)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), pa.array([kind], pa.int32()),
         pa.ListArray.from_arrays(one, pa.array(keys, pa.int64())), pa.ListArray.from_arrays(one, _ids(ids)),
         pa.array([np.ascontiguousarray(vecs).tobytes()], pa.binary()),
         pa.array([np.ascontiguousarray(codes).tobytes()], pa.binary())],
        names=["block", "kind", "keys", "ids", "vecs", "codes"])


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------
def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): rows whose vector can be compared."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].alias("v"))
    top = F.lit(math.inf)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < top)
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", fine)
                      & F.exists("v", lambda x: x != 0))


def _index(rows: DataFrame, model, dtype: str, block_rows: int, blocks: int) -> DataFrame:
    mean, planes, _ = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, count, done = TaskContext.get().partitionId(), [], 0, 0

        def emit():
            ids, vecs = (np.concatenate(x) for x in zip(*held))
            return _packed(block, 0, (block << 32) + np.arange(done, done + len(ids)), ids, vecs,
                           codes_of(vecs, mean, planes))

        for batch in batches:
            if not batch.num_rows:
                continue
            vecs = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(dtype)
            held.append((_longs(batch.column(0)), vecs.reshape(batch.num_rows, -1)))
            count += batch.num_rows
            if count >= 2 * block_rows:
                yield emit()
                held, done, count = [], done + count, 0
        if held:
            yield emit()

    return written(rows.repartition(blocks).mapInArrow(run, _ROWS), "hash-index")


def _query_blocks(index: DataFrame, every: int, dtype: str, n_queries: int, only: DataFrame | None) -> DataFrame:
    """The index rows whose id is divisible by ``every``, packed again."""
    if only is not None:
        index = index.join(only.groupBy((F.col("key") / F.lit(1 << 32)).cast("int").alias("block"))
                           .agg(F.collect_set("key").alias("asked")), "block")

    def pick(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                keys, ids, vecs, codes = _unpacked(row, dtype)
                take = (ids % every == 0) & (ids != _NO_ID)
                if "asked" in row:
                    take &= np.isin(keys, row["asked"].values.to_numpy(zero_copy_only=False))
                for at in np.array_split(np.flatnonzero(take), -(-int(take.sum()) // 256) or 1):
                    if len(at):
                        yield _packed(-1, 1, keys[at], ids[at], vecs[at], codes[at])

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                held.append(_unpacked({c: batch.column(c)[i] for c in batch.schema.names}, dtype))
                n += len(held[-1][0])
                if n >= QUERY_ROWS:
                    yield _packed(-1, 1, *(np.concatenate(x) for x in zip(*held)))
                    held, n = [], 0
        if held:
            yield _packed(-1, 1, *(np.concatenate(x) for x in zip(*held)))

    picked = index.mapInArrow(pick, _ROWS)
    return picked.repartition(-(-n_queries // QUERY_ROWS)).mapInArrow(pack, _ROWS)


_FOUND = "key long, query_id long, near_key long, vec_id long, score double"


def _ask(index: DataFrame, asked: DataFrame, blocks: int, dtype: str, radius: int, k: int) -> DataFrame:
    """At most k nearest rows within the radius for each query and block."""
    every_block = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = (index.unionByName(every_block).repartition(blocks, "block").sortWithinPartitions("block", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if row["block"].as_py() != here:
                    here, held = row["block"].as_py(), []
                keys, ids, vecs, codes = _unpacked(row, dtype)
                if row["kind"].as_py() == 0:
                    held.append(Block(keys, ids, vecs, codes))
                    continue
                out = []
                for q in range(len(keys)):
                    for block in held:
                        rows, d = block.nearest(keys[q], vecs[q], codes[q], radius, k)
                        out.append((np.full(len(rows), keys[q]), np.full(len(rows), ids[q]), block.keys[rows],
                                    block.ids[rows], d))
                if out:
                    key, query, near, found, d = (np.concatenate(x) for x in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(query), pa.array(near), _ids(found), pa.array(d)],
                        names=["key", "query_id", "near_key", "vec_id", "score"])

    order = Window.partitionBy("key").orderBy("score", F.col("vec_id").asc_nulls_last(), "near_key")
    return (dealt.mapInArrow(run, _FOUND).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10, every: int = 100,
            sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score for every row whose id is divisible by ``every``."""
    spark = vectors.sparkSession
    small_batches(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors, id_col, vec_col)
    kind = vectors.schema[vec_col].dataType.elementType
    dtype = "<f4" if isinstance(kind, T.FloatType) else "<f8"
    if dtype == "<f8":
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    query = F.col("id").isNotNull() & (F.col("id") % every == 0)
    lengths = (rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if(query).alias("q"))
               .orderBy(F.desc("n"), F.desc("d")).first())
    if lengths is None or not lengths["q"]:
        return empty
    dim, n, n_queries = lengths["d"], lengths["n"], lengths["q"]
    rows = rows.where(F.size("v") == dim)
    sample = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(sample_rows).collect()  # bounded
    model = learn(np.array([r["v"] for r in sample], np.float64), k)
    at_most = max(256, BLOCK_BYTES // (dim * int(dtype[-1])))
    block_rows = min(at_most, max(1024, -(-n // (3 * spark.sparkContext.defaultParallelism))))
    blocks = -(-n // block_rows)
    index = _index(rows, model, dtype, block_rows, blocks)

    radius, only, parts = model[2], None, []
    while True:
        asked = _query_blocks(index, every, dtype, n_queries, only)
        got = written(_ask(index, asked, blocks, dtype, radius, k), "hash-found")
        short = got.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") >= min(k, n - 1)).select("key")
        parts.append(got.join(short, "key", "left_semi") if radius < BITS else got)
        if radius >= BITS:
            break
        every_key = index.select(F.explode(F.arrays_zip("keys", "ids")).alias("r")).where(
            F.col("r.ids").isNotNull() & (F.col("r.ids") % every == 0)).select(F.col("r.keys").alias("key"))
        wanted = every_key if only is None else only
        only = written(wanted.join(short, "key", "left_anti"), "hash-short")
        n_queries = only.count()
        if not n_queries:
            break
        radius = min(2 * max(radius, SUBS), BITS)
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def recall(found: DataFrame, exact: DataFrame) -> Column:
    """Share of the exact neighbours that were found."""
    hit = found.select("query_id", "vec_id").distinct().withColumn("hit", F.lit(1))
    return exact.join(hit, ["query_id", "vec_id"], "left").select(F.avg(F.coalesce("hit", F.lit(0)))).scalar()
