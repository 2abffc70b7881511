"""Vector codes by Lloyd rounds whose members stay where they are.

A vector's components become the integers floor(4096 * x); its eight consecutive parts are
coded by one codebook each.  Every part is a member of its codebook entry and lies in the
partition that its (position, entry, salt) names.  In a round the owners add up their
resident members, the sums of the entries (one row per entry, whatever the input's size)
give the new codebooks, and owners look for the nearest entry of each resident: members
whose entry stays the same are not moved, the others migrate in that round's shuffle, which
therefore shrinks as the rounds settle.  Salts are dealt per batch of rows, as many as keep an
owner bounded even if one entry holds all rows.  All arithmetic is in 64-bit integers, so
sums do not depend on their order.  Rounds end early once the codebooks stay the same.

The residents of a round are kept by Spark in memory and on disk; a lost executor's are made
again from the table by the same deterministic rounds.

Defined cases: rows with a null vector, with null or non-finite components or with another
length than the most frequent one (of several, the longest) are dropped; integers beyond
2^26 count as 2^26; a length that eight does not divide gives parts of nearly equal length;
equal distances go to the lower entry; entries without members stay; repeated rows count as
often as they come, and the first entries are the rows of the least ids (null last, then by
vector); fewer than 16 rows give fewer entries; null labels count as equal; an empty table
gives an empty table; other columns of the input are not read.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import small_batches, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 26
#: members of an owner at most, about
OWNER_ROWS = 65_536


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, x): x holds the scaled integers of a usable vector."""
    top = F.lit(math.inf)
    scaled = F.transform(F.col("v"), lambda c: F.greatest(F.lit(-LIMIT), F.least(
        F.lit(LIMIT), F.floor(F.lit(SCALE) * c))).cast("int"))
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"),
                          vectors[vec_col].cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < top))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & fine).select("id", "label", scaled.alias("x"))


def cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    d = x.shape[1]
    return [x[:, d * p // parts:d * (p + 1) // parts] for p in range(parts)]


def assign(members: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry (the lowest of equal ones) and squared distance of each member."""
    best = np.zeros(len(members), np.int64)
    least = np.full(len(members), np.iinfo(np.int64).max)
    wide = members.astype(np.int64)
    for e, entry in enumerate(entries):
        d = np.square(wide - entry).sum(axis=1)
        nearer = d < least
        best[nearer], least[nearer] = e, d[nearer]
    return best, least


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _births(rows: DataFrame, books: list[np.ndarray], salts: int) -> DataFrame:
    """Each batch's parts by their first entries: (position, entry, salt, members)."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            if not batch.num_rows:
                continue
            out, salt = [], (task * 7919 + number) % salts
            for p, members in enumerate(cut(_matrix(batch.column(0), batch.num_rows), parts)):
                best, _ = assign(members, books[p])
                out += [(p, int(e), salt, members[best == e].astype(np.int32).tobytes()) for e in np.unique(best)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                names=["p", "e", "salt", "members"])

    return rows.select("x").mapInArrow(run, "p int, e int, salt int, members binary")


def _merged(pairs):
    """One array per key of a partition."""
    held: dict = {}
    for key, members in pairs:
        held.setdefault(key, []).append(members)
    for key, own in held.items():
        yield key, np.concatenate(own) if len(own) > 1 else own[0]


def _sums(pairs):
    totals: dict = {}
    for (p, e, _), members in pairs:
        s, n = totals.get((p, e), (0, 0))
        totals[p, e] = s + members.sum(axis=0, dtype=np.int64), n + len(members)
    return iter(totals.items())


def _placed(books: list[np.ndarray]):
    """Members by the new codebooks, told apart by whether their entry stayed the same."""
    def run(pairs):
        for (p, e, salt), members in pairs:
            best, _ = assign(members, books[p])
            for to in np.unique(best):
                yield int(to) == e, ((p, int(to), salt), members[best == to])
    return run


def train(rows: DataFrame, books: list[np.ndarray], n: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks after the rounds; ``rows`` has the scaled vectors ``x``."""
    sc = rows.sparkSession.sparkContext
    parts, entries = len(books), len(books[0])
    salts = -(-n // OWNER_ROWS)
    owners = min(parts * entries * salts, max(2 * sc.defaultParallelism, -(-parts * n // (8 * OWNER_ROWS))))
    widths = [b.shape[1] for b in books]

    def owner(key) -> int:
        p, e, salt = key
        return (p * entries + e + salt * 31) % owners

    born = _births(rows, books, salts).rdd.map(
        lambda r: ((r[0], r[1], r[2]), np.frombuffer(r[3], np.int32).reshape(-1, widths[r[0]] or 1)))
    resident = born.partitionBy(owners, owner).mapPartitions(_merged, True).persist(StorageLevel.MEMORY_AND_DISK)
    for turn in range(rounds):
        totals = resident.mapPartitions(_sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), 8).collect()
        after = [b.copy() for b in books]
        for (p, e), (s, count) in totals:  # at most one row per entry
            after[p][e] = s[:widths[p]] // count
        same = all((a == b).all() for a, b in zip(after, books))
        books = after
        if same or turn == rounds - 1:
            break
        placed = resident.mapPartitions(_placed(books), True).persist(StorageLevel.MEMORY_AND_DISK)
        stay = placed.filter(lambda x: x[0]).mapPartitions(lambda it: (x[1] for x in it), True)
        go = placed.filter(lambda x: not x[0]).map(lambda x: x[1]).partitionBy(owners, owner)
        before, resident = (resident, placed), stay.union(go).mapPartitions(_merged, True).persist(
            StorageLevel.MEMORY_AND_DISK)
        resident.foreachPartition(lambda it: sum(1 for _ in it))
        for old in before:
            old.unpersist()
    resident.unpersist()
    return books


def digest(books: list[np.ndarray]) -> str:
    flat = ",".join(str(int(c)) for book in books for entry in book for c in entry)
    return hashlib.sha256(flat.encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """id, code, error, label_error, codebooks_sha256 of every usable vector."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = whole_vectors(vectors, id_col, vec_col, label_col)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("d")).first()
    kinds = dict(rows.dtypes)
    if lengths is None:
        return spark.createDataFrame([], f"{id_col} {kinds['id']}, code string, error long, label_error long, "
                                         "codebooks_sha256 string")
    rows = rows.where(F.size("x") == lengths["d"])
    first = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    books = [b.astype(np.int64) for b in cut(np.array([r["x"] for r in first], np.int64), parts)]
    books = train(rows, books, lengths["n"], rounds)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            found = [assign(m, books[p]) for p, m in enumerate(cut(_matrix(batch.column("x"), n), parts))]
            hexes = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([bytes(h).hex() for h in hexes]),
                 pa.array(sum(d for _, d in found))], names=["id", "label", "code", "error"])

    coded = written(rows.mapInArrow(code, f"id {kinds['id']}, label {kinds['label']}, code string, error long"),
                    "lloyd-codes")
    per_label = coded.groupBy(F.col("label").alias("label_")).agg(F.sum("error").alias("label_error"))
    return coded.join(per_label, coded["label"].eqNullSafe(per_label["label_"])).select(
        coded["id"].alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
