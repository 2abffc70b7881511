"""Ranked lexical search by an exact sparse ball tree over the documents.

Documents become sparse vectors over the items' terms: x_t = (10^9 * tf) div
(1000 * tf + 20 * m), with the document's length factor m; an item is the vector of its
terms' weights, and a document's score is the inner product, in 64-bit integers.

A pass over the whole texts keeps each document's length and its counts of item terms; from
these come N, L and the document frequencies.  Each task then deals its documents into
trees of bounded size: a node is split at the median of its documents' places between two
far pivots; a node's ball has the mean of its vectors as centre and reaches its farthest
vector.  Distances are taken after scaling every term by the root of its weight, which
leaves inner products as they are.  No document below a node scores more for an item than
centre * item + radius * |item|; all roundings of that bound are directed upwards.  Per item
nodes are visited best first, documents at leaves get their exact integer score, and the
search ends when the best bound left lies below the 50th score found.  What a task has found
bounds its next trees, and a first search among ``SEED`` of the documents, dealt by hash,
gives every task a score that 50 documents reach: it only prunes, all documents are searched.

Items come in blocks whose texts have bounded bytes, so that terms and weights fit into
every task whatever the number of items; each block passes over the documents once.

Defined cases: a null text has no terms; a document without terms counts neither in N nor
in L; rows with one doc_id are documents of their own; a null doc_id sorts last; rows with
one item_id (or a null one) make one item with the terms of all; an item without terms, or
whose terms occur nowhere, has no rows; no documents or no items give an empty table; ids
are long; other columns of the inputs are not read.
"""
from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import ALNUM_WORDS, small_batches, written

TOP, SEED = 50, 16
ITEM_BYTES = 2 * 1024 * 1024
TREE_ROWS, TREE_ENTRIES, LEAF = 16_384, 2_000_000, 64
#: share by which float bounds are raised; sums of n doubles err by less than n * 2^-53
SLACK = 1e-9
_NO_ID = np.iinfo(np.int64).max  # a null id: sorts last
#: every byte of a term to itself, A-Z to a-z, all others to a space
_TERMS = bytes(32 if not c else c - 1 for c in ALNUM_WORDS.tolist())


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Items:
    """A block of items as rows of term numbers."""

    def __init__(self, rows):
        own: dict = {}
        for item_id, text in rows:
            own.setdefault(item_id, set()).update(terms_of(text))
        self.ids = sorted((i for i in own if own[i]), key=lambda i: (i is None, i))
        self.number = {t: k for k, t in enumerate(sorted(set().union(*(own[i] for i in self.ids)) if self.ids else ()))}
        self.terms = [np.array(sorted(self.number[t] for t in own[i]), np.int64) for i in self.ids]
        self.owner = np.repeat(np.arange(len(self.ids)), [len(t) for t in self.terms])
        self.flat = np.concatenate(self.terms) if self.terms else np.zeros(0, np.int64)

    def dots(self, dense: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, dense[self.flat], len(self.ids))


# ---------------------------------------------------------------------------
# one pass over the texts
# ---------------------------------------------------------------------------
def counted(docs: DataFrame, number: dict, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, and the counts of item terms of every document with terms."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, cols, tfs = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                found = Counter(filter(number.__contains__, terms))
                ids.append(doc)
                lengths.append(len(terms))
                cols.append([number[t] for t in found])
                tfs.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(cols, pa.list_(pa.int32())),
                 pa.array(tfs, pa.list_(pa.int64()))], names=["doc_id", "n", "cols", "tfs"])

    return rows.mapInArrow(run, "doc_id long, n long, cols array<int>, tfs array<long>")


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """Documents per term: counted in tasks, summed in Spark, one number per item term."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in rows.select("cols").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[r[0]] = r[1]
    return out


# ---------------------------------------------------------------------------
# the tree
# ---------------------------------------------------------------------------
class Tree:
    """Ball tree over sparse rows (``cols`` and ``x`` by ``bounds``), for one block of items."""

    def __init__(self, ids, bounds, cols, x, items: Items, weights: np.ndarray):
        self.ids, self.bounds, self.cols, self.x = ids, bounds, cols, x
        self.items, self.weights = items, weights
        self.root = np.sqrt(weights.astype(np.float64))
        self.n = len(ids)
        self.owner = np.repeat(np.arange(self.n), np.diff(bounds))
        self.scaled = x * self.root[cols]
        self.square = np.bincount(self.owner, self.scaled ** 2, self.n)
        self.length = np.sqrt(np.bincount(items.owner, weights[items.flat].astype(np.float64), len(items.ids)))
        self.kids, self.leaf, self.bound = [], [], []
        self._node(np.arange(self.n))
        self.bound = np.array(self.bound)

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows' entries, and for each the number of its row."""
        size = self.bounds[rows + 1] - self.bounds[rows]
        spot = np.arange(size.sum()) + np.repeat(self.bounds[rows] - (np.cumsum(size) - size), size)
        return spot, np.repeat(np.arange(len(rows)), size)

    def _node(self, rows: np.ndarray) -> int:
        here = len(self.kids)
        spot, row = self._entries(rows)
        cols, scaled = self.cols[spot], self.scaled[spot]
        dot = lambda dense: np.bincount(row, scaled * dense[cols], len(rows))
        centre = np.bincount(cols, scaled, len(self.weights)) / len(rows)
        own = float(centre @ centre)
        square = self.square[rows]
        apart = square - 2 * dot(centre) + own
        # what cancels in the difference errs by its terms' size
        radius = math.sqrt(max(0.0, float((apart + SLACK * (square + own)).max())))
        reach = self.items.dots(centre * self.root) * (1 + SLACK) + self.length * radius * (1 + SLACK)
        self.bound.append(np.ceil(reach * (1 + SLACK)))
        self.kids.append(None)
        self.leaf.append(rows)
        if len(rows) > LEAF:
            pivot = self._dense(rows[int(np.argmax(apart))])
            to_pivot = square - 2 * dot(pivot) + float(pivot @ pivot)
            other = self._dense(rows[int(np.argmax(to_pivot))])
            order = np.argsort(dot(other - pivot), kind="stable")
            half = len(rows) // 2
            self.leaf[here] = None
            self.kids[here] = (self._node(rows[order[:half]]), self._node(rows[order[half:]]))
        return here

    def _dense(self, row: int) -> np.ndarray:
        out = np.zeros(len(self.weights))
        own = slice(self.bounds[row], self.bounds[row + 1])
        out[self.cols[own]] = self.scaled[own]
        return out

    def search(self, item: int, found: "Best") -> int:
        """Give every document that can be among the item's best; returns the documents scored."""
        dense = np.zeros(len(self.weights), np.int64)
        dense[self.items.terms[item]] = self.weights[self.items.terms[item]]
        heap, scored = [(-self.bound[0, item], 0)], 0
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < found.least:
                break
            if self.kids[node]:
                for kid in self.kids[node]:
                    if self.bound[kid, item] >= found.least:
                        heapq.heappush(heap, (-self.bound[kid, item], kid))
                continue
            rows = self.leaf[node]
            spot, row = self._entries(rows)
            total = np.zeros(len(rows), np.int64)
            np.add.at(total, row, dense[self.cols[spot]] * self.x[spot])
            scored += len(rows)
            take = total >= found.least
            found.add(total[take], self.ids[rows[take]])
        return scored


class Best:
    """An item's best documents so far; ``least`` is the score that one more must reach."""

    def __init__(self, k: int, least: int = 1):
        self.k, self.least = k, max(1, least)
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        self.scores, self.ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if len(self.scores) >= self.k:
            order = np.lexsort((self.ids, -self.scores))[:self.k]
            self.scores, self.ids = self.scores[order], self.ids[order]
            self.least = max(self.least, int(self.scores[-1]))


def _search(rows: DataFrame, items: Items, n: int, length: int, weights: np.ndarray, least: np.ndarray,
            k: int) -> DataFrame:
    """item (its number), doc_id, score: the best of each task."""
    def tree(held) -> Tree | None:
        ids, lengths, sizes, cols, tfs = (np.concatenate(c) for c in zip(*held))
        own = sizes > 0
        ids, lengths, sizes = ids[own], lengths[own], sizes[own]
        if not len(ids):
            return None
        factor = np.array([50 + 50 * int(c) * n // length for c in lengths], np.int64)
        x = (1_000_000_000 * tfs) // (1000 * tfs + 20 * np.repeat(factor, sizes))
        return Tree(ids, np.concatenate([[0], np.cumsum(sizes)]), cols, x, items, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, int(least[i])) for i in range(len(items.ids))]

        def look(held):
            t = tree(held)
            for i in range(len(items.ids) if t else 0):
                t.search(i, best[i])

        held, docs, entries = [], 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                cols, tfs = batch.column(2), batch.column(3)
                sizes = np.diff(cols.offsets.to_numpy())
                held.append((batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False),
                             batch.column(1).to_numpy(), sizes, cols.flatten().to_numpy().astype(np.int64),
                             tfs.flatten().to_numpy()))
                docs, entries = docs + batch.num_rows, entries + len(held[-1][3])
                if docs >= TREE_ROWS or entries >= TREE_ENTRIES:
                    look(held)
                    held, docs, entries = [], 0, 0
        if held:
            look(held)
        for i, b in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b.ids), i, np.int32)), pa.array(b.ids, mask=b.ids == _NO_ID),
                 pa.array(b.scores)], names=["item", "doc_id", "score"])

    return rows.select("doc_id", "n", "cols", "tfs").mapInArrow(run, "item int, doc_id long, score long")


def rank(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = benchmark.select(benchmark[item_col].cast("long").alias("item_id"),
                             benchmark[item_text].cast("string").alias("t"))
    size = asked.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = -(-size // ITEM_BYTES)
    out, totals = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long"), None
    for b in range(blocks):
        items = Items(asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect())
        if not items.ids:
            continue
        rows = written(counted(docs, items.number, id_col, text_col), "terms")
        if totals is None:
            totals = rows.agg(F.count("*"), F.sum("n")).first()
        n, length = totals
        if not n:
            break
        df = document_frequencies(rows, len(items.number))
        weights = np.array([weight(n, int(d)) for d in df], np.int64)
        some = rows.where(F.size("cols") > 0)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())

        def top(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

        # a hash of the rows' own contents: copies of a text may all be in or out, which only moves the bound
        seed = some.where(F.pmod(F.xxhash64("doc_id", "n", "cols"), F.lit(SEED)) == 0)
        least = np.ones(len(items.ids), np.int64)
        for r in top(_search(seed, items, n, length, weights, least, k)).where(F.col("rank") == k).collect():
            least[r["item"]] = r["score"]
        best = top(_search(some, items, n, length, weights, least, k))
        names = spark.createDataFrame(list(enumerate(items.ids)), "item int, item_id long")
        out = out.unionByName(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out
