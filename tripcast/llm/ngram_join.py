"""N-gram Jaccard join by count vectors and an R-tree.

Texts are sets of distinct k-word shingles (words split at ASCII white space, A-Z
lower-cased; fewer than k words make one shingle).  Two texts link when
``den * intersection >= num * union``; documents linked directly or through others
share a component.

1. *Copies.*  Texts with the same set are one node, named by a 64-bit hash of the set.
2. *Points.*  Shingles are hashed into ``DIMENSIONS`` groups; a node's point holds its
   count in each (up to 255, and what exceeds that together in one more coordinate).
   The overlap of two sets is at most the sum of the coordinate minima.
3. *Dealing.*  Points that may link differ in at most D shingles, D following from the
   threshold and the size class.  The hash range is cut into m > D slices: two linked
   sets hold the same shingles in at least m - D of them, so nodes meet in the tasks of
   the slices they have, each named by its exact content.  m leaves room for slices
   that are empty; a node with more empty slices than that is dealt by those as well.
   This loses no link, sends no text, and a passage that many texts share makes no hot
   group unless it is all that they have in a slice.
4. *Stars.*  In each group all nodes are held against one; pairs that the bound admits
   are verified on their texts, and the components found.
   Then, in groups with nodes of several components, a few more pivots are tried by
   their points, so that large families of copies grow together early.
5. *R-tree.*  Groups with nodes of several components are searched by R-tree (leaves of
   near points, bounded by the minima against the leaf's largest coordinates) for the
   pairs that remain between components, in blocks if a group is large, and verified.
   Nodes carry the slices that they had just before in order: a pair that also shares
   one of those was searched there already and is not given again.

After 5 every pair that links lies in one component: pairs left out are in the same
component already, or refuted by bound or by text.

Defined cases: a text without words (null, empty) has size 0 and is its own component;
a null id is kept, and a component's id is null only if all its ids are; repeated rows
are nodes' copies; an empty table gives an empty table; other columns are not read.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import chunks, distinct_per_text, mix64, shingle_hashes, text_of, word_hashes, written

DIMENSIONS = 256
BLOCK = 2048  # nodes of a group that one R-tree holds
LEAF = 16
PIVOTS = 3  # nodes of a group that the second round of stars tries
SMALL = 24  # groups of so many nodes are compared without a tree
MEMORY = 16  # earlier slices of a node by which repeated pairs are told
_GROWTH = 0.7  # size classes begin at l, l / 0.7, ...
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------------------
# thresholds and size classes
# ---------------------------------------------------------------------------
def least_overlap(total, num: int, den: int):
    """Smallest intersection with which sets of ``total`` elements together link."""
    return -(-num * total // (num + den))


@dataclass(frozen=True)
class Classes:
    """Per size class of the smaller set: first size, difference D, slices m, empty slices allowed."""
    first: np.ndarray
    differ: np.ndarray
    slices: np.ndarray
    empty: np.ndarray


def size_classes(num: int, den: int, largest: int = 1 << 31) -> Classes:
    first, differ, slices, empty = [1], [], [], []
    while first[-1] < largest:
        first.append(max(first[-1] + 1, int(first[-1] / _GROWTH)))
    for low, after in zip(first, first[1:]):
        top = (after - 1) + (after - 1) * den // num  # largest size of both sets together
        d = max(0, max(s - 2 * least_overlap(s, num, den) for s in range(max(2, top - 60), top + 1)))
        e = 2
        for _ in range(20):  # room for the empty slices that e itself makes likelier
            expected = (d + 1 + e) * np.exp(-low / (d + 1 + e))
            e = max(e, min(d + 2, int(np.ceil(expected + 3 * expected ** 0.5))))
        m = d + 1 + e
        differ.append(d)
        slices.append(m)
        empty.append(e)
    return Classes(np.array(first[:-1]), np.array(differ), np.array(slices), np.array(empty))


# ---------------------------------------------------------------------------
# sets, points and slice signatures of whole batches
# ---------------------------------------------------------------------------
def _sets(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    return distinct_per_text(*shingle_hashes(*word_hashes(raw), k), len(raw))


def _per_set(values: np.ndarray, bounds: np.ndarray, how) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.uint64)
    full = np.diff(bounds) > 0
    if full.any():
        out[full] = how.reduceat(values, bounds[:-1][full])
    return out


def set_keys(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    total = _per_set(mix64(h + _C1), bounds, np.add)
    odd = _per_set(mix64(h * _C2), bounds, np.bitwise_xor)
    return mix64(total ^ mix64(odd + np.diff(bounds).astype(np.uint64))).view(np.int64)


def points(h: np.ndarray, bounds: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """Counts of each set's shingles by group, 255 at most; what is cut off is the size less their sum."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    group = (mix64(h ^ _C2) % np.uint64(dimensions)).astype(np.int64)
    count = np.bincount(owner * dimensions + group, minlength=n * dimensions).reshape(n, dimensions)
    return np.minimum(count, 255).astype(np.uint8)


def excess(size: np.ndarray, vec: np.ndarray) -> np.ndarray:
    return size - vec.sum(axis=1, dtype=np.int64)


def signatures(h: np.ndarray, bounds: np.ndarray, classes: Classes, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set index): the slices of each set, named by class, place and content."""
    size = np.diff(bounds)
    high = np.searchsorted(classes.first, size, side="right") - 1
    low = np.searchsorted(classes.first, -(-num * size // den), side="right") - 1
    content = mix64(h + _C2)
    upper = h >> np.uint64(32)
    owner = np.repeat(np.arange(len(size)), size)
    out, sets = [], []
    for back in range(int((high - low).max()) + 1 if len(size) else 0):
        own = high - back
        use = (size > 0) & (own >= low)
        use[use] = classes.differ[own[use]] > 0
        if not use.any():
            continue
        sel = use[owner]
        who, cls = owner[sel], own[owner[sel]]
        slice_ = (upper[sel] * classes.slices[cls].astype(np.uint64)) >> np.uint64(32)
        start = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (slice_[1:] != slice_[:-1])]))
        place = mix64(classes.first[cls[start]].astype(np.uint64) * _C1 + slice_[start])
        out.append(mix64(np.add.reduceat(content[sel], start) ^ place))
        sets.append(who[start])
        used = np.bincount(who[start], minlength=len(size))
        for i in np.flatnonzero(use & (classes.slices[own] - used > classes.empty[own])):
            m = int(classes.slices[own[i]])
            missing = np.setdiff1d(np.arange(m, dtype=np.uint64), slice_[who == i])
            out.append(mix64(mix64(classes.first[own[i:i + 1]].astype(np.uint64) * _C1 + missing)))
            sets.append(np.full(len(missing), i))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out).view(np.int64), np.concatenate(sets)


# ---------------------------------------------------------------------------
# R-tree over points of one group
# ---------------------------------------------------------------------------
class RTree:
    """Leaves of near points with their largest coordinates and smallest size."""

    def __init__(self, size: np.ndarray, vec: np.ndarray, leaf: int = LEAF):
        spread = vec.var(axis=0)
        axes = np.argsort(-spread)[:2]
        order = np.lexsort((vec[:, axes[-1]], vec[:, axes[0]], size))
        self.order, self.size, self.vec, self.leaf = order, size[order], vec[order], leaf
        self.over = excess(self.size, self.vec)
        starts = np.arange(0, len(order), leaf)
        self.top = np.maximum.reduceat(self.vec, starts, axis=0)
        self.top_over = np.maximum.reduceat(self.over, starts)
        self.small = np.minimum.reduceat(self.size, starts)

    def search(self, size: int, vec: np.ndarray, num: int, den: int) -> np.ndarray:
        """Indices of points whose bound admits a link with the given one."""
        over = size - int(vec.sum(dtype=np.int64))
        most = np.minimum(self.top, vec).sum(axis=1, dtype=np.int64) + np.minimum(self.top_over, over)
        leaves = np.flatnonzero(most >= least_overlap(self.small + size, num, den))
        if not len(leaves):
            return np.zeros(0, np.int64)
        at = (leaves[:, None] * self.leaf + np.arange(self.leaf)).ravel()
        at = at[at < len(self.order)]
        bound = np.minimum(self.vec[at], vec).sum(axis=1, dtype=np.int64) + np.minimum(self.over[at], over)
        return self.order[at[bound >= least_overlap(self.size[at] + size, num, den)]]


# ---------------------------------------------------------------------------
# Spark steps
# ---------------------------------------------------------------------------
def _read_sets(rows: DataFrame, k: int, with_text: bool) -> DataFrame:
    """rows (id, t, h) -> (id, h, key, n, vec) or (key, n, t); h tells rows of one id apart."""
    kind = dict(rows.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                h, bounds = _sets(texts[a:b], k)
                n, key = pa.array(np.diff(bounds)), pa.array(set_keys(h, bounds))
                if with_text:
                    yield pa.RecordBatch.from_arrays([key, n, batch.column(1).slice(a, b - a)], names=["key", "n", "t"])
                else:
                    vec = pa.array([v.tobytes() for v in points(h, bounds)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), key, n, vec],
                        names=["id", "h", "key", "n", "vec"])

    return rows.mapInArrow(run, "key long, n long, t string" if with_text else
                           f"id {kind}, h long, key long, n long, vec binary")


def _deal(nodes: DataFrame, k: int, classes: Classes, num: int, den: int) -> DataFrame:
    """(sig, key) of every slice of every node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                sig, who = signatures(*_sets(texts[a:b], k), classes, num, den)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(keys[a:b][who])], names=["sig", "key"])

    return nodes.select("key", "t").mapInArrow(run, "sig long, key long")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (sig, key) in order: (sig, pivot, key) for each further key of a signature."""
    last_sig, last_key, pivot = None, None, None
    for batch in batches:
        sig, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(sig):
            continue
        new = np.concatenate([[last_sig is None or sig[0] != last_sig], sig[1:] != sig[:-1]])
        other = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(sig)), -1))
        lead = np.where(first >= 0, key[np.maximum(first, 0)], 0 if pivot is None else pivot)
        hit = ~new & other & (key != lead)
        last_sig, last_key, pivot = sig[-1], key[-1], lead[-1]
        yield pa.RecordBatch.from_arrays([pa.array(sig[hit]), pa.array(lead[hit]), pa.array(key[hit])],
                                         names=["sig", "pivot", "key"])


def _bounded(pairs: DataFrame, pts: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose coordinate minima admit a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            va, vb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                      for c in ("va", "vb"))
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            bound = np.minimum(va, vb).sum(axis=1, dtype=np.int64) + np.minimum(excess(na, va), excess(nb, vb))
            ok = bound >= least_overlap(na + nb, num, den)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))],
                                             names=["a", "b"])

    left = pts.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("vec").alias("va"))
    right = pts.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("vec").alias("vb"))
    near = pairs.join(right, "b").join(left, "a").where(
        (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num))
    return near.select("a", "b", "na", "nb", "va", "vb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, by_key: DataFrame, nodes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) that link by their texts.  ``by_key``: the nodes' texts bucketed by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_set = None, None
        for batch in batches:
            keys_a, keys_b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts_a, texts_b = batch.column(2), batch.column(3).to_pylist()
            ok = np.zeros(len(keys_a), bool)
            for lo, hi in chunks(texts_b):
                h, bounds = _sets(texts_b[lo:hi], k)
                for i in range(lo, hi):
                    if keys_a[i] != held:
                        held, held_set = keys_a[i], _sets([texts_a[i].as_py()], k)[0]
                    own = h[bounds[i - lo]:bounds[i - lo + 1]]
                    both = len(np.intersect1d(own, held_set, assume_unique=True))
                    ok[i] = den * both >= num * (len(own) + len(held_set) - both) and both > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys_a[ok]), pa.array(keys_b[ok])], names=["a", "b"])

    member = by_key.select(F.col("key").alias("b"), F.col("t").alias("tb"))
    pivot = nodes.select(F.col("key").alias("a"), F.col("t").alias("ta"))
    pivot = pivot.join(pairs.select("a").distinct(), "a", "left_semi")
    rows = pairs.join(member, "b").join(pivot, "a")
    return rows.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(key, label) of every node of a link (a, b): the least key that links reach.

    Each round takes the least label among a node's neighbours and follows it on.
    """
    edges = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    edges = written(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = edges.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("key"), F.least("u", "m").alias("label"))
    while True:
        labels = written(labels, "labels")
        least = edges.join(labels.withColumnRenamed("key", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        moved = labels.join(least, labels["key"] == least["u"]).select(
            "key", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        on = labels.select(F.col("key").alias("label"), F.col("label").alias("next"))
        moved = written(moved.join(on, "label", "left").select(
            "key", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "moved")
        if not moved.where("label <> old").limit(1).count():
            return labels
        labels = moved.select("key", "label")


def admitted(size: np.ndarray, vec: np.ndarray, who: np.ndarray, among: np.ndarray, num: int, den: int):
    """(i, places) for each i of ``who``: the places of ``among`` whose bound admits a link with i."""
    if len(among) <= SMALL:
        over = excess(size, vec)
        both = np.minimum(vec[who][:, None], vec[among][None]).sum(axis=2, dtype=np.int64)
        both += np.minimum(over[who][:, None], over[among][None])
        ok = both >= least_overlap(size[who][:, None] + size[among][None], num, den)
        for i, row in zip(who, ok):
            if row.any():
                yield i, among[row]
        return
    tree = RTree(size[among], vec[among])
    for i in who:
        yield i, among[tree.search(int(size[i]), vec[i], num, den)]


def _cells(batches: Iterator[pa.RecordBatch]):
    """The rows of each (sig, x, y) in turn, as columns."""
    at, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != at:
                if len(held) > 1:
                    yield at[0], list(zip(*held))
                at, held = row[:3], []
            held.append(row[3:])
    if len(held) > 1:
        yield at[0], list(zip(*held))


def _between(stars: DataFrame, labels: DataFrame, pts: DataFrame, num: int, den: int, pivots: int = 0) -> DataFrame:
    """Pairs between components that share a slice and that the bound admits.

    With ``pivots`` only so many nodes of each group are held against the others.
    """
    members = stars.select("sig", "key").unionByName(stars.select("sig", F.col("pivot").alias("key")).distinct())
    label = F.coalesce("label", "key").alias("label")
    members = members.join(labels, "key", "left").select("sig", "key", label)
    mixed = (members.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size"))
             .where("lo <> hi").select("sig", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    rows = members.join(mixed, "sig")
    w = Window.partitionBy("key").orderBy("sig").rowsBetween(-MEMORY, -1)
    rows = rows.withColumn("before", F.collect_list("sig").over(w) if not pivots else F.array().cast("array<long>"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    # a large group is cut into blocks; each pair of blocks is a cell of its own
    cell = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("sig", "key", "label", "block", "before", cell.alias("other")).select(
        "sig", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "key", "label",
        "before")
    rows = rows.join(pts.select("key", "n", "vec"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for sig, cols in _cells(batches):
            block, key, label, size = (np.array(c, np.int64) for c in cols[:4])
            vec = np.frombuffer(b"".join(cols[4]), np.uint8).reshape(len(key), -1)
            among, who = np.flatnonzero(block == block.max()), np.flatnonzero(block == block.min())
            if pivots:
                order = mix64(key[who].view(np.uint64) ^ np.int64(sig).view(np.uint64))
                who = who[np.argsort(order, kind="stable")[:pivots]]
            for i, got in admitted(size, vec, who, among, num, den):
                got = got[label[got] != label[i]]
                if not pivots:
                    got = got[(block[got] != block[i]) | (key[got] > key[i])]
                    if len(got) and cols[5][i]:
                        own = set(cols[5][i])
                        got = got[[own.isdisjoint(cols[5][j]) for j in got]]
                a.append(np.minimum(key[i], key[got]))
                b.append(np.maximum(key[i], key[got]))
            if len(a) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    cells = rows.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")
    return cells.select("sig", "x", "y", "block", "key", "label", "n", "vec", "before").mapInArrow(
        run, "a long, b long").distinct()


def _components_of_rows(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """id, h (hash of the text), n, and of rows with words label and component_id (the label's least id)."""
    spark = docs.sparkSession
    classes = size_classes(num, den)
    text = text_of(docs, text_col)
    rows = docs.select(docs[id_col].alias("id"), text.alias("t"), F.xxhash64(text).alias("h"))
    places = written(_read_sets(rows, words, False), "points")
    pts = places.where("n > 0").groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"),
                                                   F.first("vec").alias("vec"))
    # one text of each node, kept by key: later joins on the key do not move it again
    table = f"llm_nodes_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (_read_sets(rows, words, True).where("n > 0").dropDuplicates(["key"])
     .write.format("parquet").option("compression", "zstd").bucketBy(buckets, "key").saveAsTable(table))
    by_key = spark.table(table)
    nodes = spark.read.schema(by_key.schema).parquet(*by_key.inputFiles()) if by_key.inputFiles() else by_key

    dealt = _deal(nodes, words, classes, num, den).repartition("sig").sortWithinPartitions("sig", "key")
    stars = written(dealt.mapInArrow(_stars, "sig long, pivot long, key long"), "stars")
    pairs = stars.select(F.col("pivot").alias("a"), F.col("key").alias("b")).distinct()
    links = written(_verified(written(_bounded(pairs, pts, num, den), "pairs"), by_key, nodes, words, num, den), "links")
    # a second round of stars, then whatever is left between components
    tried, labels = pairs, components(links)
    for pivots in (PIVOTS, 0):
        rest = written(_between(stars, labels, pts, num, den, pivots).join(tried, ["a", "b"], "left_anti"), "rest")
        more = written(_verified(rest, by_key, nodes, words, num, den), "links")
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = components(links)
        tried = tried.unionByName(rest)
    spark.sql(f"DROP TABLE IF EXISTS {table}")

    # least id by node, then by component; groups of copies meet as one row each
    least = pts.select("key", "id").join(labels, "key", "left").select(
        "key", "id", F.coalesce("label", "key").alias("label"))
    heads = least.groupBy("label").agg(F.min("id").alias("component_id"))
    of_key = least.join(heads, "label").select("key", "label", "component_id")
    return (places.select("id", "h", "n", F.when(F.col("n") > 0, F.col("key")).alias("key"))
            .join(of_key, "key", "left").drop("key"))


def join_components(docs: DataFrame, words: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id of each row."""
    out = _components_of_rows(docs, words, num, den, id_col, text_col)
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def keep_one_each(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The row of the least id of each component, with all its columns; of rows with that id in
    the component one, and of repeated rows one.  Rows without words stay."""
    found = _components_of_rows(docs, words, num, den, id_col, text_col)
    least = (found.where("n > 0").groupBy("label").agg(F.min(F.struct("id", "h")).alias("least"))
             .select("least.id", "least.h"))
    kept = least.unionByName(found.where("n = 0").select("id", "h")).distinct().select(
        F.col("id").alias("__id"), F.col("h").alias("__h"))
    same = docs[id_col].eqNullSafe(F.col("__id")) & (F.xxhash64(text_of(docs, text_col)) == F.col("__h"))
    return docs.join(kept, same, "left_semi").dropDuplicates([id_col, text_col]).select(*docs.columns)
