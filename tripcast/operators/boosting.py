"""Second-order boosted trees grown by Spark on a pre-binned table.

The training rows are binned once: a row holds one byte per feature, and the rows lie in
blocks that Spark keeps in memory and on disk.  A level of the trees is one job: every task
adds up its blocks' gradients and second derivatives by (model, node, feature, bin), Spark
merges these sums by (model, group of features), and the driver finds each node's best split.
Of two siblings only the lighter one is counted, the other's sums are their parent's less its
own: derivatives are rounded to multiples of a power of two so small (``_unit``) that all sums are
exact, whatever their order.  Features of few bins
are counted together: a bundle's code is the number that its features' codes write in mixed
radix, at most ``BUNDLE_CELLS`` of them, and each feature's sums are the bundle's sums added up
over the other features.  While trees grow, rows are kept as their bundles only (``Packed``), and a model's
margins only for the rows that it sees: what each level's job hands to its tasks is little more than
that.  All models grow in
the same jobs: variants with other losses and settings, and one model per rider type beside
the general one (``scopes``), which differ only in the rows that they see.

For sums G of gradients and H of second derivatives below a node, with T(G) = G shrunk by
alpha towards 0, a leaf's value is -T(G) / (H + lambda), and a split's gain is
(T(GL)^2 / (HL + lambda) + T(GR)^2 / (HR + lambda) - T(G)^2 / (H + lambda)) / 2 - gamma.  A
split needs a positive gain and at least ``min_child_weight`` of H on both sides; equal gains
go to the first feature and the lowest cut.

What reaches the driver is bounded by the models' nodes: the sums of one level.  While those of all
tasks are few (``COLLECT_BYTES``) they skip the shuffle and are merged at the driver, with the same result.
Margins are carried from round to round in the blocks; every ``CUT_ROUNDS`` rounds they are checkpointed, so a lost
executor's blocks are made again from the last checkpoint by the same deterministic steps.
Row samples are drawn per (block, round), feature samples per tree, from fixed seeds.
"""
from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpoint_dir, materialize, ship_package

MAX_BINS = 64
#: blocks as they are binned, and as they are dealt to the tasks that train on them
BLOCK_ROWS, LEAST_BLOCK_ROWS, DEALT_ROWS, PART_ROWS = 32_768, 2048, 131_072, 1 << 20
BLOCKS_PER_CORE = 8
BUNDLE_CELLS = 256
HELD_VALUES = 8_000_000
WALK_ROWS = 8192  # walked together, so that what they read stays in the cache
#: sums of a level that all tasks together may send to the driver instead of into a shuffle
COLLECT_BYTES = 32 << 20
GROUP_FEATURES = 16
#: copies of the sums that rows add to in turn (a power of two), and the cells they may take in all
LANES, LANE_CELLS = 4, 8192
CUT_ROUNDS = 20


@dataclass(frozen=True)
class BoostSpec:
    """One variant: its loss (``squared``, ``pseudo_huber`` or ``tweedie``) and settings."""
    name: str
    loss: str = "squared"
    rounds: int = 100
    depth: int = 6
    eta: float = 0.16
    subsample: float = 1.0
    colsample: float = 1.0
    min_child_weight: float = 1.0
    gamma: float = 0.0
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    power: float = 1.5  # of the tweedie variance

    @property
    def log_target(self) -> bool:
        """Squared and robust losses see log1p(demand); the tweedie loss has its own log link."""
        return self.loss != "tweedie"


# ---------------------------------------------------------------------------
# losses on the margin
# ---------------------------------------------------------------------------
def gradients(spec: BoostSpec, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss by the margin."""
    if spec.loss == "tweedie":
        a, b = np.exp((1 - spec.power) * margin), np.exp((2 - spec.power) * margin)
        return b - y * a, (2 - spec.power) * b - (1 - spec.power) * y * a
    d = margin - np.log1p(y)
    if spec.loss == "pseudo_huber":
        s = np.sqrt(1 + d * d)
        return d / s, 1 / s**3
    return d, np.ones_like(d)


def deviance(spec: BoostSpec, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Loss per row, up to terms of y alone."""
    if spec.loss == "tweedie":
        return np.exp((2 - spec.power) * margin) / (2 - spec.power) - y * np.exp(
            (1 - spec.power) * margin) / (1 - spec.power)
    d = margin - np.log1p(y)
    return np.sqrt(1 + d * d) - 1 if spec.loss == "pseudo_huber" else d * d / 2


def start_margin(spec: BoostSpec, mean_y: float, mean_log: float) -> float:
    return math.log(max(mean_y, 1e-6)) if spec.loss == "tweedie" else mean_log


# ---------------------------------------------------------------------------
# binning
# ---------------------------------------------------------------------------
def value_counts(train: DataFrame, features: list[str]) -> DataFrame:
    """f, v, n: how often each feature has each of its values.

    Tasks count the values of some batches at once, about ``HELD_VALUES`` of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def emit():
            for i in range(len(features) if held else 0):
                values, counts = np.unique(np.concatenate([b.column(i).drop_null().to_numpy(zero_copy_only=False)
                                                           for b in held]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), i, np.int32)), pa.array(values),
                                                  pa.array(counts)], names=["f", "v", "n"])

        for batch in batches:
            held.append(batch)
            n += batch.num_rows * len(features)
            if n > HELD_VALUES:
                yield from emit()
                held, n = [], 0
        yield from emit()

    data = train.select(*[F.col(f).cast("double").alias(f"__f{i}") for i, f in enumerate(features)])
    return data.mapInArrow(run, "f int, v double, n long").groupBy("f", "v").agg(F.sum("n").alias("n"))


def quantile_cuts(train: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper bounds of the bins: at most ``max_bins - 1`` distinct quantiles of each feature.

    The quantiles are exact: the smallest values with so many rows up to them.  The distinct
    values lie sorted in range partitions; the rows of each feature in each partition tell where
    a rank lies, and only the values asked for reach the driver.
    """
    ship_package(train.sparkSession)
    counts = materialize(value_counts(train, features).repartitionByRange("f", "v").sortWithinPartitions("f", "v")
                         .withColumn("part", F.spark_partition_id()))
    per_part = counts.groupBy("f", "part").agg(F.sum("n")).orderBy("f", "part").collect()
    # ranks from 1 that are asked for, the last one for the largest value
    totals = [sum(n for f, _, n in per_part if f == i) for i in range(len(features))]
    ranks = [np.unique([math.ceil(n * k / max_bins) for k in range(1, max_bins + 1)]) if n else np.array([], int)
             for n in totals]
    asked: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    before = [0] * len(features)
    for f, part, n in per_part:
        own = ranks[f][(ranks[f] > before[f]) & (ranks[f] <= before[f] + n)]
        asked[part, f] = (before[f], own)
        before[f] += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[tuple[int, int], int] = {}
        for batch in batches:
            f, v, n, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("f", "v", "n", "part"))
            for key in dict.fromkeys(zip(part.tolist(), f.tolist())):
                here = (part == key[0]) & (f == key[1])
                start = reached.get(key, asked[key][0])
                upto = start + np.cumsum(n[here])
                reached[key] = int(upto[-1])
                wanted = asked[key][1]
                wanted = wanted[(wanted > start) & (wanted <= upto[-1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(wanted), key[1], np.int32)), pa.array(wanted.astype(np.int64)),
                     pa.array(v[here][np.searchsorted(upto, wanted)])], names=["f", "rank", "v"])

    found = [{} for _ in features]
    for f, rank, v in counts.mapInArrow(run, "f int, rank long, v double").collect():
        found[f][rank] = v
    out = []
    for own, n in zip(found, totals):
        cuts = np.unique(np.array([v for rank, v in own.items()], float))
        # the largest value bounds no bin from above
        out.append(cuts[cuts < own[n]] if n else cuts)
    return out


def binned(rows: DataFrame, features: list[str], cuts: list[np.ndarray], target: str, scopes: dict[str, Column],
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows: one byte per feature and row, the target, and a bit per scope."""
    bits = sum((F.when(F.coalesce(c, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0))
                for i, c in enumerate(scopes.values())), F.lit(0))
    data = rows.select(F.col(target).cast("double").alias("__y"), bits.cast("int").alias("__in"),
                       *[F.col(f).cast("double").alias(f"__f{i}") for i, f in enumerate(features)])
    data = data.where(F.col("__in") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(held, number):
            y, member, codes = (np.concatenate(x, axis=-1) for x in zip(*held))
            return pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 32) + number]), pa.array([len(y)]),
                 pa.array([codes.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary()),
                 pa.array([member.tobytes()], pa.binary())], names=["block", "n", "codes", "y", "member"])

        held, n, number = [], 0, 0
        for batch in (b.slice(a, block_rows) for b in batches for a in range(0, b.num_rows, block_rows)):
            codes = np.stack([np.searchsorted(c, batch.column(2 + i).to_numpy(zero_copy_only=False), side="left")
                              .astype(np.uint8) for i, c in enumerate(cuts)])
            held.append((batch.column(0).to_numpy(zero_copy_only=False),
                         batch.column(1).to_numpy(zero_copy_only=False), codes))
            n += batch.num_rows
            if n >= block_rows:
                yield emit(held, number)
                held, n, number = [], 0, number + 1
        if held:
            yield emit(held, number)

    return data.mapInArrow(run, "block long, n long, codes binary, y binary, member binary")


# ---------------------------------------------------------------------------
# trees: heap order, node i has the children 2i + 1 and 2i + 2
# ---------------------------------------------------------------------------
class Tree:
    def __init__(self, depth: int):
        size = (1 << (depth + 1)) - 1
        self.feature = np.full(size, -1, np.int32)
        self.cut = np.zeros(size, np.int32)
        self.value = np.zeros(size)
        self.gain = np.zeros(size)
        self.steps: tuple | None = None  # of the last walk over packed rows

    def walk(self, codes: np.ndarray, levels: int, chosen: np.ndarray | None = None) -> np.ndarray:
        """The node that each row, or each chosen one, has reached after so many levels.

        Rows go down node by node: each split reads one feature's codes, not one of each row's own.
        """
        chosen = np.arange(codes.shape[1]) if chosen is None else chosen
        if isinstance(codes, Packed):
            return codes.walk(self, levels, chosen)
        node = np.zeros(len(chosen), np.int64)
        parts = [(0, np.arange(len(chosen)))]
        for _ in range(levels):
            following = []
            for at, rows in parts:
                f = self.feature[at]
                if f < 0:
                    node[rows] = at
                    continue
                right = codes[f][chosen[rows]] > self.cut[at]
                following += [(2 * at + 1, rows[~right]), (2 * at + 2, rows[right])]
            parts = following
        for at, rows in parts:
            node[rows] = at
        return node


def bundles(widths: np.ndarray, room: int = BUNDLE_CELLS) -> list[list[int]]:
    """Features whose numbers of bins multiply to at most ``room``; those with one bin are left out."""
    out: list[tuple[int, list[int]]] = []
    for f in np.argsort(-widths, kind="stable"):
        if widths[f] < 2:
            continue
        fit = next((i for i, (cells, _) in enumerate(out) if cells * widths[f] <= room), None)
        if fit is None:
            out.append((int(widths[f]), [int(f)]))
        else:
            out[fit] = (out[fit][0] * int(widths[f]), out[fit][1] + [int(f)])
    return [features for _, features in out] or [[0]]


def bundled(codes: np.ndarray, groups: list[list[int]], widths: np.ndarray) -> np.ndarray:
    """One code per bundle and row."""
    out = np.empty((len(groups), codes.shape[1]), np.uint8)
    for own, features in zip(out, groups):
        own[:] = codes[features[-1]]
        for f in reversed(features[:-1]):
            own *= np.uint8(widths[f])
            own += codes[f]
    return out


def unbundled(packed: np.ndarray, groups: list[list[int]], widths: np.ndarray) -> np.ndarray:
    """The features' codes from those of their bundles."""
    out = np.zeros((len(widths), packed.shape[1]), np.uint8)
    for code, features in zip(packed, groups):
        for f in features[:-1]:
            code, out[f] = np.divmod(code, np.uint8(widths[f]))
        out[features[-1]] = code
    return out


class Packed:
    """Rows by the codes of their bundles, which hold those of all features with cuts."""

    def __init__(self, matrix: np.ndarray, groups: list[list[int]], widths: np.ndarray):
        self.matrix, self.groups, self.widths, self.shape = matrix, groups, widths, (len(widths), matrix.shape[1])

    def _steps(self, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        """The bundle that each node reads, and the node that follows each (node, code)."""
        place = {}
        for i, own in enumerate(self.groups):
            below = 1
            for f in own:
                place[f], below = (i, below), below * int(self.widths[f])
        key = (tree.feature.tobytes(), tree.cut.tobytes(), self.groups)
        if tree.steps is not None and tree.steps[0] == key:  # of the block before
            return tree.steps[1:]
        size, cells = len(tree.feature), np.arange(BUNDLE_CELLS)
        bundle = np.zeros(size, np.int64)
        following = np.repeat(np.arange(size, dtype=np.min_scalar_type(size))[:, None], BUNDLE_CELLS, axis=1)
        for node in np.flatnonzero(tree.feature >= 0):
            f = int(tree.feature[node])
            bundle[node], below = place[f]
            following[node] = 2 * node + 1 + (cells // below % self.widths[f] > tree.cut[node])
        tree.steps = (key, bundle, following.ravel())
        return tree.steps[1:]

    def walk(self, tree: Tree, levels: int, chosen: np.ndarray) -> np.ndarray:
        bundle, following = self._steps(tree)
        start, codes = bundle * self.shape[1], self.matrix.ravel()
        out = np.zeros(len(chosen), following.dtype)
        for a in range(0, len(chosen), WALK_ROWS):
            rows = chosen[a:a + WALK_ROWS]
            node = np.zeros(len(rows), np.int64)
            if levels:  # all rows read the same bundle
                node = following.take(self.matrix[bundle[0]].take(rows)).astype(np.int64)
            for _ in range(levels - 1):
                node = following.take(node * BUNDLE_CELLS + codes.take(start.take(node) + rows)).astype(np.int64)
            out[a:a + WALK_ROWS] = node
        return out


def parts_of(groups: list[list[int]], widths: np.ndarray) -> list[np.ndarray]:
    """Per bundle a 0/1 matrix from its codes to the bins of its features, one feature after the other."""
    out = []
    for features in groups:
        cell, columns = np.arange(np.prod(widths[features])), []
        for f in features:
            columns.append(cell[:, None] % widths[f] == np.arange(widths[f]))
            cell = cell // widths[f]
        out.append(np.concatenate(columns, axis=1).astype(float))
    return out


def _sampled(spec: BoostSpec, block: int, turn: int, n: int) -> np.ndarray | None:
    if spec.subsample >= 1:
        return None
    seed = np.random.SeedSequence([block, turn, int.from_bytes(spec.name.encode()[:8], "big")])
    return np.random.default_rng(seed).random(n) < spec.subsample


@dataclass
class _Model:
    """A variant for one scope while it grows."""
    spec: BoostSpec
    scope: int  # bit of the rows that it sees
    start: float = 0.0
    unit: float = 0.0  # derivatives are rounded to multiples of it, if it is given


def _unit(rows: int, mean_y: float) -> float:
    """A power of two whose multiples' sums over so many rows have no more than 53 bits, with 6 to spare."""
    return 2.0 ** (math.ceil(math.log2(max(rows, 1) * max(mean_y, 1.0))) + 6 - 53)


def _own_rows(member: np.ndarray, scope: int) -> np.ndarray:
    return np.flatnonzero(member & (1 << scope))


def _small(values: np.ndarray) -> np.ndarray:
    """The same values in two bytes each, where they are such whole numbers."""
    with np.errstate(invalid="ignore"):
        short = values.astype(np.uint16)
    return short if np.array_equal(short, values) else values


def in_lanes(rows: int, width: int) -> tuple[np.ndarray, int]:
    """Where each row's lane of ``width`` cells starts, and the number of lanes.

    A sum that the row before has just added to has to be waited for; neighbouring rows add to
    different lanes.
    """
    lanes = LANES if width * LANES <= min(LANE_CELLS, rows) else 1
    return (np.arange(rows) & (lanes - 1)) * width if lanes > 1 else np.zeros(rows, np.intp), lanes


def summed(cell: np.ndarray, values: np.ndarray | None, width: int, lanes: int) -> np.ndarray:
    """Sums (or the number) of the values by cell, over all lanes."""
    found = np.bincount(cell, values, width * lanes)
    return found.reshape(lanes, width).sum(axis=0) if lanes > 1 else found


def _sums(blocks, models, trees, open_nodes, turn, level, bins, usable=None):
    """Merged per task: (model, group of features) -> sums by (node, feature, bin).

    Features that the model cannot split on (``usable``: cuts by model and feature) are left at
    0, but for each group's first one, which gives the nodes' totals.  The bundles of packed
    rows are counted in place of the features, as are those that a block ends in.  Margins are
    those of all rows, or of the model's own ones.
    """
    out: dict = {}

    def add(m, first, sums):
        out[m, first] = out[m, first] + sums if (m, first) in out else sums

    def counts(cell, g, h, width, lanes, loss):
        # the squared loss's second derivative is 1: a plain count
        return summed(cell, g, width, lanes), summed(cell, None if loss == "squared" else h, width, lanes)

    for block, codes, y, member, margins, *bundle_codes in blocks:
        counted = bundle_codes[0] if bundle_codes else codes.matrix if isinstance(codes, Packed) else codes
        features, n = counted.shape
        own_rows, drawn_rows, roots = {}, {}, {}
        for m, model in enumerate(models):
            nodes, spec, scope = open_nodes[m], model.spec, model.scope
            if not len(nodes):
                continue
            if scope not in own_rows:
                own_rows[scope] = _own_rows(member, scope)
            if spec.name not in drawn_rows:  # one sample for all scopes of a variant
                drawn_rows[spec.name] = _sampled(spec, block, turn, n)
            rows, drawn = own_rows[scope], drawn_rows[spec.name]
            margin = margins[m] if len(margins[m]) == len(rows) else margins[m][rows]
            if drawn is not None:
                drawn = drawn[rows]
            at = None
            if level:
                place = np.full(len(trees[m].feature), -1)
                place[nodes] = np.arange(len(nodes))
                if drawn is not None:
                    rows, margin = rows[drawn], margin[drawn]
                at = place[trees[m].walk(codes, level, rows)]
                rows, margin, at = rows[at >= 0], margin[at >= 0], at[at >= 0]
            if not len(rows):
                continue
            g, h = gradients(spec, y[rows].astype(float), margin)
            if model.unit:
                g, h = np.rint(g / model.unit) * model.unit, np.rint(h / model.unit) * model.unit
            if not level:
                if drawn is not None:
                    g, h = g * drawn, h * drawn
                roots.setdefault(scope, []).append((m, g, h, "all" if drawn is not None else spec.loss))
                continue
            # one feature at a time: the places of one fit the cache, those of a group do not
            width = len(nodes) * bins
            starts, lanes = in_lanes(len(rows), width)
            base = at * bins + starts
            cell, everyone = np.empty_like(base), len(rows) == n
            for first in range(0, features, GROUP_FEATURES):
                own = counted[first:first + GROUP_FEATURES]
                sums = np.zeros((2, len(own) * width))
                for i, code in enumerate(own):
                    if i and usable is not None and not usable[m][first + i]:
                        continue
                    np.add(base, code if everyone else code.take(rows), out=cell)
                    sums[:, i * width:(i + 1) * width] = counts(cell, g, h, width, lanes, spec.loss)
                add(m, first, sums)
        # all models of a scope count the same rows at the root; those not drawn weigh 0
        for scope, held in roots.items():
            rows = own_rows[scope]
            starts, lanes = in_lanes(len(rows), bins)
            cell = np.empty(len(rows), np.intp)
            for first in range(0, features, GROUP_FEATURES):
                own = counted[first:first + GROUP_FEATURES]
                sums = np.zeros((len(held), 2, len(own) * bins))
                for i, code in enumerate(own):
                    np.add(starts, code if len(rows) == n else code.take(rows), out=cell)
                    for found, (m, g, h, loss) in zip(sums, held):
                        if not i or usable is None or usable[m][first + i]:
                            found[:, i * bins:(i + 1) * bins] = counts(cell, g, h, bins, lanes, loss)
                for found, (m, *_) in zip(sums, held):
                    add(m, first, found)
    return iter(out.items())


def _by_feature(items, parts: list[np.ndarray], sizes: list[int]):
    """From sums by bundle to sums by (feature, node, bin), one feature of the group after the other."""
    for (m, first), sums in items:
        own = parts[first:first + GROUP_FEATURES]
        sums = sums.reshape(2, len(own), sizes[m], -1)
        yield (m, first), np.concatenate([sums[:, i, :, :len(part)] @ part for i, part in enumerate(own)], axis=2)


def _best(item, models, open_nodes, usable, groups, widths):
    """Best split of each open node among one group of bundles."""
    (m, first), sums = item
    spec, nodes = models[m].spec, open_nodes[m]
    features = np.array([f for own in groups[first:first + GROUP_FEATURES] for f in own])
    starts = np.cumsum([0, *widths[features[:-1]]])
    total = sums[:, :, :widths[features[0]]].sum(axis=2)

    def worth(a, b):
        shrunk = np.sign(a) * np.maximum(np.abs(a) - spec.reg_alpha, 0)
        return shrunk**2 / (b + spec.reg_lambda)

    before = worth(*total)[:, None, None]
    best: list = [None] * len(nodes)
    # features of about as many bins together
    size = 2 ** np.ceil(np.log2(np.maximum(widths[features], 2))).astype(int)
    for bins in np.unique(size):
        at = np.flatnonzero((size == bins) & (usable[m][features] > 0))
        if not len(at):
            continue
        at = at[np.argsort(features[at])]
        cell = np.arange(bins)
        inside = cell < widths[features[at]][:, None]
        left = np.where(inside, sums[:, :, np.where(inside, starts[at][:, None] + cell, 0)], 0.0)
        left_g, left_h = np.cumsum(left, axis=3)
        right_g, right_h = (t[:, None, None] - a for t, a in zip(total, (left_g, left_h)))
        allowed = (usable[m][features[at]][:, None] > cell) & (left_h >= spec.min_child_weight) & (
            right_h >= spec.min_child_weight)
        gain = (worth(left_g, left_h) + worth(right_g, right_h) - before) / 2 - spec.gamma
        gain = np.where(allowed, gain, -np.inf).reshape(len(nodes), -1)
        for i, b in enumerate(gain.argmax(axis=1)):
            f, cut = divmod(int(b), int(bins))
            found = (float(gain[i, b]), int(features[at[f]]), cut, float(left_g[i, f, cut]), float(left_h[i, f, cut]))
            if best[i] is None or (-found[0], found[1]) < (-best[i][0], best[i][1]):
                best[i] = found
    nothing = (-np.inf, int(features[0]), 0, 0.0, 0.0)
    return [(m, int(n), *(best[i] or nothing), float(total[0, i]), float(total[1, i])) for i, n in enumerate(nodes)]


def _leaf(spec: BoostSpec, g: float, h: float) -> float:
    shrunk = math.copysign(max(abs(g) - spec.reg_alpha, 0.0), g)
    return -shrunk / (h + spec.reg_lambda) if h + spec.reg_lambda > 0 else 0.0


def level_sums(state, models, trees, counted, turn: int, level: int, usable, groups, widths) -> dict:
    """(model, group of features) -> sums by (counted node, feature and bin): one job."""
    sizes = [len(n) for n in counted]
    asked = [np.array([own[g].any() for g in groups]) for own in usable]
    # each task makes the matrices itself: they outweigh all else that the job carries
    sums = state.mapPartitions(lambda it: _by_feature(
        _sums(it, models, trees, counted, turn, level, BUNDLE_CELLS, asked), parts_of(groups, widths), sizes))
    size = sum(sizes) * sum(int(widths[f]) for own in groups for f in own) * 16
    if size * state.getNumPartitions() > COLLECT_BYTES:
        sums = sums.reduceByKey(np.add, max(1, min(state.getNumPartitions(), 2 * len(models))))
    merged: dict = {}
    for key, own in sums.collect():
        merged[key] = merged[key] + own if key in merged else own
    return merged


def with_siblings(sums: dict, parents: dict, counted: list[np.ndarray], before: list[np.ndarray]) -> dict:
    """Sums of both children of each split, from those of one of them and of the nodes ``before``."""
    out = {}
    for (m, first), held in parents.items():
        if not len(counted[m]):
            continue
        parent = held[:, np.searchsorted(before[m], (counted[m] - 1) // 2)]
        own = sums.get((m, first), np.zeros_like(parent))
        pairs = np.stack([own, parent - own], axis=2)
        right = counted[m] % 2 == 0
        pairs[:, right] = pairs[:, right, ::-1]
        out[m, first] = pairs.reshape(2, -1, pairs.shape[-1])
    return out


def best_splits(sums: dict, models, open_nodes, usable, groups, widths) -> dict:
    """(model, node) -> (gain, feature, cut, GL, HL, G, H)."""
    found = [r for item in sums.items() for r in _best(item, models, open_nodes, usable, groups, widths)]
    best: dict = {}
    for m, node, gain, f, cut, *totals in sorted(found, key=lambda r: r[3]):
        if (m, node) not in best or gain > best[m, node][0]:
            best[m, node] = (gain, f, cut, *totals)
    return best


def _grow(state, models, turn: int, cut_counts: np.ndarray, groups: list[list[int]]) -> list[Tree]:
    trees = [Tree(m.spec.depth) for m in models]
    usable = []
    for m in models:
        seed = np.random.SeedSequence([turn, int.from_bytes(m.spec.name.encode()[:8], "big")])
        keep = max(1, round(m.spec.colsample * len(cut_counts)))
        chosen = np.random.default_rng(seed).permutation(len(cut_counts))[:keep]
        mask = np.zeros(len(cut_counts), np.int64)
        mask[chosen] = cut_counts[chosen]
        usable.append(mask)
    open_nodes = counted = [np.array([0]) for _ in models]
    before, sums = open_nodes, {}
    for level in range(max(m.spec.depth for m in models)):
        own = level_sums(state, models, trees, counted, turn, level, usable, groups, cut_counts + 1)
        sums = with_siblings(own, sums, counted, before) if level else own
        best = best_splits(sums, models, open_nodes, usable, groups, cut_counts + 1)
        lighter: list[list[int]] = [[] for _ in models]
        for (m, node), (gain, f, cut, gl, hl, g, h) in best.items():
            spec, tree = models[m].spec, trees[m]
            if node == 0:
                tree.value[0] = _leaf(spec, g, h)
            if not gain > 0:
                continue
            tree.feature[node], tree.cut[node], tree.gain[node] = f, cut, gain
            tree.value[2 * node + 1], tree.value[2 * node + 2] = _leaf(spec, gl, hl), _leaf(spec, g - gl, h - hl)
            if level + 1 < spec.depth:
                lighter[m].append(2 * node + 1 if hl <= h - hl else 2 * node + 2)
        before, counted = open_nodes, [np.array(sorted(own), dtype=np.int64) for own in lighter]
        open_nodes = [((own[:, None] - 1) // 2 * 2 + [1, 2]).ravel() for own in counted]
        if not any(len(own) for own in counted):
            break
    return trees


# ---------------------------------------------------------------------------
# fitted trees
# ---------------------------------------------------------------------------
class BoostedTrees:
    """Trees on the features' own scale: a row goes right where its feature exceeds the cut."""

    def __init__(self, spec: BoostSpec, features: list[str], start: float, feature: np.ndarray, cut: np.ndarray,
                 value: np.ndarray, gain: np.ndarray):
        self.spec, self.features, self.start = spec, features, start
        self.feature, self.cut, self.value, self.gain = feature, cut, value, gain

    @classmethod
    def of(cls, model: _Model, trees: list[Tree], features: list[str], cuts: list[np.ndarray]) -> "BoostedTrees":
        feature = np.stack([t.feature for t in trees])
        cut = np.stack([[cuts[f][c] if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)] for t in trees])
        return cls(model.spec, features, model.start, feature, cut,
                   np.stack([t.value * model.spec.eta for t in trees]), np.stack([t.gain for t in trees]))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Margin of each row of a (features, rows) matrix."""
        out, rows = np.full(x.shape[1], self.start), np.arange(x.shape[1])
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(x.shape[1], np.int64)
            for _ in range(self.spec.depth):
                f = feature[node]
                node = np.where(f >= 0, 2 * node + 1 + (x[f, rows] > cut[node]), node)
            out += value[node]
        return out

    def scale(self, margin: np.ndarray) -> np.ndarray:
        """From the margin to the prediction: log1p(demand), or demand for the tweedie loss."""
        return np.exp(margin) if self.spec.loss == "tweedie" else margin

    def score(self) -> Column:
        """The prediction as a column over the feature columns."""
        return predictions([self])[0]

    def importances(self) -> np.ndarray:
        """Mean gain of each feature's splits, as shares."""
        used = self.feature >= 0
        total = np.bincount(self.feature[used], self.gain[used], len(self.features))
        mean = total / np.maximum(np.bincount(self.feature[used], minlength=len(self.features)), 1)
        return mean / mean.sum() if mean.sum() else mean

    def save(self, spark, path: str) -> None:
        meta = {"spec": asdict(self.spec), "features": self.features, "start": self.start}
        rows = [(json.dumps(meta), *[a.ravel().tolist() for a in (self.feature, self.cut, self.value, self.gain)])]
        (spark.createDataFrame(rows, "meta string, feature array<int>, cut array<double>, value array<double>, "
                                     "gain array<double>").coalesce(1).write.mode("overwrite").parquet(path))

    @classmethod
    def load(cls, spark, path: str) -> "BoostedTrees":
        row = spark.read.parquet(path).first()
        meta = json.loads(row["meta"])
        spec = BoostSpec(**meta["spec"])
        shape = (-1, (1 << (spec.depth + 1)) - 1)
        return cls(spec, meta["features"], meta["start"],
                   *[np.array(row[c]).reshape(shape) for c in ("feature", "cut", "value", "gain")])


def predictions(models: list[BoostedTrees]) -> Column:
    """All models' predictions of a row as one array, in one pass over its feature columns."""
    features = models[0].features

    @F.pandas_udf("array<double>")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.stack([c.to_numpy(float) for c in columns])
        return pd.Series(list(np.stack([m.scale(m.margins(x)) for m in models], axis=1)))

    return score(*[F.col(f).cast("double") for f in features])


def _rows_of(row):
    n = row["n"]
    return (row["block"], np.frombuffer(row["codes"], np.uint8).reshape(-1, n), np.frombuffer(row["y"]),
            np.frombuffer(row["member"], np.int32))


def _joined(blocks):
    """Blocks of up to about ``DEALT_ROWS`` rows, each named after its first part."""
    held, n = [], 0
    for block in blocks:
        if held and n + len(block[2]) > DEALT_ROWS:
            yield (held[0][0], *[np.concatenate([b[i] for b in held], axis=-1) for i in (1, 2, 3)])
            held, n = [], 0
        held.append(block)
        n += len(block[2])
    if held:
        yield (held[0][0], *[np.concatenate([b[i] for b in held], axis=-1) for i in (1, 2, 3)])


@dataclass
class Binned:
    """The binned training rows, which all learners on them share."""
    features: list[str]
    cuts: list[np.ndarray]
    scopes: dict[str, Column]
    counts: dict[str, int]
    means: dict[str, float]
    mean_logs: dict[str, float]
    blocks: DataFrame
    held: int

    def state(self):
        """(block, codes, y, member) of every block.

        Every task gets as many of the blocks as any other and joins them to larger ones.
        """
        cores = self.blocks.sparkSession.sparkContext.defaultParallelism
        rows = max(self.counts.values())  # a row of several scopes is in one block
        parts = max(1, min(self.held, cores * -(-rows // (cores * PART_ROWS))))
        dealt = self.blocks.rdd.zipWithIndex().map(lambda x: (x[1] % parts, x[0])).partitionBy(parts, int)
        return dealt.mapPartitions(lambda it: _joined(_rows_of(row) for _, row in it))


def bin_rows(rows: DataFrame, features: list[str], target: str, scopes: dict[str, Column], max_bins: int = MAX_BINS,
             cuts: list[np.ndarray] | None = None) -> Binned:
    """``scopes`` names the rows of each scope; the first one's quantiles bound the bins unless ``cuts`` are given."""
    spark = rows.sparkSession
    checkpoint_dir(spark)
    ship_package(spark)
    first = next(iter(scopes.values()))
    cuts = quantile_cuts(rows.where(first), features, max_bins) if cuts is None else cuts
    y = F.col(target).cast("double")
    found = rows.agg(*[f(F.when(c, v)).alias(f"{n}{i}") for i, c in enumerate(scopes.values())
                       for n, f, v in (("y", F.avg, y), ("l", F.avg, F.log1p(y)), ("c", F.count, y))]).first()
    cores = spark.sparkContext.defaultParallelism
    n = sum(found[f"c{i}"] for i in range(len(scopes)))
    block_rows = min(BLOCK_ROWS, max(LEAST_BLOCK_ROWS, -(-n // (BLOCKS_PER_CORE * cores))))
    blocks = materialize(binned(rows, features, cuts, target, scopes, block_rows))
    by_scope = [{s: found[f"{k}{i}"] for i, s in enumerate(scopes)} for k in "cyl"]
    return Binned(features, cuts, scopes, *by_scope, blocks, blocks.count())


def fit(rows: DataFrame, features: list[str], target: str, specs: list[BoostSpec], scopes: dict[str, Column],
        max_bins: int = MAX_BINS, cuts: list[np.ndarray] | None = None, trace: list | None = None,
        table: Binned | None = None) -> dict[tuple[str, str], BoostedTrees]:
    """(variant, scope) -> trees, all grown by the same jobs.

    ``scopes`` names the rows of each scope.  Missing feature values must have been filled.
    ``cuts`` gives the bins' upper bounds instead of quantiles; ``trace`` gets the mean
    deviance of every model before each round and after the last.  ``table``: the rows if
    they have been binned already.
    """
    table = table or bin_rows(rows, features, target, scopes, max_bins, cuts)
    cuts = table.cuts
    models = [_Model(s, i, start_margin(s, table.means[k], table.mean_logs[k]), _unit(table.counts[k], table.means[k]))
              for s in specs for i, k in enumerate(scopes) if table.counts[k]]
    starts = [m.start for m in models]
    counts = np.array([len(c) for c in cuts])
    groups = bundles(counts + 1)
    kind = np.min_scalar_type((1 << len(scopes)) - 1)

    def begin(block):
        number, codes, y, member = block
        return (number, Packed(bundled(codes, groups, counts + 1), groups, counts + 1), _small(y), member.astype(kind),
                [np.full(len(_own_rows(member, m.scope)), start) for m, start in zip(models, starts)])

    state = table.state().map(begin).persist(StorageLevel.MEMORY_AND_DISK)
    grown: list[list[Tree]] = [[] for _ in models]
    before = None
    for turn in range(max(m.spec.rounds for m in models)):
        if trace is not None:
            trace.append(_mean_deviance(state, models))
        going = [i for i, m in enumerate(models) if turn < m.spec.rounds]
        # models that are done keep their margins but look for no more splits
        trees = _grow_some(state, models, going, turn, counts, groups)
        for i in going:
            grown[i].append(trees[i])
        if before is not None:
            before.unpersist()
        # made by the next round's first job
        before, state = state, state.map(lambda b, trees=trees: _advance(b, models, trees)).persist(
            StorageLevel.MEMORY_AND_DISK)
        if (turn + 1) % CUT_ROUNDS == 0:
            state.checkpoint()
    if trace is not None:
        trace.append(_mean_deviance(state, models))
    for held in (before, state):
        held.unpersist()
    names = list(scopes)
    return {(m.spec.name, names[m.scope]): BoostedTrees.of(m, grown[i], features, cuts) for i, m in enumerate(models)}


def _grow_some(state, models, going, turn, counts, groups):
    if len(going) == len(models):
        return _grow(state, models, turn, counts, groups)
    found = _grow(state.map(lambda b: (*b[:4], [b[4][i] for i in going])), [models[i] for i in going], turn, counts, groups)
    out: list = [None] * len(models)
    for i, t in zip(going, found):
        out[i] = t
    return out


def _advance(block, models, trees):
    number, codes, y, member, margins, *more = block
    margins, own_rows = list(margins), {}
    for i, (m, t) in enumerate(zip(models, trees)):
        if t is not None:
            if m.scope not in own_rows:
                own_rows[m.scope] = _own_rows(member, m.scope)
            rows, margins[i] = own_rows[m.scope], margins[i].copy()
            step = t.value[t.walk(codes, m.spec.depth, rows)] * m.spec.eta
            margins[i][slice(None) if len(margins[i]) == len(rows) else rows] += step
    return number, codes, y, member, margins, *more


def _mean_deviance(state, models) -> list[float]:
    def run(b):
        y, member, margins = b[2:5]
        own = [_own_rows(member, m.scope) for m in models]
        return np.array([[deviance(m.spec, y[r].astype(float), a if len(a) == len(r) else a[r]).sum(), len(r)]
                         for m, a, r in zip(models, margins, own)])
    total = state.map(run).treeReduce(np.add)
    return (total[:, 0] / np.maximum(total[:, 1], 1)).tolist()
