"""Isotonic regression by distributed pool-adjacent-violators.

Distinct predictions with the sum and count of their actuals are sorted over range
partitions.  Every partition pools neighbours that violate the order into blocks (a stack
of (sum, weight); pooling is associative, so blocks pool like points).  Then the blocks are
numbered and dealt into chunks of neighbouring blocks, whose borders move by half a chunk
from round to round, and pooled again.  Two rounds in a row without a change leave no
violating neighbours anywhere, as every pair of neighbours shared a chunk in one of them.
No task holds more than a partition or a few chunks of blocks, and nothing is rounded.

The fit has one row per block; between blocks predictions are interpolated, beyond the
first and last they are clipped.  Fits of up to ``MAX_KNOTS`` knots travel to the tasks as
arrays; longer ones are merged with the predictions in cells of the predictions' range.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize, ship_package

CHUNK_BLOCKS = 100_000
MAX_KNOTS = 1_000_000
_BLOCKS = "model string, lo double, hi double, s double, w double, chunk long, idx long"


def _pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pool sorted neighbours; rows whose ``pos`` does not follow on start a new run."""
    task = TaskContext.get().partitionId()
    run: list[list] = []  # blocks [lo, hi, sum, weight, chunk] of the run that goes on
    model, after, idx, chunk_now = None, None, 0, None

    def emit():
        nonlocal idx, chunk_now
        places = []
        for block in run:
            if block[4] != chunk_now:
                chunk_now, idx = block[4], 0
            places.append(idx)
            idx += 1
        lo, hi, s, w, chunk = (list(c) for c in zip(*run))
        return pa.RecordBatch.from_arrays(
            [pa.array([model] * len(run), pa.string()), pa.array(lo, pa.float64()), pa.array(hi, pa.float64()),
             pa.array(s, pa.float64()), pa.array(w, pa.float64()), pa.array(chunk, pa.int64()),
             pa.array(places, pa.int64())], names=["model", "lo", "hi", "s", "w", "chunk", "idx"])

    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(c).to_pylist() for c in ("model", "lo", "hi", "s", "w")]
        chunks = batch.column("chunk").to_pylist() if "chunk" in names else [task] * batch.num_rows
        places = batch.column("pos").to_pylist() if "pos" in names else [None] * batch.num_rows
        for m, lo, hi, s, w, chunk, pos in zip(*columns, chunks, places):
            if run and (m != model or pos is not None and pos != after):
                yield emit()
                run = []
            model, after = m, None if pos is None else pos + 1
            while run and run[-1][2] * w >= s * run[-1][3]:
                last = run.pop()
                lo, s, w, chunk = last[0], s + last[2], w + last[3], last[4]
            run.append([lo, hi, s, w, chunk])
    if run:
        yield emit()


def isotonic_blocks(pred: DataFrame, chunk_blocks: int = CHUNK_BLOCKS) -> DataFrame:
    """model, lo, hi, value, weight: the isotonic fit of ``y`` on ``pred`` of each model."""
    spark = pred.sparkSession
    ship_package(spark)
    points = (pred.groupBy(F.col("model").cast("string").alias("model"), F.col("pred").cast("double").alias("lo"))
              .agg(F.sum(F.col("y").cast("double")).alias("s"), F.count("y").cast("double").alias("w"))
              .where((F.col("w") > 0) & F.col("lo").isNotNull())
              .select("model", "lo", F.col("lo").alias("hi"), "s", "w"))
    blocks = materialize(points.repartitionByRange("model", "lo").sortWithinPartitions("model", "lo")
                         .mapInArrow(_pool, _BLOCKS))
    unchanged, turn, before = 0, 0, None
    while True:
        sizes = blocks.groupBy("chunk").agg(F.count("*")).orderBy("chunk").collect()  # one row per chunk
        total = sum(n for _, n in sizes)
        unchanged = unchanged + 1 if total == before else 0
        if len(sizes) <= 1 or unchanged == 2:
            break
        starts = np.concatenate([[0], np.cumsum([n for _, n in sizes])[:-1]]).tolist()
        base = F.broadcast(spark.createDataFrame(list(zip([c for c, _ in sizes], starts)), "chunk long, base long"))
        shift = chunk_blocks // 2 if turn % 2 else 0
        numbered = (blocks.join(base, "chunk").withColumn("pos", F.col("base") + F.col("idx"))
                    .withColumn("chunk", F.floor((F.col("pos") + shift) / chunk_blocks)))
        blocks = materialize(numbered.select("model", "lo", "hi", "s", "w", "chunk", "pos")
                             .repartition(total // chunk_blocks + 1, "chunk").sortWithinPartitions("chunk", "pos")
                             .mapInArrow(_pool, _BLOCKS))
        before, turn = total, turn + 1
    return blocks.select("model", "lo", "hi", (F.col("s") / F.col("w")).alias("value"), F.col("w").alias("weight"))


class IsotonicFit:
    """The knots of one model's fit, small enough to travel with a plan."""

    def __init__(self, x: np.ndarray, value: np.ndarray):
        self.x, self.value = x, value

    @classmethod
    def of(cls, blocks: DataFrame, model: str) -> "IsotonicFit":
        rows = blocks.where(F.col("model") == model).orderBy("lo").limit(MAX_KNOTS // 2 + 1).collect()
        if len(rows) > MAX_KNOTS // 2:
            raise ValueError(f"the fit of {model} has over {MAX_KNOTS} knots: use interpolate() on its blocks")
        x = np.array([v for r in rows for v in (r["lo"], r["hi"])])
        return cls(x, np.array([r["value"] for r in rows for _ in (0, 1)]))

    def column(self, of: Column) -> Column:
        x, value = self.x, self.value

        @F.pandas_udf("double")
        def fitted(column: pd.Series) -> pd.Series:
            return pd.Series(np.interp(column.to_numpy(float), x, value))

        return fitted(of.cast("double"))

    def save(self, spark, path: str) -> None:
        (spark.createDataFrame([(self.x.tolist(), self.value.tolist())], "x array<double>, value array<double>")
         .coalesce(1).write.mode("overwrite").parquet(path))

    @classmethod
    def load(cls, spark, path: str) -> "IsotonicFit":
        row = spark.read.parquet(path).first()
        return cls(np.array(row["x"]), np.array(row["value"]))


def interpolate(pred: DataFrame, blocks: DataFrame, out: str = "fitted", cells: int = 1000) -> DataFrame:
    """``pred`` with each row's value of its model's fit, whatever the fit's size.

    Distinct predictions and knots are laid into cells of the predictions' range; within a
    cell a window finds the knots around each prediction, and a table with one row per model
    and cell carries the nearest knots across cells.
    """
    at = [i / cells for i in range(1, cells)]
    cuts = F.broadcast(pred.groupBy("model").agg(F.percentile_approx("pred", at, 10 * cells).alias("__cuts")))
    cell = F.size(F.filter("__cuts", lambda c: c < F.col("__x")))
    knots = blocks.select("model", F.explode(F.array("lo", "hi")).alias("__x"), F.col("value").alias("__v")).distinct()
    points = pred.select("model", F.col("pred").alias("__x"), F.lit(None).cast("double").alias("__v")).distinct()
    both = knots.unionByName(points).join(cuts, "model").withColumn("__cell", cell).drop("__cuts")
    knot = F.when(F.col("__v").isNotNull(), F.struct(F.col("__x").alias("x"), F.col("__v").alias("v")))
    ends = both.groupBy("model", "__cell").agg(F.min(knot).alias("first"), F.max(knot).alias("last"))
    over = Window.partitionBy("model").orderBy("__cell")  # one row per cell
    ends = ends.select("model", "__cell",
                       F.last("last", True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("__left"),
                       F.first("first", True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("__right"))
    inside = Window.partitionBy("model", "__cell").orderBy("__x")
    around = both.withColumns({
        "__a": F.last(knot, True).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)),
        "__b": F.first(knot, True).over(inside.rangeBetween(Window.currentRow, Window.unboundedFollowing))})
    around = (around.where(F.col("__v").isNull()).join(F.broadcast(ends), ["model", "__cell"])
              .withColumns({"__a": F.coalesce("__a", "__left"), "__b": F.coalesce("__b", "__right")}))
    a, b, x = F.col("__a"), F.col("__b"), F.col("__x")
    value = (F.when(a.isNull(), b["v"]).when(b.isNull() | (a["x"] == b["x"]), a["v"])
             .otherwise(a["v"] + (b["v"] - a["v"]) / (b["x"] - a["x"]) * (x - a["x"])))
    fitted = around.select(F.col("model").alias("__m"), F.col("__x"), value.alias(out))
    return (pred.join(fitted, (pred["model"] == fitted["__m"]) & (pred["pred"] == fitted["__x"]), "left")
            .drop("__m", "__x"))
