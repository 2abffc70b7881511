"""Chronological splits without a global sort.

Rows are ordered by (hour_start, station, rider).  Per-hour counts -- one row
per hour of the covered span -- give every hour its offset; only rows of the
(at most two) hours a cut falls into are ranked inside their hour.  The fact
itself is never sorted globally or pulled into one partition.
"""
from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..constants import CALIBRATION_FRACTION, TEST_FRACTION

ORDER = ["hour_start", "start_station_id", "rider_type"]


def _hour_offsets(df: DataFrame, time_col: str) -> DataFrame:
    """(hour, rows in hour, rows in earlier hours).

    The window runs over the per-hour table, whose size is bounded by the
    number of distinct hours in the data, not by the number of rows.
    """
    counts = df.groupBy(time_col).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(time_col).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))


def label_by_position(df: DataFrame, cuts: list[tuple[int, str]], last_label: str,
                      order: list[str] | None = None) -> DataFrame:
    """Label each row by its position in the global order.

    ``cuts`` = [(end_position_exclusive, label), ...] ascending; rows at
    positions >= the last cut get ``last_label``.  Positions are 0-based.
    """
    order = order or ORDER
    time_col = order[0]
    hours = F.broadcast(_hour_offsets(df, time_col))  # one row per distinct hour
    marked = df.join(hours, time_col)
    lo, hi = F.col("_before"), F.col("_before") + F.col("_n")

    def label_of(pos_lo, pos_hi_inclusive):
        expr = None
        for end, label in cuts:
            cond = pos_hi_inclusive < end
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        return expr.otherwise(F.lit(last_label))

    straddles = None
    for end, _ in cuts:
        cond = (lo < end) & (hi > end)
        straddles = cond if straddles is None else (straddles | cond)
    whole = marked.filter(~straddles).withColumn("split", label_of(lo, hi - 1))
    w = Window.partitionBy(time_col).orderBy(*order[1:])
    cut_hours = marked.filter(straddles).withColumn("_pos", lo + F.row_number().over(w) - 1)
    cut_hours = cut_hours.withColumn("split", label_of(F.col("_pos"), F.col("_pos"))).drop("_pos")
    return whole.unionByName(cut_hours).drop("_n", "_before")


def label_by_key(df: DataFrame, cuts: list[tuple[int, str]], last_label: str,
                 order: list[str] | None = None) -> Column:
    """The labels of ``label_by_position`` as a column, for rows whose ``order`` columns are unique.

    The keys at the cuts are looked up once (one row per cut reaches the driver); every row then
    tells its label by comparing its own key with them, without a join or a shuffle.
    """
    order = order or ORDER
    time_col = order[0]
    at = [F.col("_before").isNotNull() & (F.col("_before") <= end) & (F.col("_before") + F.col("_n") > end)
          for end, _ in cuts]
    hours = _hour_offsets(df.select(time_col), time_col).where(reduce(or_, at)).collect()
    found = [next((h for h in hours if h["_before"] <= end < h["_before"] + h["_n"]), None) for end, _ in cuts]
    wanted = [(F.col(time_col).eqNullSafe(F.lit(h[time_col]))) & (F.col("_pos") == end - h["_before"])
              for h, (end, _) in zip(found, cuts) if h is not None]
    rows = []
    if wanted:
        w = Window.partitionBy(time_col).orderBy(*order[1:])
        inside = df.select(*order).where(reduce(or_, [F.col(time_col).eqNullSafe(F.lit(h[time_col])) for h in hours]))
        rows = inside.withColumn("_pos", F.row_number().over(w) - 1).where(reduce(or_, wanted)).collect()
    types = {f.name: f.dataType for f in df.select(*order).schema.fields}
    key, label = F.struct(*order), None
    for h, (end, name) in zip(found, cuts):
        # a cut behind the last row: no row lies after it
        before = F.lit(True) if h is None else key < F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in next(
            r.asDict() for r in rows if r[time_col] == h[time_col] and r["_pos"] == end - h["_before"]).items()
            if c != "_pos"])
        label = F.when(before, F.lit(name)) if label is None else label.when(before, F.lit(name))
    return label.otherwise(F.lit(last_label))


def split_bounds(n: int, calibration_fraction: float = CALIBRATION_FRACTION,
                 test_fraction: float = TEST_FRACTION) -> tuple[int, int]:
    """Train / calibration ends exactly as the reference clamps them (Python float maths)."""
    if n < 3:
        raise ValueError("At least three rows are required for train/calibration/test splitting.")
    train_end = int(n * (1 - calibration_fraction - test_fraction))
    calibration_end = int(n * (1 - test_fraction))
    train_end = max(1, min(train_end, n - 2))
    calibration_end = max(train_end + 1, min(calibration_end, n - 1))
    return train_end, calibration_end


def temporal_train_calibration_test_split(df: DataFrame, calibration_fraction: float = CALIBRATION_FRACTION,
                                          test_fraction: float = TEST_FRACTION,
                                          order: list[str] | None = None) -> DataFrame:
    """M1: adds ``split`` in {train, calibration, test} by row fraction."""
    train_end, cal_end = split_bounds(df.count(), calibration_fraction, test_fraction)
    return label_by_position(df, [(train_end, "train"), (cal_end, "calibration")], "test", order)


def train_end(n: int, test_fraction: float = TEST_FRACTION) -> int:
    return max(1, min(int(n * (1 - test_fraction)), n - 1))


def temporal_train_test_split(df: DataFrame, test_fraction: float = TEST_FRACTION,
                              order: list[str] | None = None) -> DataFrame:
    """M2: adds ``split`` in {train, test}."""
    return label_by_position(df, [(train_end(df.count(), test_fraction), "train")], "test", order)


def latest_rows(df: DataFrame, max_rows: int | None, order: list[str] | None = None) -> DataFrame:
    """Keep the latest ``max_rows`` rows in time order (all when None or fewer)."""
    if not max_rows:
        return df
    n = df.count()
    if n <= max_rows:
        return df
    return (label_by_position(df, [(n - max_rows, "old")], "keep", order)
            .filter(F.col("split") == "keep").drop("split"))


def split_summary(split_df: DataFrame, time_col: str = "hour_start") -> DataFrame:
    """Rows and first/last hour of each split."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("row_count"),
                                         F.min(time_col).alias("start_hour"), F.max(time_col).alias("end_hour"))
