"""Exact medians for groups too large to hold in one task.

``median()`` keeps every distinct value of a group in one task's buffer.  That
is fine for small integers (demand) or small groups, but not for a continuous
value over a group of billions of rows (trip duration per rider type, residuals
over a whole split).  ``exact_median`` narrows each group with histogram passes
(partial aggregates, one small table per group) to the bucket(s) holding the
middle positions, and only the distinct values inside that narrow range are
ranked.  The result is the exact interpolated median.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def exact_median(df: DataFrame, groups: list[str], value: str, out: str = "median",
                 buckets: int = 1024, rounds: int = 2, few_groups: bool = False) -> DataFrame:
    """``few_groups``: the caller knows that there are few (rider types, models): their one-row
    states are then broadcast, and rows do not move to meet them."""
    keys = list(groups) or ["__em_all"]
    data = df.select(*[F.col(g) for g in groups], F.col(value).cast("double").alias("__em_v")).dropna(subset=["__em_v"])
    if not groups:
        data = data.withColumn("__em_all", F.lit(0))
    state = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("__em_n"), F.min("__em_v").alias("__em_lo"),
                                    F.max("__em_v").alias("__em_hi"))
    state = state.select(*keys, "__em_lo", "__em_hi", F.lit(0).cast("bigint").alias("__em_before"),
                         F.floor((F.col("__em_n") - 1) / 2).alias("__em_k1"), F.floor(F.col("__em_n") / 2).alias("__em_k2"))
    meet = F.broadcast if few_groups or not groups else lambda t: t
    for _ in range(rounds):
        width = (F.col("__em_hi") - F.col("__em_lo")) / buckets
        b = F.when(width == 0, F.lit(0)).otherwise(
            F.least(F.floor((F.col("__em_v") - F.col("__em_lo")) / width), F.lit(buckets - 1)))
        hist = (data.join(meet(state), keys).filter(F.col("__em_v").between(F.col("__em_lo"), F.col("__em_hi")))
                .groupBy(*keys, b.alias("__em_b"), "__em_before", "__em_k1", "__em_k2")
                .agg(F.count(F.lit(1)).alias("__em_c"), F.min("__em_v").alias("__em_blo"), F.max("__em_v").alias("__em_bhi")))
        # at most `buckets` rows per group
        w = Window.partitionBy(*keys).orderBy("__em_b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("__em_cb", F.col("__em_before") + F.coalesce(F.sum("__em_c").over(w), F.lit(0)))
        holds = lambda k: (F.col("__em_cb") <= F.col(k)) & (F.col(k) < F.col("__em_cb") + F.col("__em_c"))
        chosen = hist.filter(holds("__em_k1") | holds("__em_k2"))
        state = chosen.groupBy(*keys).agg(F.min("__em_blo").alias("__em_lo"), F.max("__em_bhi").alias("__em_hi"),
                                          F.min("__em_cb").alias("__em_before"), F.first("__em_k1").alias("__em_k1"),
                                          F.first("__em_k2").alias("__em_k2"))
    # distinct values left in the narrowed range, with counts and absolute positions
    vc = (data.join(meet(state), keys).filter(F.col("__em_v").between(F.col("__em_lo"), F.col("__em_hi")))
          .groupBy(*keys, "__em_v", "__em_before", "__em_k1", "__em_k2").agg(F.count(F.lit(1)).alias("__em_c")))
    w = Window.partitionBy(*keys).orderBy("__em_v").rowsBetween(Window.unboundedPreceding, -1)
    vc = vc.withColumn("__em_cb", F.col("__em_before") + F.coalesce(F.sum("__em_c").over(w), F.lit(0)))
    holds = lambda k: (F.col("__em_cb") <= F.col(k)) & (F.col(k) < F.col("__em_cb") + F.col("__em_c"))
    picked = vc.groupBy(*keys).agg(F.max(F.when(holds("__em_k1"), F.col("__em_v"))).alias("__em_v1"),
                                   F.max(F.when(holds("__em_k2"), F.col("__em_v"))).alias("__em_v2"))
    result = picked.select(*keys, ((F.col("__em_v1") + F.col("__em_v2")) / 2).alias(out))
    return result.drop("__em_all") if not groups else result


def value_count_median(df: DataFrame, groups: list[str], value: str, out: str = "median") -> DataFrame:
    """Exact interpolated median per group from the counts of its distinct values.

    Two shuffles: values are counted map-side first, then a running count over each
    group's distinct values (a streaming window) finds the middle positions.  Made
    for values of limited precision, such as coordinates; where a group may have
    billions of distinct values use ``exact_median``.
    """
    vc = (df.select(*groups, F.col(value).cast("double").alias("__vm_v")).dropna(subset=["__vm_v"])
          .groupBy(*groups, "__vm_v").agg(F.count(F.lit(1)).alias("__vm_c")))
    w = Window.partitionBy(*groups)
    vc = vc.withColumns({
        "__vm_end": F.sum("__vm_c").over(w.orderBy("__vm_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__vm_n": F.sum("__vm_c").over(w)})
    holds = lambda k: (F.col("__vm_end") - F.col("__vm_c") <= k) & (k < F.col("__vm_end"))
    low, high = F.floor((F.col("__vm_n") - 1) / 2), F.floor(F.col("__vm_n") / 2)
    picked = vc.groupBy(*groups).agg(F.max(F.when(holds(low), F.col("__vm_v"))).alias("__vm_a"),
                                     F.max(F.when(holds(high), F.col("__vm_v"))).alias("__vm_b"))
    return picked.select(*groups, ((F.col("__vm_a") + F.col("__vm_b")) / 2).alias(out))


def segment_medians(df: DataFrame, groups: list[str], value: str, min_rows: int, out: str = "median",
                    size: str = "n") -> DataFrame:
    """Rows and exact interpolated median of every group with at least ``min_rows`` rows.

    As ``value_count_median``, but rows without a value count towards a group's size, and the
    sizes come from the same counts: the rows are read once and only their counts are shuffled.
    """
    known = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    vc = (df.select(*groups, known.alias("__sm_v")).groupBy(*groups, "__sm_v").agg(F.count(F.lit(1)).alias("__sm_c")))
    w = Window.partitionBy(*groups)
    own = F.when(F.col("__sm_v").isNotNull(), F.col("__sm_c")).otherwise(F.lit(0))
    vc = vc.withColumns({
        "__sm_end": F.sum(own).over(w.orderBy("__sm_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__sm_n": F.sum(own).over(w), size: F.sum("__sm_c").over(w)}).where(F.col(size) >= min_rows)
    holds = lambda k: (F.col("__sm_end") - own <= k) & (k < F.col("__sm_end"))
    low, high = F.floor((F.col("__sm_n") - 1) / 2), F.floor(F.col("__sm_n") / 2)
    picked = vc.groupBy(*groups).agg(F.first(size).alias(size),
                                     F.max(F.when(holds(low), F.col("__sm_v"))).alias("__sm_a"),
                                     F.max(F.when(holds(high), F.col("__sm_v"))).alias("__sm_b"))
    return picked.select(*groups, size, ((F.col("__sm_a") + F.col("__sm_b")) / 2).alias(out))
