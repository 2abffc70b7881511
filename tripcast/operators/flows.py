"""Origin-destination flows."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import FLOW_TOP_PER_GROUP
from ..functions.geo import area_label
from .stats import value_count_median

GROUP = ["day_of_week", "hour", "rider_type"]
PAIR = ["start_station_name", "end_station_name"]
COORDS = ["start_lat", "start_lng", "end_lat", "end_lng"]


def _with_medians(data: DataFrame, flows: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the exact median of the four coordinates of each flow's trips.

    The coordinates are stacked into one column so a single median job serves all four.
    """
    stacked = data.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("coord"), F.col(c).cast("double").alias("coord_value")) for c in COORDS
    ])).alias("_p")).select(*keys, "_p.coord", "_p.coord_value")
    med = value_count_median(stacked, keys + ["coord"], "coord_value", "_m").groupBy(*keys).agg(
        *[F.max(F.when(F.col("coord") == c, F.col("_m"))).alias(c) for c in COORDS])
    return flows.join(med, keys, "left").select(*keys, "flow_count", *COORDS)


def _ranked_top(flows: DataFrame, top_per_group: int) -> DataFrame:
    """row_number by count desc, ties by names; the ``<= k`` filter lets Spark
    insert a partial per-partition top-k before the shuffle (window group limit)."""
    w = Window.partitionBy(*GROUP).orderBy(F.desc("flow_count"), *PAIR)
    return flows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= top_per_group).drop("_rank")


def flow_summary(trips: DataFrame, top_per_group: int = FLOW_TOP_PER_GROUP, with_all: bool = True,
                 require_end_station_id: bool = True) -> DataFrame:
    """A24 (with_all=True) / A25 (with_all=False, end-station id not required).

    Flow counts per (weekday, hour, rider, start, end) with median coordinates.
    The 'all' rider rows are sums of the riders' counts.  Flows are ranked on their
    counts first; only trips of the flows that stay (at most ``top_per_group`` per
    weekday, hour and rider) go on to the medians.
    """
    need = (["end_station_id"] if require_end_station_id else []) + ["end_station_name", "end_lat", "end_lng"]
    data = trips.dropna(subset=need).withColumns({
        "hour": F.hour("started_at"), "day_of_week": F.weekday("started_at")})
    data = data.dropna(subset=PAIR + ["rider_type"])
    time_pair = ["day_of_week", "hour", *PAIR]
    counts = data.groupBy(*GROUP, *PAIR).agg(F.count("ride_id").alias("flow_count"))
    if with_all:
        both = counts.groupBy(*time_pair).agg(F.sum("flow_count").alias("flow_count"))
        counts = counts.unionByName(both.withColumn("rider_type", F.lit("all")))
    top = _ranked_top(counts, top_per_group)
    wanted = top.select(*time_pair, F.col("rider_type").alias("_rider"))
    own = data.select(*time_pair, "rider_type", *COORDS).join(wanted, time_pair)
    own = own.filter(F.col("_rider").isin("all") | (F.col("_rider") == F.col("rider_type"))) if with_all else \
        own.filter(F.col("_rider") == F.col("rider_type"))
    own = own.drop("rider_type").withColumnRenamed("_rider", "rider_type")
    return _with_medians(own, top, GROUP + PAIR)


def flows_for_hour(flow_table: DataFrame, day_of_week: int, hour: int, rider_type: str = "all",
                   top_k: int = FLOW_TOP_PER_GROUP) -> DataFrame:
    """Published flows of one (weekday, hour); a rider missing from the table falls back to 'all'."""
    has_rider = flow_table.filter(F.col("rider_type") == rider_type).select(
        F.count(F.lit(1)) > 0).scalar()
    chosen = F.when(has_rider, F.lit(rider_type)).otherwise(F.lit("all"))
    return (flow_table.filter((F.col("day_of_week") == day_of_week) & (F.col("hour") == hour)
                              & (F.col("rider_type") == chosen))
            .orderBy(F.desc("flow_count"), *PAIR).limit(top_k))


def predict_flow_trends(trips: DataFrame, day_of_week: int, hour: int, rider_type: str = "all",
                        area: str | None = None, top_k: int = FLOW_TOP_PER_GROUP) -> DataFrame:
    """Flows of trips at the same weekday and hour as a scenario, top k."""
    data = trips.withColumns({"hour": F.hour("started_at"), "day_of_week": F.weekday("started_at")})
    if area:
        if "area_label" not in data.columns:
            data = data.withColumn("area_label", area_label("start_lat", "start_lng"))
        data = data.filter(F.col("area_label") == area)
    if rider_type != "all":
        data = data.filter(F.col("rider_type") == rider_type)
    data = data.filter((F.col("hour") == hour) & (F.col("day_of_week") == day_of_week))
    data = data.dropna(subset=["end_station_id"]).dropna(subset=PAIR)
    top = data.groupBy(*PAIR).agg(F.count("ride_id").alias("flow_count")).orderBy(F.desc("flow_count"), *PAIR).limit(top_k)
    own = data.join(top.select(*PAIR), PAIR, "left_semi")
    return _with_medians(own, top, PAIR).orderBy(F.desc("flow_count"), *PAIR)
