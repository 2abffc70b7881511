"""Station dimension (A1), clustering (A30) and display helpers."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..constants import CLUSTER_SEED, MAX_CLUSTERS
from ..functions.geo import area_label, grid_cell


def station_metadata(trips: DataFrame, one_name_per_id: bool = True, n_clusters: int = MAX_CLUSTERS,
                     cluster: bool = True) -> DataFrame:
    """Median coordinates and trip count per station, with grid, area and cluster.

    The reference keys the table by (id, name) but joins it on id only, so a
    renamed station duplicates fact rows (Q9).  Default: one row per id, the
    name with most trips (then the smaller name).  ``one_name_per_id=False``
    keeps one row per (id, name).
    """
    from .stats import value_count_median
    keys = ["start_station_id", "start_station_name"]
    named = trips.dropna(subset=keys)
    # a station may hold a large share of all trips: medians from the counts of its distinct coordinates
    # lat and lng stacked into one column so one median job serves both
    coords = F.explode(F.array(F.struct(F.lit("lat").alias("coord"), F.col("start_lat").alias("coord_value")),
                               F.struct(F.lit("lng").alias("coord"), F.col("start_lng").alias("coord_value"))))
    stacked = named.select(*keys, coords.alias("_p")).select(*keys, "_p.coord", "_p.coord_value")
    med = value_count_median(stacked, keys + ["coord"], "coord_value", "_m").groupBy(*keys).agg(
        F.max(F.when(F.col("coord") == "lat", F.col("_m"))).alias("station_lat"),
        F.max(F.when(F.col("coord") == "lng", F.col("_m"))).alias("station_lng"))
    per_name = (named.groupBy(*keys).agg(F.count("ride_id").alias("trips")).join(med, keys)
                .select(*keys, "station_lat", "station_lng", "trips"))
    if one_name_per_id:
        w = Window.partitionBy("start_station_id").orderBy(F.desc("trips"), F.asc("start_station_name"))
        per_name = per_name.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    out = per_name.withColumns({
        "grid_cell": grid_cell("station_lat", "station_lng"),
        "area_label": area_label("station_lat", "station_lng"),
    })
    if cluster:
        out = cluster_stations(out, n_clusters)
    return out


def cluster_stations(stations: DataFrame, n_clusters: int = MAX_CLUSTERS, seed: int = CLUSTER_SEED) -> DataFrame:
    """KMeans on station coordinates, k = min(n_clusters, stations); < 2 -> cluster 0.

    Cluster ids are renumbered by centre (lat, then lng) so they are stable.
    The station table is one row per station, so this is a small MLlib job.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    from ..session import checkpoint_dir
    checkpoint_dir(stations.sparkSession)
    # Small dimension: materialise once in the shared checkpoint folder so the
    # count, the KMeans passes and the later joins do not rescan the trips.
    stations = stations.checkpoint(eager=True)
    n = stations.count()
    k = min(n_clusters, n)
    if k < 2:
        return stations.withColumn("region_cluster", F.lit(0))
    assembled = VectorAssembler(inputCols=["station_lat", "station_lng"], outputCol="_xy").transform(stations)
    model = KMeans(k=k, seed=seed, featuresCol="_xy").fit(assembled)
    return assign_clusters(stations, sorted((float(c[0]), float(c[1])) for c in model.clusterCenters()))


def assign_clusters(stations: DataFrame, centres: list[tuple[float, float]]) -> DataFrame:
    """``region_cluster``: the place of the nearest centre (lat, lng); of equally near ones the first."""
    lat, lng = F.col("station_lat"), F.col("station_lng")
    far = [(lat - a) * (lat - a) + (lng - b) * (lng - b) for a, b in centres]
    distances = F.array(*far)
    return stations.withColumn("region_cluster", (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


def one_row_per_station(df: DataFrame, order_cols: list[str] | None = None) -> DataFrame:
    """First row per station under a fixed order."""
    order_cols = order_cols or ["hour_start", "rider_type"]
    w = Window.partitionBy("start_station_id").orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def station_display_options(df: DataFrame) -> DataFrame:
    """``id | name | area | lat, lng`` labels, one per station, sorted by name."""
    one = one_row_per_station(df.select("start_station_id", "start_station_name", "area_label",
                                        "station_lat", "station_lng"),
                              ["start_station_name", "area_label", "station_lat", "station_lng"])
    label = F.format_string("%s | %s | %s | %.5f, %.5f", "start_station_id", "start_station_name",
                            "area_label", "station_lat", "station_lng")
    return one.select("start_station_id", "start_station_name", label.alias("label"))
