"""Station address cache (S15, S16) as versioned snapshots of a keyed table.

A cache is a folder: ``data/<version>-<id>`` holds the rows of one version, and
``commits/<version>`` names the data folder that the version consists of.  A commit file is
created, never overwritten, by one atomic call of the file system: of two writers that start
from the same version only one gets it, and the other merges again into the newer one.
What is written without a commit is never read, so a writer that fails leaves the last version.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

ADDRESS_SCHEMA = "station_id string, station_name string, lat double, lng double, display_address string"
ATTEMPTS = 20


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of the cache, oldest first (one small file each)."""
    from .trips import _fs
    fs, p = _fs(spark, f"{path}/commits")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p)) if fs.exists(p) else []


def _data_folder(spark: SparkSession, path: str, version: int) -> str:
    return f"{path}/data/" + spark.read.text(f"{path}/commits/{version:012d}").first()[0]


def _commit(spark: SparkSession, path: str, version: int, folder: str) -> bool:
    """Create the commit file; False if the version exists already."""
    from .trips import _fs
    fs, p = _fs(spark, f"{path}/commits/{version:012d}")
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001  (py4j wraps the file system's own exception)
        if fs.exists(p):
            return False
        raise e
    out.write(folder.encode())
    out.close()
    return True


def load_address_cache(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of the latest (or a given) version with their order ``_order``; empty without one."""
    versions = committed_versions(spark, path)
    if not versions:
        return spark.createDataFrame([], ADDRESS_SCHEMA).withColumn("_order", F.lit(0).cast("bigint"))
    folder = _data_folder(spark, path, versions[-1] if version is None else version)
    return spark.read.schema(ADDRESS_SCHEMA + ", _order bigint").parquet(folder)


def latest_addresses(cache: DataFrame) -> DataFrame:
    """One row per station id: the last one written (S15 'last row wins')."""
    latest = cache.groupBy("station_id").agg(F.max_by(F.struct("display_address", "station_name", "lat", "lng"),
                                                      F.col("_order")).alias("_a"))
    return latest.select("station_id", "_a.station_name", "_a.lat", "_a.lng", "_a.display_address")


def attach_addresses(stations: DataFrame, cache: DataFrame, key: str = "start_station_id") -> DataFrame:
    """S15 in batch: left join of station rows to the latest cached address (null when absent)."""
    latest = latest_addresses(cache).select(F.col("station_id").alias("_sid"), "display_address")
    return stations.join(latest, F.col(key).cast("string") == F.col("_sid"), "left").drop("_sid")


def upsert_addresses(spark: SparkSession, path: str, updates: DataFrame) -> int:
    """Drop the old row of each updated station, append the new one, commit a new version.

    Returns the version.  Another writer's commit in between makes this one merge again.
    """
    new = updates.select("station_id", "station_name", "lat", "lng", "display_address")
    for _ in range(ATTEMPTS):
        version = max(committed_versions(spark, path), default=0) + 1
        keep = load_address_cache(spark, path).join(new.select("station_id"), "station_id", "left_anti")
        merged = keep.select(*new.columns, "_order").unionByName(
            new.withColumn("_order", F.lit(version).cast("bigint")))
        folder = f"{version:012d}-{uuid.uuid4().hex}"
        merged.write.parquet(f"{path}/data/{folder}")
        if _commit(spark, path, version, folder):
            return version
    raise RuntimeError(f"{path}: {ATTEMPTS} other writers were faster")


def address_for(cache: DataFrame, station_id: str) -> DataFrame:
    """S15 for one station: its latest address or an empty result."""
    w = Window.partitionBy("station_id").orderBy(F.desc("_order"))
    return (cache.filter(F.col("station_id") == str(station_id)).withColumn("_rn", F.row_number().over(w))
            .filter("_rn = 1").select("display_address"))
