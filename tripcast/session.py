"""Session helpers: one place for the settings every job relies on."""
from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the engine assumes. Naive trip times are interpreted in UTC.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of lineage cuts are removed once nothing references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "tripcast",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster ``master`` stays None so spark-submit decides; tests pass
    ``local[N]``.  Shuffle partitions default to Spark's own value unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(BASE_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            conf["spark.driver.memory"] = os.environ.get("TRIPCAST_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Trip times are naive wall-clock values; the engine reads them as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


TARGET_PARTITION_BYTES = 128 * 1024 * 1024
# a shuffle of m map and r reduce tasks has m * r blocks to keep track of
MAX_SHUFFLE_PARTITIONS = 100_000


def size_shuffle_partitions(spark: SparkSession, input_bytes: int,
                            bytes_per_partition: int = TARGET_PARTITION_BYTES) -> int:
    """Size shuffles from the input volume unless the user configured them.

    AQE only coalesces partitions, so the starting count must cover the
    biggest shuffle (the trip-level de-dup): about one partition per
    ``bytes_per_partition`` of input, and at most ``MAX_SHUFFLE_PARTITIONS`` (beyond
    it partitions grow, and sorts spill).  Later, smaller stages are coalesced
    back to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    static = spark.sparkContext.getConf()
    n = max(min(int(input_bytes // bytes_per_partition) + 1, MAX_SHUFFLE_PARTITIONS),
            spark.sparkContext.defaultParallelism)
    if not static.contains("spark.sql.shuffle.partitions"):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    if not static.contains("spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df, path: str | None = None):
    """Cut lineage of a wide table: write it as Parquet in the shared folder and read it back.

    A checkpoint holds whole rows, so every reader decodes all columns; of this copy a
    reader takes only the columns that it uses.
    """
    spark = df.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def short_methods(spark: SparkSession):
    """For plans of very many expressions: the JVM interprets a method of more than 8,000 bytes of code for
    good, so Spark is told not to put a whole stage into a longer one."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    A cluster names it in ``spark.checkpoint.dir``; only in local mode, where the
    driver is the only machine, do we create one of our own when it is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="tripcast-ckpt-", dir=os.environ.get("TRIPCAST_SCRATCH", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_tripcast_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tripcast-py-"), "tripcast_package.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(out)
    sc._tripcast_shipped = True
