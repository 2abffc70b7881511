"""Sinks and artifact reads.

Facts are written as parquet partitioned by date so later reads prune by day;
small summaries go out as single CSV files.  Reads list their columns so only
those reach the scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_fact(df: DataFrame, path: str, time_col: str = "hour_start") -> str:
    """Parquet partitioned by the date of ``time_col``.

    Rows are dealt by date, and dates too large for one task are split among several.
    """
    (df.withColumn("date", F.to_date(time_col)).hint("rebalance", F.col("date"))
     .write.mode("overwrite").partitionBy("date").parquet(path))
    return path


def write_table(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def write_small_csv(df: DataFrame, path: str) -> str:
    """A small result as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_csv_copy(df: DataFrame, path: str) -> str:
    """The whole table as CSV, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Column-pruned read; Catalyst pushes the projection into the parquet scan."""
    df = spark.read.parquet(path)
    if columns:
        df = df.select(*[c for c in columns if c in df.columns])
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    from .trips import _fs
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_first_existing(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame | None:
    """The first artifact that exists (e.g. context, else the full fact)."""
    for path in paths:
        if path_exists(spark, path):
            return read_table(spark, path, columns)
    return None
