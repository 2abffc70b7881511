"""Raw trip CSV sources.

Files are listed through the Hadoop FileSystem API (metadata only), grouped by
their header line, and each group is read by Spark with an all-string schema
named by the normalised header; groups are combined with ``unionByName``.
Sampling is a per-file window with a constant upper limit, so Spark applies a
partial per-partition limit before any shuffle.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..constants import RAW_EXCLUDE_PARTS, REQUIRED_RAW_COLUMNS


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def discover_csv_files(spark: SparkSession, raw_dir: str, exclude=RAW_EXCLUDE_PARTS) -> list[str]:
    """Every ``*.csv`` under ``raw_dir``, skipping generated folders, ``._*`` and ``__MACOSX``; sorted."""
    fs, root = _fs(spark, raw_dir)
    root_str = fs.makeQualified(root).toString().rstrip("/")
    it = fs.listFiles(root, True)
    found = []
    while it.hasNext():
        status = it.next()
        full = status.getPath().toString()
        name = status.getPath().getName()
        if not name.endswith(".csv") or name.startswith("._"):
            continue
        rel_parts = full[len(root_str):].strip("/").split("/")
        if set(rel_parts) & set(exclude) or "__MACOSX" in rel_parts:
            continue
        found.append(full)
    return sorted(found)


def total_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Sum of file lengths (listing metadata only)."""
    total = 0
    for path in paths:
        fs, p = _fs(spark, path)
        total += int(fs.getFileStatus(p).getLen())
    return total


def normalize_column(name: str) -> str:
    """Strip, lower, spaces and '-' to '_'."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def _header_line(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine() or ""
    finally:
        stream.close()
    return line.lstrip("﻿")


def _split_header(line: str) -> list[str]:
    return [c.strip().strip('"') for c in re.split(r',(?=(?:[^"]*"[^"]*")*[^"]*$)', line)]


def load_trip_csvs(spark: SparkSession, paths: list[str], required=REQUIRED_RAW_COLUMNS) -> DataFrame:
    """S3 + S4 + U2: read all files as strings with normalised names and ``source_file``.

    Files sharing a header are read together; a file missing required
    columns raises an error naming them.
    """
    if not paths:
        raise FileNotFoundError("No raw trip CSV files found.")
    groups: dict[tuple, list[str]] = {}
    for path in paths:
        names = tuple(normalize_column(c) for c in _split_header(_header_line(spark, path)))
        missing = sorted(set(required) - set(names))
        if missing:
            raise ValueError(f"{path} is missing expected columns: {missing}")
        groups.setdefault(names, []).append(path)
    frames = []
    for names, group in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        df = (spark.read.option("header", True).option("enforceSchema", True).option("multiLine", False)
              .schema(schema).csv(group))
        frames.append(df.withColumns({
            "source_file": F.col("_metadata.file_name"),
            "_file_path": F.col("_metadata.file_path"),
            "_file_start": F.col("_metadata.file_block_start"),
        }))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _line_order() -> list:
    """Order of lines inside a file: split start, then position within the split."""
    return [F.col("_file_start"), F.monotonically_increasing_id()]


def head_rows_per_file(raw: DataFrame, n: int) -> DataFrame:
    """The first ``n`` data rows of every file."""
    w = Window.partitionBy("_file_path").orderBy(*_line_order())
    return raw.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def _sample_order(key: str, seed: int) -> list:
    """Seeded order of rows that other engines can repeat: md5 of key and seed, then the key."""
    return [F.md5(F.concat(F.col(key), F.lit(f":{seed}"))), F.col(key)]


def sample_per_file(raw: DataFrame, k: int, seed: int = 42, key: str = "ride_id") -> DataFrame:
    """``k`` rows per file chosen by a seeded hash -- reproducible (Q1); whole file if smaller."""
    w = Window.partitionBy("_file_path").orderBy(*_sample_order(key, seed))
    return raw.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def balanced_quotas(paths: list[str], total: int) -> list[tuple[str, int]]:
    """``total // files`` each (at least 1), the remainder to the first files in order."""
    base = max(total // len(paths), 1)
    remainder = total % len(paths)
    return [(p, base + (1 if i < remainder else 0)) for i, p in enumerate(paths)]


def balanced_sample(raw: DataFrame, paths: list[str], total: int, seed: int = 42, key: str = "ride_id") -> DataFrame:
    """Per-file quotas applied to the seeded per-file ranking (quota table: one row per file)."""
    quotas = balanced_quotas(paths, total)
    spark = raw.sparkSession
    table = spark.createDataFrame(quotas, "_file_path string, _quota int")  # one row per input file
    top = max(q for _, q in quotas)
    w = Window.partitionBy("_file_path").orderBy(*_sample_order(key, seed))
    ranked = raw.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= top)
    return (ranked.join(F.broadcast(table), "_file_path", "left")
            .filter(F.col("_rn") <= F.coalesce(F.col("_quota"), F.lit(top))).drop("_rn", "_quota"))


def drop_file_columns(df: DataFrame) -> DataFrame:
    """Keeps the file's full path as ``source_path``: the first of two equal rides goes by it."""
    return df.drop("_file_start").withColumnRenamed("_file_path", "source_path")


def read_trips(spark: SparkSession, raw_dir: str | None = None, paths: list[str] | None = None,
               sample_rows: int | None = None, sample_rows_per_file: int | None = None,
               total_sample_rows: int | None = None, seed: int = 42) -> DataFrame:
    """Discover + load + optional sampling, the source step of the batch build."""
    paths = paths or discover_csv_files(spark, raw_dir)
    raw = load_trip_csvs(spark, paths)
    if total_sample_rows:
        raw = balanced_sample(raw, paths, total_sample_rows, seed)
    elif sample_rows_per_file:
        raw = sample_per_file(raw, sample_rows_per_file, seed)
    elif sample_rows:
        raw = head_rows_per_file(raw, sample_rows)
    return drop_file_columns(raw)
