"""Holiday calendar."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..constants import HOLIDAY_SOURCE, HOLIDAYS

HOLIDAY_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("holiday_name", T.StringType()),
    T.StructField("source", T.StringType()),
])


def holiday_table(spark: SparkSession, rows=None, source: str = HOLIDAY_SOURCE) -> DataFrame:
    rows = HOLIDAYS if rows is None else rows
    df = spark.createDataFrame([(d, n) for d, n in rows], "date string, holiday_name string")
    return df.select(F.to_date("date").alias("date"), "holiday_name", F.lit(source).alias("source"))


def save_holiday_table(spark: SparkSession, path: str, rows=None) -> str:
    holiday_table(spark, rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_holiday_table(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).schema("date string, holiday_name string, source string").csv(path)
    return raw.select(F.to_date("date").alias("date"), "holiday_name", "source")
