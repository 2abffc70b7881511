"""Weather sources (S8, S9): hourly or daily CSV, or long NOAA-style rows."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import WEATHER_COLUMNS, WEATHER_DATATYPES, WEATHER_RENAME


def read_weather_csv(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """Return ("hourly", df keyed by hour_start) or ("daily", df keyed by date).

    A ``timestamp`` column means hourly weather and wins over ``date``.
    """
    raw = spark.read.option("header", True).csv(path)
    cols = {c.strip().lower(): c for c in raw.columns}
    values = [F.expr(f"try_cast(`{cols[c]}` AS double)").alias(c) if c in cols
              else F.lit(None).cast("double").alias(c) for c in WEATHER_COLUMNS]
    if "timestamp" in cols:
        ts = F.expr(f"try_to_timestamp(`{cols['timestamp']}`)")
        return "hourly", raw.select(F.date_trunc("hour", ts).alias("hour_start"), *values)
    if "date" in cols:
        d = F.to_date(F.expr(f"try_to_timestamp(`{cols['date']}`)"))
        return "daily", raw.select(d.alias("date"), *values)
    raise ValueError(f"{path}: weather needs a 'timestamp' or 'date' column")


def pivot_long_weather(long_rows: DataFrame, tavg_fallback: str = "global") -> DataFrame:
    """Long (date, datatype, value) rows -> one row per date.

    Mean per (date, datatype); TAVG falls back to (TMAX+TMIN)/2.  ``global``:
    only when TAVG is null on every row (its column would be absent);
    ``per_row``: wherever TAVG is null.
    """
    wide = (long_rows.withColumn("date", F.to_date("date"))
            .groupBy("date").pivot("datatype", WEATHER_DATATYPES).agg(F.avg("value")))
    fallback = (F.col("TMAX") + F.col("TMIN")) / 2
    if tavg_fallback == "per_row":
        temperature = F.coalesce(F.col("TAVG"), fallback)
    else:
        # one global flag, evaluated once as a scalar subquery
        any_tavg = wide.select(F.max(F.col("TAVG").isNotNull().cast("int"))).scalar()
        temperature = F.when(F.coalesce(any_tavg, F.lit(0)) == 1, F.col("TAVG")).otherwise(fallback)
    return wide.select(
        "date",
        temperature.alias(WEATHER_RENAME["TAVG"]),
        F.col("PRCP").alias(WEATHER_RENAME["PRCP"]),
        F.col("SNOW").alias(WEATHER_RENAME["SNOW"]),
        F.col("AWND").alias(WEATHER_RENAME["AWND"]),
    )
