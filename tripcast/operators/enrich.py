"""Holiday and weather enrichment."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import WEATHER_COLUMNS
from ..functions.geo import area_label
from ..functions.weather import add_weather_categories

def add_holiday_features(df: DataFrame, holidays: DataFrame | None, time_col: str = "hour_start") -> DataFrame:
    """``is_holiday`` = date in calendar, ``is_pre_holiday`` = next day in calendar.

    Without a calendar both flags are 0.
    """
    if holidays is None:
        return df.withColumns({"is_holiday": F.lit(0), "is_pre_holiday": F.lit(0)})
    dates = holidays.select(F.col("date").alias("_hday")).dropna().distinct()
    day = F.to_date(F.col(time_col))
    out = (df.withColumn("_day", day)
           .join(dates.withColumnRenamed("_hday", "_h1"), F.col("_day") == F.col("_h1"), "left")
           .join(dates.withColumnRenamed("_hday", "_h2"), F.date_add(F.col("_day"), 1) == F.col("_h2"), "left"))
    return out.withColumns({
        "is_holiday": F.col("_h1").isNotNull().cast("int"),
        "is_pre_holiday": F.col("_h2").isNotNull().cast("int"),
    }).drop("_day", "_h1", "_h2")


def merge_weather(df: DataFrame, weather: DataFrame | None, kind: str = "daily",
                  duplicates: str = "mean") -> DataFrame:
    """Join weather on the hour (hourly) or the date (daily), then add categories.

    Several readings of one hour or date give their mean (of the values there are),
    so each fact row stays one row and the input's order does not matter;
    ``duplicates="all"`` keeps a row for each reading, as a plain left join does.

    ``weather=None`` gives null weather columns and no category columns, as the
    reference does when no weather file is given.
    """
    if duplicates not in ("mean", "all"):
        raise ValueError("duplicates is 'mean' or 'all'")
    base = df.drop(*[c for c in WEATHER_COLUMNS if c in df.columns])
    if weather is None:
        return base.withColumns({c: F.lit(None).cast("double") for c in WEATHER_COLUMNS})
    values = [F.col(c).cast("double").alias(c) for c in WEATHER_COLUMNS]
    own, key = ((F.col("hour_start"), F.col("hour_start")) if kind == "hourly" else
                (F.to_date("date"), F.to_date(F.col("hour_start"))))
    w = weather.select(own.alias("_wkey"), *values).dropna(subset=["_wkey"])
    if duplicates == "mean":
        w = w.groupBy("_wkey").agg(*[F.avg(c).alias(c) for c in WEATHER_COLUMNS])
    merged = base.join(w, key == F.col("_wkey"), "left").drop("_wkey")
    return add_weather_categories(merged)


def ensure_area_label(df: DataFrame) -> DataFrame:
    """Back-fill ``area_label`` from station or start coordinates (C14)."""
    if "area_label" in df.columns:
        return df
    if {"station_lat", "station_lng"} <= set(df.columns):
        return df.withColumn("area_label", area_label("station_lat", "station_lng"))
    if {"start_lat", "start_lng"} <= set(df.columns):
        return df.withColumn("area_label", area_label("start_lat", "start_lng"))
    return df
