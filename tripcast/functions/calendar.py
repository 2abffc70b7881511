"""Calendar features of an hour column."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import (DAYPART_UPPER_EDGES, EVENING_PEAK_HOURS, MORNING_PEAK_HOURS, PEAK_HOURS,
                         SEASON_MONTHS, WEEKEND_PEAK_FIRST_HOUR, WEEKEND_PEAK_LAST_HOUR)


def season_from_month(month) -> Column:
    m = F.col(month) if isinstance(month, str) else month
    expr = None
    for season in ("winter", "spring", "summer"):
        cond = m.isin(SEASON_MONTHS[season])
        expr = F.when(cond, F.lit(season)) if expr is None else expr.when(cond, F.lit(season))
    return expr.otherwise(F.lit("fall"))


def daypart(hour) -> Column:
    """Right-closed hour bins: 0-5, 6-10, 11-15, 16-20, 21-23."""
    h = F.col(hour) if isinstance(hour, str) else hour
    expr = None
    for upper, label in DAYPART_UPPER_EDGES:
        cond = h <= upper
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def _flag(cond: Column) -> Column:
    return cond.cast("int")


def add_time_features(df: DataFrame, time_col: str = "hour_start") -> DataFrame:
    """Year ... minute, Monday=0 weekday, ISO week, season, peaks, cyclic terms, daypart."""
    t = F.col(time_col)
    df = df.withColumns({
        "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t),
        "hour": F.hour(t), "minute": F.minute(t), "day_of_week": F.weekday(t),
    })
    two_pi = 2 * math.pi
    return df.withColumns({
        "is_weekend": _flag(F.col("day_of_week").isin(5, 6)),
        "week_of_year": F.weekofyear(t),
        "season": season_from_month("month"),
        "peak_hour": _flag(F.col("hour").isin(PEAK_HOURS)),
        "morning_peak": _flag(F.col("hour").isin(MORNING_PEAK_HOURS)),
        "evening_peak": _flag(F.col("hour").isin(EVENING_PEAK_HOURS)),
        "weekend_peak": _flag(F.col("day_of_week").isin(5, 6)
                              & F.col("hour").between(WEEKEND_PEAK_FIRST_HOUR, WEEKEND_PEAK_LAST_HOUR)),
        "hour_sin": F.sin(F.lit(two_pi) * F.col("hour") / 24),
        "hour_cos": F.cos(F.lit(two_pi) * F.col("hour") / 24),
        "dow_sin": F.sin(F.lit(two_pi) * F.col("day_of_week") / 7),
        "dow_cos": F.cos(F.lit(two_pi) * F.col("day_of_week") / 7),
        "month_sin": F.sin(F.lit(two_pi) * F.col("month") / 12),
        "month_cos": F.cos(F.lit(two_pi) * F.col("month") / 12),
        "daypart": daypart("hour"),
    })
