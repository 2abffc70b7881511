"""Trip cleaning (C1-C11) and first-kept de-duplication."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..constants import (COORDINATE_COLUMNS, LAT_MAX, LAT_MIN, LNG_MAX, LNG_MIN, MAX_TRIP_HOURS,
                         MIN_TRIP_MINUTES, NOT_NULL_COLUMNS, TEXT_COLUMNS)
from ..functions.geo import haversine_miles


def _as_timestamp(df: DataFrame, name: str):
    """Bad text -> null (C1).  Typed timestamps pass through."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return F.expr(f"try_to_timestamp(`{name}`)")
    if isinstance(dtype, (T.TimestampType,)):
        return F.col(name)
    return F.col(name).cast("timestamp")


def _strip(c):
    """Python-style strip of surrounding whitespace."""
    return F.regexp_replace(F.col(c), r"^\s+|\s+$", "")


def keep_first(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """One row per ``key``: the smallest by ``order_by`` (then the other columns).

    Expressed as ``min(struct(...))`` so the map side already collapses repeats
    of a key: a key repeated in a third of all rows costs one row per map task,
    not one giant group in a single task.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    ordered = order_by + rest
    packed = F.struct(*[F.col(c) for c in ordered])
    first = df.groupBy(key).agg(F.min(packed).alias("_first"))
    return first.select(key, *[F.col(f"_first.{c}").alias(c) for c in ordered]).select(*df.columns)


def clean_trips(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Raw trips -> clean trips, in the reference's order of steps.

    parse times -> drop nulls in required columns -> first-kept de-dup on
    ride_id -> numeric coordinates -> coordinate box -> duration filter ->
    normalised text, distance and hour.
    """
    df = raw.withColumns({c: _as_timestamp(raw, c) for c in ("started_at", "ended_at")})
    df = df.dropna(subset=NOT_NULL_COLUMNS)
    if dedup:
        order = [c for c in ("source_path", "source_file", "started_at", "ended_at") if c in df.columns]
        df = keep_first(df, "ride_id", order)
    df = df.drop("source_path")
    df = df.withColumns({c: F.expr(f"try_cast(`{c}` AS double)") for c in COORDINATE_COLUMNS})
    df = df.dropna(subset=["start_lat", "start_lng"])
    lat_ok = lambda c: F.col(c).between(LAT_MIN, LAT_MAX)
    lng_ok = lambda c: F.col(c).between(LNG_MIN, LNG_MAX)
    df = df.filter(lat_ok("start_lat") & lng_ok("start_lng")
                   & (F.col("end_lat").isNull() | lat_ok("end_lat"))
                   & (F.col("end_lng").isNull() | lng_ok("end_lng")))
    micros = F.unix_micros("ended_at") - F.unix_micros("started_at")
    df = df.withColumn("duration_min", micros.cast("double") / F.lit(60_000_000.0))
    df = df.filter(F.col("duration_min").between(MIN_TRIP_MINUTES, MAX_TRIP_HOURS * 60))
    df = df.withColumns({
        "rider_type": F.lower(_strip("member_casual")),
        "rideable_type": F.lower(_strip("rideable_type")),
    })
    df = df.withColumns({c: F.col(c).cast("string") for c in TEXT_COLUMNS if c in df.columns})
    return df.withColumns({
        "trip_distance_miles": haversine_miles("start_lat", "start_lng", "end_lat", "end_lng"),
        "hour_start": F.date_trunc("hour", "started_at"),
    })
