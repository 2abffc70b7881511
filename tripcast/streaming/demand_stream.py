"""Station-hour demand as a Structured Streaming job (extension of A2).

Trips arrive as files; each is cleaned with the batch rules, de-duplicated on
``ride_id`` within the watermark, exploded into its own rider type plus the
``'all'`` rollup, and counted per one-hour event-time window.  Append mode
emits an hour once the watermark has passed it, with the same numbers the
batch fact has for that hour (batch de-dup keeps the first row by file and
time; the stream keeps the first arrival within the watermark).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.clean import clean_trips

RAW_STRING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id",
    "end_station_name", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
]])


def read_trip_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.schema(schema or RAW_STRING_SCHEMA).load(path)
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return df


def streaming_station_hour(raw_stream: DataFrame, watermark: str = "2 hours") -> DataFrame:
    trips = clean_trips(raw_stream, dedup=False)
    trips = trips.withWatermark("started_at", watermark).dropDuplicatesWithinWatermark(["ride_id"])
    riders = F.explode(F.array(F.col("rider_type"), F.lit("all"))).alias("rider_type")
    exploded = trips.select("started_at", "start_station_id", "ride_id", "duration_min", "trip_distance_miles", riders)
    agg = exploded.groupBy(F.window("started_at", "1 hour"), "start_station_id", "rider_type").agg(
        F.count("ride_id").alias("demand"),
        F.avg("duration_min").alias("avg_duration_min"),
        F.avg("trip_distance_miles").alias("avg_trip_distance_miles"),
    )
    return agg.select(F.col("window.start").alias("hour_start"), "start_station_id", "rider_type", "demand",
                      "avg_duration_min", "avg_trip_distance_miles")


def start_station_hour_stream(spark: SparkSession, source: str, sink: str, checkpoint: str,
                              fmt: str = "parquet", watermark: str = "2 hours", available_now: bool = True,
                              schema: T.StructType | None = None):
    """Run the stream into a parquet sink; ``checkpoint`` must be a shared folder."""
    out = streaming_station_hour(read_trip_stream(spark, source, fmt, schema), watermark)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("path", sink).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
