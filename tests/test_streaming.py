"""The streaming fact equals the batch fact for every hour the watermark has closed."""
import os

from pyspark.sql import functions as F

from tripcast.operators.clean import clean_trips
from tripcast.operators.demand import station_hour_counts
from tripcast.sources.fixtures import trip_view
from tripcast.streaming.demand_stream import start_station_hour_stream


def test_stream_matches_batch(spark, tmp_dir):
    raw = trip_view(spark, "/root/testdata/sf0.001").withColumns(
        {c: F.col(c).cast("string") for c in ["started_at", "ended_at", "start_lat", "start_lng", "end_lat", "end_lng"]})
    src = os.path.join(tmp_dir, "src")
    raw.repartition(4).write.parquet(src)
    q = start_station_hour_stream(spark, src, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"),
                                  schema=raw.drop("source_file").schema)
    q.awaitTermination(300)
    streamed = spark.read.parquet(os.path.join(tmp_dir, "sink"))
    batch = station_hour_counts(clean_trips(raw))
    last = streamed.agg(F.max("hour_start")).first()[0]
    assert last is not None
    cols = ["hour_start", "start_station_id", "rider_type", "demand"]
    b = {tuple(r) for r in batch.filter(F.col("hour_start") <= last).select(*cols).collect()}
    s = {tuple(r) for r in streamed.select(*cols).collect()}
    assert s == b
