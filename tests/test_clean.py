"""Cleaning rules on small edge tables (string input, as from CSV)."""
from tripcast.operators.clean import clean_trips

COLS = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id",
        "end_station_name", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual",
        "source_file"]


def _row(rid, start="2024-01-01 08:00:00", end="2024-01-01 08:10:00", lat="40.7", lng="-74.0",
         elat="40.71", elng="-74.01", member=" Member ", src="a.csv", sid="S1", rtype=" Classic_Bike "):
    return (rid, rtype, start, end, "Name", sid, "End", "E1", lat, lng, elat, elng, member, src)


def _clean(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLS))
    return {r["ride_id"]: r for r in clean_trips(df).collect()}


def test_coercion_and_required(spark):
    got = _clean(spark, [
        _row("ok"), _row("badtime", start="bad"), _row("badlat", lat="bad"), _row("nolat", lat=None),
        _row("nomember", member=None), _row("badend", elat="bad"),
    ])
    assert set(got) == {"ok", "badend"}          # bad end coordinate -> null end, still kept
    assert got["ok"]["rider_type"] == "member" and got["ok"]["rideable_type"] == "classic_bike"
    assert got["badend"]["trip_distance_miles"] is None


def test_duration_inclusive(spark):
    got = _clean(spark, [
        _row("one", end="2024-01-01 08:01:00"), _row("under", end="2024-01-01 08:00:59"),
        _row("day", end="2024-01-02 08:00:00"), _row("over", end="2024-01-02 08:00:01"),
    ])
    assert set(got) == {"one", "day"}
    assert got["one"]["duration_min"] == 1.0 and got["day"]["duration_min"] == 1440.0


def test_coordinate_box(spark):
    got = _clean(spark, [
        _row("lat_edge", lat="41.2"), _row("lat_out", lat="41.2001"), _row("lng_edge", lng="-75.0"),
        _row("lng_out", lng="-75.0001"), _row("end_null", elat=None, elng=None), _row("end_out", elat="39.9"),
    ])
    assert set(got) == {"lat_edge", "lng_edge", "end_null"}


def test_dedup_first_kept_before_filters(spark):
    got = _clean(spark, [
        _row("d", start="2024-01-01 08:00:00", end="2024-01-01 08:10:00"),
        _row("d", start="2024-01-01 09:00:00", end="2024-01-01 09:20:00"),
        # first copy is outside the box: both disappear (dedup runs before the filters)
        _row("e", start="2024-01-01 07:00:00", lat="39.0"),
        _row("e", start="2024-01-01 07:30:00"),
    ])
    assert set(got) == {"d"}
    assert got["d"]["duration_min"] == 10.0
    assert str(got["d"]["hour_start"]) == "2024-01-01 08:00:00"
