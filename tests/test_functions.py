"""Edge tables for the column functions: on, below and above every threshold."""
import math

import pytest
from pyspark.sql import functions as F

from tripcast.functions import (area_label, daypart, demand_tier, grid_cell, haversine_miles, rain_intensity,
                                rain_level, season_from_month, snow_intensity, snow_level, temperature_band,
                                temperature_level, weather_bin, wind_intensity, wind_level)


def _eval(spark, values, fn, dtype="double"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_season(spark):
    assert _eval(spark, list(range(1, 13)), season_from_month, "int") == [
        "winter", "winter", "spring", "spring", "spring", "summer", "summer", "summer", "summer",
        "fall", "fall", "winter"]


def test_daypart_right_closed(spark):
    hours = [0, 5, 6, 10, 11, 15, 16, 20, 21, 23]
    assert _eval(spark, hours, daypart, "int") == [
        "overnight", "overnight", "morning", "morning", "midday", "midday", "evening", "evening", "night", "night"]


def test_demand_tier(spark):
    assert _eval(spark, [None, 0.99, 1.0, 2.99, 3.0, 7.99, 8.0], demand_tier) == [
        "unknown", "low", "medium", "medium", "high", "high", "very_high"]


def test_rain_and_snow(spark):
    vals = [None, -1.0, 0.0, 0.01, 2.5, 2.51, 10.0, 10.01]
    assert _eval(spark, vals, rain_intensity) == ["No rain", "No rain", "No rain", "Light rain", "Light rain",
                                                  "Moderate rain", "Moderate rain", "Heavy rain"]
    assert _eval(spark, vals, rain_level) == [0, 0, 0, 1, 1, 2, 2, 3]
    svals = [None, 0.0, 10.0, 10.01, 50.0, 50.01]
    assert _eval(spark, svals, snow_intensity) == ["No snow", "No snow", "Light snow", "Moderate snow",
                                                   "Moderate snow", "Heavy snow"]
    assert _eval(spark, svals, snow_level) == [0, 0, 1, 2, 2, 3]


def test_wind_and_temperature_left_closed(spark):
    wvals = [None, 2.99, 3.0, 7.99, 8.0]
    assert _eval(spark, wvals, wind_intensity) == ["Unknown wind", "Light wind", "Moderate wind",
                                                   "Moderate wind", "Strong wind"]
    assert _eval(spark, wvals, wind_level) == [0, 1, 2, 2, 3]
    tvals = [None, -0.01, 0.0, 9.99, 10.0, 21.99, 22.0]
    assert _eval(spark, tvals, temperature_band) == ["Unknown temperature", "Freezing", "Cold", "Cold",
                                                     "Mild", "Mild", "Hot"]
    assert _eval(spark, tvals, temperature_level) == [0, 1, 2, 2, 3, 3, 4]


def test_weather_bins_edges(spark):
    # right-closed, lowest edge included, outside -> null (Q16: wind 3.0 is "<3 m/s")
    assert _eval(spark, [-31.0, -30.0, -10.0, -9.99, 35.0, 36.0], lambda c: weather_bin(c, "temperature")) == [
        None, "<-10 C", "<-10 C", "-10--5 C", "25-35 C", None]
    assert _eval(spark, [0.0, 3.0, 3.01, 50.0, 51.0], lambda c: weather_bin(c, "wind_speed")) == [
        "<3 m/s", "<3 m/s", "3-8 m/s", ">20 m/s", None]
    assert _eval(spark, [0.0, 0.01, 25.0, 25.01], lambda c: weather_bin(c, "precipitation")) == [
        "0 mm", "0-2.5 mm", "10-25 mm", ">25 mm"]


def test_area_boxes_later_wins(spark):
    df = spark.createDataFrame([(40.75, -74.0), (40.70, -74.025), (40.80, -73.80), (40.0, -75.0), (40.6, -73.9)],
                               "lat double, lng double")
    got = [r[0] for r in df.select(area_label("lat", "lng")).collect()]
    # (40.75,-74.0): Manhattan box; (40.70,-74.025): Manhattan + Brooklyn + Jersey -> Jersey wins
    assert got == ["Manhattan", "Jersey City / Hoboken", "Bronx", "Other", "Queens"]


def test_grid_double_floor(spark):
    df = spark.createDataFrame([(40.56, -74.09), (40.605000000000004, -73.9)], "lat double, lng double")
    got = [r[0] for r in df.select(grid_cell("lat", "lng")).collect()]
    assert got == [f"{math.floor(40.56 / 0.01)}_{math.floor(-74.09 / 0.01)}",
                   f"{math.floor(40.605000000000004 / 0.01)}_{math.floor(-73.9 / 0.01)}"]


def test_haversine(spark):
    df = spark.createDataFrame([(40.7, -74.0, 40.8, -73.9), (40.7, -74.0, None, None)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_miles("a", "b", "c", "d")).collect()]
    la1, lo1, la2, lo2 = map(math.radians, (40.7, -74.0, 40.8, -73.9))
    h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
    assert got[0] == pytest.approx(2 * 3958.8 * math.asin(math.sqrt(h)), rel=1e-12)
    assert got[1] is None


def test_dynamic_bins_plan_holds_its_input_twice(spark):
    """The statistics stand in the plan once, not in every expression that mentions them."""
    from tripcast.operators.analysis import dynamic_bins
    df = spark.createDataFrame([(v,) for v in [None, 0.0, 1.0, 2.5, 4.0, 10.0]], "v double")
    out = dynamic_bins(df, "v")
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "scalar-subquery" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 2
    rows = {r["v"]: (r["bin_index"], r["bin_lo"], r["bin_hi"], r["bin_label"]) for r in out.collect()}
    assert rows[None][:3] == (None, None, None)
    assert rows[0.0] == (0, -0.01, 2.0, "(-0.010, 2.000]") and rows[10.0] == (4, 8.0, 10.0, "(8.000, 10.000]")
    assert [rows[v][0] for v in (1.0, 2.5, 4.0)] == [0, 1, 1]
