"""Lag options: row lags vs hour lags on a gap (Q4), fill rules (Q3)."""
import datetime as dt

from pyspark.sql import functions as F

from tripcast.operators.lags import add_lag_features


def _fact(spark, hours, station="S1"):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), station, "all", d, (dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)).weekday(),
             (h % 24), "g1", 0) for h, d in hours]
    return spark.createDataFrame(rows, "hour_start timestamp, start_station_id string, rider_type string, demand long, "
                                       "day_of_week int, hour int, grid_cell string, region_cluster int")


def test_row_lag_vs_hour_lag(spark):
    hours = [(0, 1), (1, 2), (31, 5)]   # a 30-hour gap
    rows = {r["hour_start"].hour + 24 * (r["hour_start"].day - 1): r for r in add_lag_features(_fact(spark, hours)).collect()}
    assert rows[31]["lag_1h"] == 2.0                     # previous row, 30 hours back
    dense = {r["hour_start"].hour + 24 * (r["hour_start"].day - 1): r
             for r in add_lag_features(_fact(spark, hours), densify=True).collect()}
    assert dense[31]["lag_1h"] == 0.0                    # the hour before had no trips
    assert len(dense) == 3                               # spine rows are not returned


def test_single_hour_station_fill(spark):
    fact = _fact(spark, [(0, 4)], "S2").unionByName(_fact(spark, [(0, 1), (1, 1), (2, 1)], "S1"))
    out = {(r["start_station_id"], r["hour_start"].hour): r for r in add_lag_features(fact).collect()}
    # every lag of a station with one hour is null -> global median demand (1.0)
    assert out[("S2", 0)]["lag_1h"] == 1.0 and out[("S2", 0)]["rolling_max_24h"] == 1.0
    prof = {(r["start_station_id"], r["hour_start"].hour): r for r in add_lag_features(fact, fill="profile").collect()}
    assert prof[("S2", 0)]["lag_1h"] == 4.0              # the evident intent: the station's own profile


def test_dense_lags_equal_those_over_rows_of_zero(spark):
    """A long gap costs no rows: the plan has no generator, and the values are those of the full spine."""
    import datetime as dt
    from tripcast.operators.lags import dense_series_features
    start = dt.datetime(2024, 1, 1)
    series = {("A", "all"): {0: 2, 1: 5, 3: 1, 27: 4, 28: 1, 200: 3, 5000: 7}, ("A", "member"): {4: 1},
              ("B", "all"): {h: h % 5 + 1 for h in range(0, 260)}}
    rows = [(s, r, start + dt.timedelta(hours=h), n) for (s, r), own in series.items() for h, n in own.items()]
    df = spark.createDataFrame(rows, "start_station_id string, rider_type string, hour_start timestamp, demand bigint")
    out = df.withColumns(dense_series_features())
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    for r in out.collect():
        own = series[r["start_station_id"], r["rider_type"]]
        h = int((r["hour_start"] - start).total_seconds() // 3600)
        before = [own.get(i, 0) for i in range(min(own), h)]
        mean = lambda n: sum(before[-n:]) / len(before[-n:]) if before else None
        lag = lambda n: float(before[-n]) if len(before) >= n else None
        assert (r["lag_1h"], r["lag_24h"], r["lag_168h"]) == (lag(1), lag(24), lag(168))
        assert [r[f"rolling_mean_{n}h"] for n in (3, 6, 24, 168)] == [mean(n) for n in (3, 6, 24, 168)]
        last = before[-24:]
        assert (r["rolling_max_24h"], r["rolling_min_24h"]) == ((max(last), min(last)) if last else (None, None))


def test_lag_plan_reads_few_columns_of_the_written_fact(spark):
    from tripcast.session import written
    df = written(spark.range(10).selectExpr("id", "id * 2 AS twice", "cast(id AS string) AS text"))
    plan = df.select("twice")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<twice:bigint>" in plan and sorted(r[0] for r in df.select("twice").collect())[-1] == 18
