"""Write PLANS.md: physical plans of key operators over the tables the batch build writes.

Usage: python tools/plans.py [sf_dir]
"""
from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(df) -> tuple[str, str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    tree = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree_part = tree.split("\n\n(1)")[0]
    nodes = [ln.strip(" :+-|") for ln in tree.split("\n\n(1)")[0].splitlines()]
    count = lambda name: sum(1 for n in nodes if re.match(rf"{name}\s+\(\d+\)", n))
    facts = {
        "shuffles (Exchange)": count("Exchange"),
        "broadcasts": count("BroadcastExchange"),
        "sorts": count("Sort"),
        "window operators": count("Window"),
        "WindowGroupLimit": count("WindowGroupLimit"),
        "aggregates (partial + final)": count("HashAggregate") + count("SortAggregate") + count("ObjectHashAggregate"),
        "scans": count("Scan parquet") + count("Scan ExistingRDD"),
    }
    del plan
    pushed = sorted(set(re.findall(r"PushedFilters: \[[^\]]*\]", tree)))
    schemas = sorted(set(re.findall(r"ReadSchema: struct<[^>]*>", tree)))
    lines = [f"- {k}: {v}" for k, v in facts.items()]
    lines += [f"- `{p}`" for p in pushed] + [f"- `{s}`" for s in schemas]
    return "\n".join(lines), tree_part


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F
    from tripcast.session import get_session
    from tripcast.plans.pipeline import run_pipeline
    from tripcast.sources.fixtures import trip_view
    from tripcast.sources.sinks import read_table
    from tripcast.operators import analysis as A
    from tripcast.operators.clean import clean_trips
    from tripcast.operators.flows import flow_summary
    from tripcast.operators.lags import add_lag_features
    from tripcast.operators.demand import station_hour_demand
    from tripcast.operators.split import temporal_train_calibration_test_split

    spark = get_session("local[8]", shuffle_partitions=16)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tripcast-plans-ckpt-"))
    out = tempfile.mkdtemp(prefix="tripcast-plans-")
    run_pipeline(spark, out, raw=trip_view(spark, sf), train=False)
    fact = lambda cols=None: read_table(spark, f"{out}/station_hour_demand", cols)
    trips = lambda cols=None: read_table(spark, f"{out}/clean_trips", cols)
    stations = read_table(spark, f"{out}/station_metadata")
    cases = [
        ("clean_trips (C1-C11): scan -> one de-dup aggregate (partial + final) -> narrow cleaning",
         clean_trips(trip_view(spark, sf))),
        ("station_hour_demand (A2 + J1): grouping sets, one shuffle; dimension join left to AQE",
         station_hour_demand(trips(), stations)),
        ("add_lag_features (W1-W5, A4-A9): series windows share one (station, rider) shuffle",
         add_lag_features(fact([c for c in fact().columns if not c.startswith(("lag_", "rolling_", "area_l",
                                                                            "area_r", "trend", "historical",
                                                                            "station_hour_m", "area_hour_m",
                                                                            "station_avg", "station_total",
                                                                            "area_avg", "area_total",
                                                                            "cluster_hour", "station_demand",
                                                                            "area_demand"))]))),
        ("station_hotspots (T1): pruned read, rider filter pushed into the scan, partial aggregate, top-k",
         A.station_hotspots(fact(["start_station_id", "start_station_name", "station_lat", "station_lng",
                                  "rider_type", "demand"]), "member", 20)),
        ("flow_summary (A24 + W6): counts + stacked exact coordinate medians, per-group top 30 with a partial window group limit",
         flow_summary(trips(["ride_id", "started_at", "start_station_name", "end_station_name", "end_station_id",
                             "start_lat", "start_lng", "end_lat", "end_lng", "rider_type"]))),
        ("daily_weather_summary (A22): date-partitioned fact, pruned columns",
         A.daily_weather_summary(fact(["hour_start", "rider_type", "demand", "temperature", "precipitation",
                                       "snow", "wind_speed"]))),
        ("temporal split (M1): per-hour counts, no global sort of the fact",
         temporal_train_calibration_test_split(fact(["hour_start", "start_station_id", "rider_type", "demand"]))),
    ]
    parts = ["# Physical plans of key operators\n",
             "Generated by `tools/plans.py` on the tables written by the batch build "
             f"(input `{os.path.basename(sf)}`). AQE may change join strategies at run time.\n"]
    for title, df in cases:
        summary, tree = summarize(df)
        parts.append(f"## {title}\n\n{summary}\n\n```\n{tree.strip()}\n```\n")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
