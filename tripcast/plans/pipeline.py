"""Batch build (entry 1) and artifact rebuild.

Each published table is written once and later stages read it back, so a lost
executor only re-runs the current stage, and the ~15 outputs derived from the
fact never recompute the trip scan.
"""
from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import DEFAULT_CONTEXT_HOURS
from ..operators import analysis as A
from ..operators import evaluation as EV
from ..operators.clean import clean_trips
from ..operators.flows import flow_summary
from ..operators.stations import station_metadata
from ..sources.holidays import holiday_table, read_holiday_table, save_holiday_table
from ..sources.sinks import path_exists, read_table, write_csv_copy, write_fact, write_small_csv, write_table
from ..sources.trips import read_trips
from ..sources.weather import read_weather_csv
from .facts import enriched_area_hour, enriched_station_hour
from .training import save_models


def _p(out_dir: str, name: str) -> str:
    return os.path.join(out_dir, name)


def run_pipeline(spark: SparkSession, out_dir: str, raw_dir: str | None = None, paths: list[str] | None = None,
                 raw: DataFrame | None = None, sample_rows: int | None = None,
                 sample_rows_per_file: int | None = None, total_sample_rows: int | None = None,
                 weather_path: str | None = None, holiday_path: str | None = None,
                 max_train_rows: int | None = None, fast_models: bool = False,
                 selection_metric: str = "combined", train_rider_models: bool = True, train: bool = True,
                 app_recent_hours: int | None = DEFAULT_CONTEXT_HOURS) -> dict:
    """clean -> dimension -> fact -> enrich -> rollups -> publish -> train -> summary."""
    if holiday_path:
        holidays = read_holiday_table(spark, holiday_path)
    else:
        holidays = holiday_table(spark)
        save_holiday_table(spark, _p(out_dir, "holidays"))
    if raw is None:
        from ..session import size_shuffle_partitions
        from ..sources.trips import discover_csv_files, total_bytes
        paths = paths or discover_csv_files(spark, raw_dir)
        size_shuffle_partitions(spark, total_bytes(spark, paths))
        raw = read_trips(spark, raw_dir, paths, sample_rows, sample_rows_per_file, total_sample_rows)
    write_table(clean_trips(raw), _p(out_dir, "clean_trips"))
    trips = read_table(spark, _p(out_dir, "clean_trips"))

    stations = station_metadata(trips)
    write_table(stations, _p(out_dir, "station_metadata"))
    stations = read_table(spark, _p(out_dir, "station_metadata"))
    write_small_csv(stations, _p(out_dir, "station_metadata_csv"))

    weather, kind = None, "daily"
    if weather_path:
        kind, weather = read_weather_csv(spark, weather_path)
    # every column is stored, so the base fact is worth writing once
    fact = enriched_station_hour(trips, holidays, weather, kind, stations=stations, cut_lineage=True)
    write_fact(fact, _p(out_dir, "station_hour_demand"))
    fact = read_table(spark, _p(out_dir, "station_hour_demand")).drop("date")

    write_fact(enriched_area_hour(fact, holidays), _p(out_dir, "area_hour_demand"))
    area = read_table(spark, _p(out_dir, "area_hour_demand")).drop("date")
    write_csv_copy(fact, _p(out_dir, "station_hour_demand_csv"))
    write_csv_copy(area, _p(out_dir, "area_hour_demand_csv"))

    publish_app_artifacts(spark, out_dir, fact, area, trips, app_recent_hours, with_all_flows=True)
    write_small_csv(A.rider_type_summary(trips), _p(out_dir, "app_rider_summary"))

    result = {"out_dir": out_dir}
    if train:
        from .training import train_models
        res = train_models(fact, max_train_rows=max_train_rows, fast=fast_models,
                           selection_metric=selection_metric, train_rider_models=train_rider_models)
        publish_training(spark, out_dir, res)
        result["best_model_name"] = res["best_model_name"]
    summary = A.run_summary(raw, trips, stations, fact, area, len(paths) if paths else None)
    write_small_csv(summary, _p(out_dir, "pipeline_summary"))
    result["summary"] = summary.first().asDict()
    return result


def publish_app_artifacts(spark: SparkSession, out_dir: str, fact: DataFrame, area: DataFrame,
                          trips: DataFrame | None, recent_hours: int | None, with_all_flows: bool = True) -> None:
    write_table(A.station_context(fact, recent_hours), _p(out_dir, "app_station_context"))
    write_table(A.station_map_hour(fact), _p(out_dir, "app_station_map_hour"))
    write_table(A.area_map_hour(area), _p(out_dir, "app_area_map_hour"))
    write_table(area, _p(out_dir, "app_area_hour"))
    write_table(A.demand_pattern(fact, "hour"), _p(out_dir, "app_hourly_patterns"))
    write_table(A.demand_pattern(fact, "is_weekend"), _p(out_dir, "app_weekday_patterns"))
    write_table(A.demand_pattern(fact, "is_holiday"), _p(out_dir, "app_holiday_patterns"))
    write_table(A.top_station_summary(fact), _p(out_dir, "app_top_station_summary"))
    if trips is not None:
        flows = flow_summary(trips, with_all=with_all_flows, require_end_station_id=with_all_flows)
        write_table(flows, _p(out_dir, "app_flow_summary"))


def publish_training(spark: SparkSession, out_dir: str, res: dict) -> None:
    write_small_csv(res["metrics"].orderBy("MAE", "model"), _p(out_dir, "evaluation_metrics"))
    write_small_csv(res["ranking"].orderBy("combined_rank_score", "MAE", "model"), _p(out_dir, "model_selection_ranking"))
    write_small_csv(res["top3"], _p(out_dir, "evaluation_metrics_top3"))
    write_small_csv(res["best_summary"], _p(out_dir, "best_model_summary"))
    write_small_csv(res["hotspot"].orderBy(F.desc("hotspot_f1")), _p(out_dir, "hotspot_classification_metrics"))
    write_small_csv(_split_summary(res["split"]), _p(out_dir, "model_split_summary"))
    write_table(res["backtest"], _p(out_dir, "prediction_backtest"))
    write_small_csv(spark.createDataFrame(res["feature_importance"] or [("none", 0.0)],
                                          "feature string, importance double"), _p(out_dir, "feature_importance"))
    if res.get("rider_metrics") is not None:
        write_small_csv(res["rider_metrics"], _p(out_dir, "rider_specific_model_metrics"))
    write_small_csv(EV.metric_explanations(spark), _p(out_dir, "metric_explanations"))
    best = res["models"][res["best_model_name"]]
    save_models(_p(out_dir, "models"), best, res.get("rider_models", {}))
    config = {"categorical": best.cats, "numeric": best.nums, "features": best.cats + best.nums,
              "best_model": res["best_model_name"], "prediction_cap": res["prediction_cap"],
              "blend_weights": {n: m.blend_weight for n, m in res["models"].items()}}
    spark.createDataFrame([(json.dumps(config),)], "config string").coalesce(1) \
        .write.mode("overwrite").text(_p(out_dir, "models/feature_columns"))


def _split_summary(split: DataFrame) -> DataFrame:
    from ..operators.split import split_summary
    return split_summary(split)


#: app tables by name: (inputs, how to make them from the inputs, how they are written)
def _app_tables(recent_hours: int | None) -> dict:
    fact, area, trips = ("station_hour_demand",), ("area_hour_demand",), ("clean_trips",)
    return {
        "app_station_context": (fact, lambda f: A.station_context(f, recent_hours), write_table),
        "app_station_map_hour": (fact, A.station_map_hour, write_table),
        "app_area_map_hour": (area, A.area_map_hour, write_table),
        "app_area_hour": (area, lambda a: a, write_table),
        "app_hourly_patterns": (fact, lambda f: A.demand_pattern(f, "hour"), write_table),
        "app_weekday_patterns": (fact, lambda f: A.demand_pattern(f, "is_weekend"), write_table),
        "app_holiday_patterns": (fact, lambda f: A.demand_pattern(f, "is_holiday"), write_table),
        "app_top_station_summary": (fact, A.top_station_summary, write_table),
        "app_rider_summary": (fact, A.rider_summary_from_fact, write_small_csv),
        "app_flow_summary": (trips, lambda t: flow_summary(t, with_all=False, require_end_station_id=False), write_table),
    }


_INPUT_COLUMNS = {"clean_trips": ["ride_id", "started_at", "start_station_name", "end_station_name", "start_lat",
                                  "start_lng", "end_lat", "end_lng", "rider_type"]}


def _input(spark: SparkSession, processed_dir: str, name: str) -> DataFrame:
    from ..operators.enrich import ensure_area_label
    df = read_table(spark, _p(processed_dir, name), _INPUT_COLUMNS.get(name)).drop("date")
    return ensure_area_label(df) if name == "station_hour_demand" else df


def input_fingerprint(spark: SparkSession, path: str) -> str:
    """Names one state of a stored table: its files with their lengths and times, from the listing alone."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", "modificationTime"))
    each = F.xxhash64("path", "length", "modificationTime")
    row = files.agg(F.count("*").alias("n"), F.sum("length").alias("b"), F.bit_xor(each).alias("h")).first()
    return f"{row['n']}-{row['b']}-{row['h']}"


def rebuild_app_artifacts(spark: SparkSession, processed_dir: str,
                          recent_hours: int | None = DEFAULT_CONTEXT_HOURS) -> dict[str, str]:
    """Re-publish the app tables from saved facts, without retraining (flows: A25 variant).

    Every table has its inputs; it is made again only if all of them exist and one has changed
    since, or if the table is missing.  Returns what became of each: ``rebuilt``, ``current`` or
    ``no input``.  The state of a table's inputs is noted only after the table is written.
    """
    tables = _app_tables(recent_hours)
    names = sorted({i for inputs, _, _ in tables.values() for i in inputs})
    state = {i: input_fingerprint(spark, _p(processed_dir, i)) for i in names
             if path_exists(spark, _p(processed_dir, i))}
    done = {}
    for name, (inputs, make, write) in tables.items():
        if any(i not in state for i in inputs):
            done[name] = "no input"
            continue
        now = json.dumps([recent_hours if name == "app_station_context" else None, [state[i] for i in inputs]])
        note = _p(processed_dir, f"rebuild_notes/{name}")
        known = path_exists(spark, note) and path_exists(spark, _p(processed_dir, name))
        if known and spark.read.text(note).first()[0] == now:
            done[name] = "current"
            continue
        write(make(*[_input(spark, processed_dir, i) for i in inputs]), _p(processed_dir, name))
        spark.createDataFrame([(now,)], "state string").coalesce(1).write.mode("overwrite").text(note)
        done[name] = "rebuilt"
    return done


def load_artifacts(spark: SparkSession, processed_dir: str) -> dict:
    """App inputs with fallbacks (context -> full fact; app area -> area fact; patterns recomputed)."""
    from ..sources.sinks import read_first_existing
    read = lambda *names, columns=None: read_first_existing(
        spark, [_p(processed_dir, n) for n in names], columns)
    station = read("app_station_context", "station_hour_demand")
    area = read("app_area_hour", "area_hour_demand")
    if station is None or area is None:
        raise FileNotFoundError("Processed artifacts are missing.")
    pattern_cols = ["hour", "is_weekend", "is_holiday", "rider_type", "area_label", "demand"]
    full = read("station_hour_demand", columns=pattern_cols)
    full = station if full is None else full

    def pattern(name: str, by: str) -> DataFrame:
        found = read(name)
        return A.demand_pattern(full, by) if found is None else found

    rider = _p(processed_dir, "app_rider_summary")
    rider_summary = (spark.read.option("header", True).option("inferSchema", True).csv(rider)
                     if path_exists(spark, rider) else A.rider_summary_from_fact(station))
    top = read("app_top_station_summary")
    return {"station_hour": station, "area_hour": area, "rider_summary": rider_summary,
            "station_map": read("app_station_map_hour"), "area_map": read("app_area_map_hour"),
            "hourly_patterns": pattern("app_hourly_patterns", "hour"),
            "weekday_patterns": pattern("app_weekday_patterns", "is_weekend"),
            "holiday_patterns": pattern("app_holiday_patterns", "is_holiday"),
            "top_stations": A.top_station_summary(station) if top is None else top,
            "flow": read("app_flow_summary")}


def write_scored(predictions: DataFrame, areas: DataFrame, out_dir: str) -> None:
    """Scored stations and area totals of a scenario, as the app exports them."""
    write_small_csv(predictions, _p(out_dir, "predicted_stations"))
    write_small_csv(areas, _p(out_dir, "predicted_areas"))
