"""Weather categories, levels, sentences and chart bins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import (RAIN_EDGES, RAIN_LABELS, SNOW_EDGES, SNOW_LABELS, TEMPERATURE_EDGES,
                         TEMPERATURE_LABELS, WEATHER_BIN_EDGES, WEATHER_BIN_LABELS, WIND_EDGES,
                         WIND_LABELS)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _missing(v: Column) -> Column:
    return v.isNull() | F.isnan(v)


def _upper_closed(v, edges, outputs) -> Column:
    """outputs[0] for missing or <= edges[0]; then <= each edge; last otherwise."""
    v = _c(v)
    expr = F.when(_missing(v) | (v <= edges[0]), F.lit(outputs[0]))
    for edge, out in zip(edges[1:], outputs[1:]):
        expr = expr.when(v <= edge, F.lit(out))
    return expr.otherwise(F.lit(outputs[-1]))


def _lower_closed(v, edges, outputs) -> Column:
    """outputs[0] for missing; then < each edge; last otherwise."""
    v = _c(v)
    expr = F.when(_missing(v), F.lit(outputs[0]))
    for edge, out in zip(edges, outputs[1:]):
        expr = expr.when(v < edge, F.lit(out))
    return expr.otherwise(F.lit(outputs[-1]))


def rain_intensity(v) -> Column:
    return _upper_closed(v, RAIN_EDGES, RAIN_LABELS)


def rain_level(v) -> Column:
    return _upper_closed(v, RAIN_EDGES, list(range(len(RAIN_LABELS))))


def snow_intensity(v) -> Column:
    return _upper_closed(v, SNOW_EDGES, SNOW_LABELS)


def snow_level(v) -> Column:
    return _upper_closed(v, SNOW_EDGES, list(range(len(SNOW_LABELS))))


def wind_intensity(v) -> Column:
    return _lower_closed(v, WIND_EDGES, WIND_LABELS)


def wind_level(v) -> Column:
    return _lower_closed(v, WIND_EDGES, list(range(len(WIND_LABELS))))


def temperature_band(v) -> Column:
    return _lower_closed(v, TEMPERATURE_EDGES, TEMPERATURE_LABELS)


def temperature_level(v) -> Column:
    return _lower_closed(v, TEMPERATURE_EDGES, list(range(len(TEMPERATURE_LABELS))))


def add_weather_categories(df: DataFrame) -> DataFrame:
    """Add label + level for each weather input column that is present."""
    cols = set(df.columns)
    new = {}
    if "precipitation" in cols:
        new["rain_intensity"] = rain_intensity("precipitation")
        new["rain_level"] = rain_level("precipitation")
    if "snow" in cols:
        new["snow_intensity"] = snow_intensity("snow")
        new["snow_level"] = snow_level("snow")
    if "wind_speed" in cols:
        new["wind_intensity"] = wind_intensity("wind_speed")
        new["wind_level"] = wind_level("wind_speed")
    if "temperature" in cols:
        new["temperature_band"] = temperature_band("temperature")
        new["temperature_level"] = temperature_level("temperature")
    return df.withColumns(new) if new else df


def describe_weather(temperature, precipitation, snow, wind_speed) -> Column:
    """Sentence of the four labels joined by '; ' (F18)."""
    return F.concat_ws("; ", temperature_band(temperature), rain_intensity(precipitation),
                       snow_intensity(snow), wind_intensity(wind_speed))


def weather_bin(v, weather_col: str) -> Column:
    """Fixed-edge chart bin: right-closed, lowest edge included, outside -> null."""
    v = _c(v)
    edges = WEATHER_BIN_EDGES[weather_col]
    labels = WEATHER_BIN_LABELS[weather_col]
    expr = F.when(v.isNull() | F.isnan(v) | (v < edges[0]) | (v > edges[-1]), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        expr = expr.when(v <= edge, F.lit(label))
    return expr


def weather_bin_order(weather_col: str, bin_col) -> Column:
    """Position of a fixed bin label, for sorting chart rows."""
    labels = WEATHER_BIN_LABELS[weather_col]
    return F.array_position(F.array(*[F.lit(x) for x in labels]), _c(bin_col)).cast("int")
