"""Column-level feature functions: take and return ``Column``s, no UDFs."""
from .geo import area_label, grid_cell, haversine_miles
from .calendar import add_time_features, daypart, season_from_month
from .weather import (add_weather_categories, describe_weather, rain_intensity, rain_level,
                      snow_intensity, snow_level, temperature_band, temperature_level,
                      weather_bin, wind_intensity, wind_level)
from .tiers import demand_tier

__all__ = [
    "area_label", "grid_cell", "haversine_miles", "add_time_features", "daypart",
    "season_from_month", "add_weather_categories", "describe_weather", "rain_intensity",
    "rain_level", "snow_intensity", "snow_level", "temperature_band", "temperature_level",
    "weather_bin", "wind_intensity", "wind_level", "demand_tier",
]
