"""Geographic column expressions (haversine, grid cell, area label)."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import AREA_BOXES, EARTH_RADIUS_MILES, GRID_SIZE_DEGREES, OTHER_AREA


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_miles(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in miles; null when any input is null."""
    la1, lo1, la2, lo2 = (F.radians(_col(c)) for c in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(a))


def grid_cell(lat, lng, size: float = GRID_SIZE_DEGREES) -> Column:
    """``floor(lat/size)_floor(lng/size)`` computed in double arithmetic."""
    size_col = F.lit(float(size))
    lat_bin = F.floor(_col(lat).cast("double") / size_col).cast("bigint").cast("string")
    lng_bin = F.floor(_col(lng).cast("double") / size_col).cast("bigint").cast("string")
    return F.concat(lat_bin, F.lit("_"), lng_bin)


def area_label(lat, lng) -> Column:
    """Area from overlapping boxes; a later box wins, so test them in reverse."""
    lat, lng = _col(lat), _col(lng)
    expr = None
    for name, lat_lo, lat_hi, lng_lo, lng_hi in reversed(AREA_BOXES):
        cond = lat.between(lat_lo, lat_hi) & lng.between(lng_lo, lng_hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_AREA))
