"""Demand tier labels."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import DEMAND_TIER_TOP, DEMAND_TIER_UNKNOWN, DEMAND_TIERS


def demand_tier(value) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    expr = F.when(v.isNull() | F.isnan(v), F.lit(DEMAND_TIER_UNKNOWN))
    for bound, label in DEMAND_TIERS:
        expr = expr.when(v < bound, F.lit(label))
    return expr.otherwise(F.lit(DEMAND_TIER_TOP))
