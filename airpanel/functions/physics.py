"""Wind, weather interactions and limits of measured values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def clamp_nonneg(c: str) -> Column:
    """Values below zero become zero; NULL and NaN become NULL. ``c`` is a name or SQL expression."""
    return F.expr(f"CASE WHEN isnan({c}) THEN NULL WHEN ({c}) < 0 THEN 0D ELSE ({c}) END")


def null_negatives(c: str) -> Column:
    """Values below zero and NaN become NULL."""
    return F.expr(f"CASE WHEN ({c}) >= 0 AND NOT isnan({c}) THEN ({c}) END")


def wind_vectors(columns: list[str]) -> dict[str, Column]:
    """East and north wind components; nothing when a column is absent."""
    if not {"wind_speed", "wind_direction"} <= set(columns):
        return {}
    return {
        "wind_u": F.expr("wind_speed * sin(radians(wind_direction))"),
        "wind_v": F.expr("wind_speed * cos(radians(wind_direction))"),
    }


def weather_interactions(columns: list[str]) -> dict[str, Column]:
    """Products used as features, each only when its inputs exist."""
    out = {}
    if {"temperature", "humidity"} <= set(columns):
        out["temp_humidity"] = F.expr("temperature * humidity / 100")
    if "wind_speed" in columns:
        out["wind_speed_inv"] = F.expr("1D / (wind_speed + 0.1D)")
    return out
