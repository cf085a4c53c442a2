"""Tables behind the service and the map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.functions.aqi import (
    category, category_banded, category_color, clamp_aqi, health_advisory,
)
from airpanel.operators.rows import left_join_default

MAX_HORIZON = 72


def explode_forecast(df: DataFrame, horizon: int | None = None) -> DataFrame:
    """One row per forecast hour of (station_id, model, base_time, values ARRAY<DOUBLE>).

    All hours of the array, or the first ``horizon`` if a request asks for so many.
    Values are clipped to the index range; the category is taken before rounding.
    """
    if horizon is not None and not 1 <= horizon <= MAX_HORIZON:
        raise ValueError(f"horizon must lie in 1..{MAX_HORIZON}")
    rows = df.select(
        "station_id", "model", "base_time",
        F.round(clamp_aqi("get(values, 0)"), 1).alias("current_aqi"),
        F.posexplode("values" if horizon is None else F.slice("values", 1, horizon)).alias("hour", "_v"),
    )
    rows = rows.withColumn("_v", clamp_aqi("_v")).withColumn("category", category_banded("_v"))
    return rows.select(
        "station_id", "model", "hour",
        F.timestamp_add("HOUR", F.col("hour"), F.col("base_time")).alias("timestamp"),
        F.round("_v", 1).alias("aqi"),
        "category",
        category_color(service=True).alias("color"),
        "current_aqi",
    )


def heatmap_points(nodes: DataFrame, values: DataFrame, key: str = "node_id") -> DataFrame:
    """One marker per node, whether it has a value or not."""
    points = left_join_default(nodes, values, key).withColumn("category", category("aqi"))
    return points.select(
        key, "lat", "lon", "aqi", "category",
        category_color().alias("color"),
        health_advisory().alias("advisory"),
        F.expr("least(25D, greatest(8D, 8 + aqi / 500 * 17)) AS radius"),
        F.expr("aqi / 500 AS intensity"),
    )


def station_dim(stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Every station with the number of all stations."""
    total = stations.agg(F.count(F.lit(1))).scalar()
    return stations.withColumn("count", total)
