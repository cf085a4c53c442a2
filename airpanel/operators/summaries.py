"""Small aggregate tables over a panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.operators.chunks import NODE, TIME


def series_range(df: DataFrame, column: str = "aqi", time: str = TIME) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(time).alias("first"), F.max(time).alias("last"),
        F.min(column).alias("lowest"), F.max(column).alias("highest"),
        F.avg(column).alias("mean"),
    )


def node_means(df: DataFrame, base: str, column: str = "aqi", key: str = NODE) -> DataFrame:
    """Mean per node and its difference to the mean of a base node."""
    means = df.groupBy(key).agg(F.avg(column).alias("mean"))
    of_base = df.where(F.col(key) == base).agg(F.avg(column)).scalar()
    return means.withColumn("difference", F.col("mean") - of_base)
