"""Projections, row filters, unions and orderings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE = "node_id"
TIME = "timestamp"
CRITICAL = ["pm25", "pm10", "aqi"]


def select_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def quoted(name: str) -> str:
    """A column name as it must stand in SQL."""
    return "`" + name.replace("`", "``") + "`"


def known(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN becomes NULL in the floating-point columns: both mean that nothing was measured."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)]
    chosen = [c for c in floats if columns is None or c in columns]
    return df.withColumns({c: F.expr(f"CASE WHEN NOT isnan({quoted(c)}) THEN {quoted(c)} END") for c in chosen})


def select_numeric(df: DataFrame, exclude: Sequence[str] = (NODE, TIME, "split")) -> DataFrame:
    return df.select(*[quoted(c) for c in numeric_columns(df, exclude)])


def filter_city(df: DataFrame, city: str, column: str = "City") -> DataFrame:
    """Rows of one city, whatever the case of its name."""
    return df.where(F.lower(F.col(column)) == city.lower())


def filter_node(df: DataFrame, node: str, key: str = NODE) -> DataFrame:
    return df.where(F.col(key) == node)


def drop_null_any(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def drop_null_critical(df: DataFrame) -> DataFrame:
    """Drop rows that lack any of the critical columns present."""
    present = [c for c in CRITICAL if c in df.columns]
    return df.dropna("any", subset=present) if present else df


def drop_null_all(df: DataFrame, columns: Sequence[str] = ("pm25", "pm10")) -> DataFrame:
    """Drop rows that lack every one of the columns."""
    return df.dropna("all", subset=list(columns))


def usable_features(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Candidate columns that exist and hold a value, as rows ``(feature, known)``."""
    present = [c for c in candidates if c in df.columns]
    counts = df.agg(*[F.count(c).alias(c) for c in present])
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("known")) for c in present])
    return counts.select(F.inline(pairs)).where("known > 0")


def union_nodes(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames by column name; a column missing from one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_panel(df: DataFrame, time: str = TIME, key: str = NODE) -> DataFrame:
    return df.orderBy(time, key)


def station_lookup(requests: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Every request with ``found``; one left join, stations are unique by key."""
    known = stations.select(key).distinct().withColumn("found", F.lit(True))
    return requests.join(known, key, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def missing_nodes(expected: DataFrame, actual: DataFrame, key: str = NODE) -> DataFrame:
    """Expected nodes without a single row."""
    return expected.select(key).distinct().join(actual.select(key), key, "left_anti")


def left_join_default(
    nodes: DataFrame, values: DataFrame, key: str = NODE, column: str = "aqi", default: float = 100.0,
) -> DataFrame:
    """Every node with its value, or the default where it has none."""
    return nodes.join(values.select(key, column), key, "left").withColumn(
        column, F.coalesce(F.col(column), F.lit(default))
    )


def rank_stations(df: DataFrame, k: int | None = None, column: str = "aqi", key: str = NODE) -> DataFrame:
    """Nodes by value, highest first; all of them or the top ``k``."""
    ordered = df.orderBy(F.desc(column), key)
    return ordered if k is None else ordered.limit(k)


def pivot_measurements(df: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Long measurements to one row per (timestamp, location), mean per parameter."""
    return (
        df.groupBy("timestamp", "location")
        .pivot("parameter", list(parameters))
        .agg(F.avg("value"))
    )
