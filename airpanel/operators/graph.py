"""Spatial graph as an edge list; never a dense matrix."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, product

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.functions.clock import hour_index
from airpanel.functions.geo import haversine_km, sphere_cells
from airpanel.operators.chunks import CHUNK, chunk_of, global_index

EPSILON = 1e-8
THRESHOLD_KM = 10.0
SIGMA_KM = 5.0
#: Stations of a grid cell that one task compares.
CROWD = 1000


def near_pairs(
    stations: DataFrame, within_km: float = THRESHOLD_KM, key: str = "node_id", crowd: int = CROWD,
) -> DataFrame:
    """Ordered pairs of different stations within a distance, as (src, dst, distance_km).

    Stations meet by equality on the cell of a grid through the globe: one side
    stays in its cell, the other is sent to its own cell and half of the cells
    around it, so every pair meets once and is mirrored afterwards. A cell with
    more than ``crowd`` stations is split over as many tasks as it asks for.
    """
    cells = ["_cx", "_cy", "_cz"]
    at = [e.alias(c) for c, e in zip(cells, sphere_cells("lat", "lon", within_km))]
    own = stations.select(F.expr(f"{key} AS _id"), "lat", "lon", *at)
    parts = own.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / crowd).cast("int").alias("_parts"))
    left = own.join(parts, cells).select(
        *cells, F.expr("_id AS src"), F.expr("lat AS _lat1"), F.expr("lon AS _lon1"),
        F.expr("CAST(pmod(xxhash64(_id), _parts) AS INT) AS _part"),
    )
    half = [d for d in product((-1, 0, 1), repeat=3) if d >= (0, 0, 0)]
    to = ", ".join(
        "struct(" + ", ".join(f"{c} - {x} AS {c}" for c, x in zip(cells, d)) + f", {str(d == (0, 0, 0)).lower()} AS _same)"
        for d in half
    )
    right = own.selectExpr("_id AS dst", "lat AS _lat2", "lon AS _lon2", f"inline(array({to}))")
    right = right.join(parts, cells).withColumn("_part", F.expr("explode(sequence(0, _parts - 1))"))
    distance = haversine_km("_lat1", "_lon1", "_lat2", "_lon2")
    once = (
        left.join(right, [*cells, "_part"])
        .where("NOT _same OR src < dst")
        .select("src", "dst", distance.alias("distance_km"))
        .where(F.col("distance_km") <= within_km)
    )
    ends = "inline(array(struct(src, dst, distance_km), struct(dst AS src, src AS dst, distance_km)))"
    return once.selectExpr(ends)


def distance_pairs(stations: DataFrame, within_km: float, key: str = "node_id") -> DataFrame:
    """Distances of all ordered pairs within a radius, with 0 for a station and itself."""
    own = stations.select(F.col(key).alias("src"), F.col(key).alias("dst"),
                          F.lit(0.0).alias("distance_km"))
    return near_pairs(stations, within_km, key).union(own)


def adjacency_edges(
    stations: DataFrame, threshold_km: float = THRESHOLD_KM, sigma: float = SIGMA_KM,
    self_loop: bool = True, key: str = "node_id",
) -> DataFrame:
    """Edges (src, dst, distance_km, weight), weight falling with squared distance."""
    pairs = distance_pairs(stations, threshold_km, key) if self_loop else near_pairs(
        stations, threshold_km, key
    )
    return pairs.withColumn("weight", F.expr(f"exp(-(distance_km * distance_km) / {2.0 * sigma * sigma}D)"))


def station_index(stations: DataFrame, key: str = "node_id") -> DataFrame:
    """Stations with their place in key order."""
    return global_index(stations.select(key), [key])


def edge_index(edges: DataFrame, index: DataFrame, key: str = "node_id") -> DataFrame:
    """Edges of positive weight by station number."""
    source = index.select(F.col(key).alias("src"), F.col("index").alias("source"))
    target = index.select(F.col(key).alias("dst"), F.col("index").alias("target"))
    return (
        edges.where("weight > 0").join(source, "src").join(target, "dst")
        .select("source", "target", "weight")
    )


def node_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src").agg(F.sum("weight").alias("degree"))


def normalize_edges(edges: DataFrame, symmetric: bool = True) -> DataFrame:
    """Weights divided by the degrees of both ends, or of the source only."""
    degree = node_degree(edges)
    out = edges.join(degree, "src")
    scale = F.col("degree") + F.lit(EPSILON)
    if symmetric:
        other = degree.select(F.col("src").alias("dst"), F.col("degree").alias("_other"))
        out = out.join(other, "dst")
        scale = F.sqrt(scale * (F.col("_other") + F.lit(EPSILON)))
    return out.select("src", "dst", (F.col("weight") / scale).alias("weight"))


def graph_aggregate(
    readings: DataFrame, edges: DataFrame, column: str = "aqi",
    key: str = "node_id", time: str = "timestamp", spread: int = 16, size: int = CHUNK,
) -> DataFrame:
    """Weighted sum over the neighbours of each node at each time.

    Rows flow along edges and are summed per (receiver, time). A node's history is dealt over
    ``spread`` tasks by stretches of ``size`` hours and its edges are copied to them, so that
    a node with most of all rows is no task of its own.
    """
    stretch = F.pmod(chunk_of("_h", size), F.lit(spread)).cast("int")
    rows = readings.select(F.col(key).alias("dst"), time, column).withColumn("_h", hour_index(time)).withColumn("_stretch", stretch)
    copies = edges.select("src", "dst", "weight", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("_stretch"))
    return rows.join(copies, ["dst", "_stretch"]).groupBy(F.col("src").alias(key), time).agg(
        F.sum(F.col("weight") * F.col(column)).alias(f"{column}_neighbours")
    )


def correlation_edges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absolute correlation of every pair of columns, 1 with itself, as edges.

    One pass: the pairs are aggregates over the columns of a row, not joins.
    """
    names = list(columns)
    aggs = [F.abs(F.corr(a, b)).alias(f"{a}|{b}") for a, b in combinations(names, 2)]
    row = df.agg(*aggs)
    cells = [F.struct(F.lit(a).alias("src"), F.lit(a).alias("dst"), F.lit(1.0).alias("weight"))
             for a in names]
    for a, b in combinations(names, 2):
        for s, d in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(s).alias("src"), F.lit(d).alias("dst"),
                                  F.col(f"`{a}|{b}`").alias("weight")))
    return row.select(F.inline(F.array(*cells)))


def save_graph(edges: DataFrame, nodes: DataFrame, path: str, meta: dict[str, str] | None = None) -> None:
    """Edges, station names and metadata as three tables under ``path``."""
    edges.write.mode("overwrite").parquet(f"{path}/edges")
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    rows = [(f"meta_{k}", str(v)) for k, v in (meta or {}).items()]
    spark = edges.sparkSession
    spark.createDataFrame(rows, "name string, value string").write.mode("overwrite").parquet(
        f"{path}/meta"
    )


def load_graph(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    try:
        return {name: spark.read.parquet(f"{path}/{name}") for name in ("edges", "nodes", "meta")}
    except AnalysisException as e:
        raise FileNotFoundError(f"no graph at {path}") from e
