"""Spatial graph, joins and orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from airpanel.catalog.common import (
    SQL_CATEGORY, SQL_STATIONS, query, rd, rds, readings, scored, sq, sql_readings, stations, table,
    with_sql,
)
from airpanel.catalog.panel import SCORED
from airpanel.functions.aqi import category
from airpanel.functions.geo import haversine_km
from airpanel.operators import graph, rows

ID = ["node_id", "timestamp"]


def _sql_distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"6371 * 2 * asin(sqrt(sin((radians({lat2}) - radians({lat1})) / 2) ** 2 + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * sin((radians({lon2}) - radians({lon1})) / 2) ** 2))"
    )


PAIR = _sql_distance("a.lat", "a.lon", "b.lat", "b.lon")


def _sql_edges(within: float, loops: bool = True) -> str:
    own = "" if loops else "WHERE a.node_id <> b.node_id"
    return f"""pairs AS (SELECT a.node_id AS src, b.node_id AS dst,
               CASE WHEN a.node_id = b.node_id THEN 0 ELSE {PAIR} END AS distance_km
             FROM stations a, stations b {own}),
    edges AS (SELECT *, exp(-(distance_km ** 2) / 50.0) AS weight FROM pairs WHERE distance_km <= {within})"""


CENTRE = ("18.52::DOUBLE", "73.85::DOUBLE")


@query("haversine_km", with_sql(SQL_STATIONS, select=f"""
    SELECT node_id, {sq(_sql_distance('lat', 'lon', *CENTRE))} AS km FROM stations"""))
def _(spark, sf):
    km = haversine_km("lat", "lon", "18.52D", "73.85D")
    return stations(spark, sf).select("node_id", rd(km).alias("km"))


@query("distance_pairs", with_sql(SQL_STATIONS, _sql_edges(25), select=f"""
    SELECT src, dst, {sq('distance_km')} AS distance_km FROM edges"""))
def _(spark, sf):
    return graph.distance_pairs(stations(spark, sf), 25.0).withColumn("distance_km", rd("distance_km"))


@query("adjacency_edges", with_sql(SQL_STATIONS, _sql_edges(10), select=f"""
    SELECT src, dst, {sq('distance_km')} AS distance_km, {sq('weight')} AS weight FROM edges"""))
def _(spark, sf):
    out = graph.adjacency_edges(stations(spark, sf))
    return out.select("src", "dst", *rds(["distance_km", "weight"]))


@query("edge_index", with_sql(SQL_STATIONS, _sql_edges(10, False), """
    places AS (SELECT node_id, row_number() OVER (ORDER BY node_id) - 1 AS i FROM stations)""", select=f"""
    SELECT s.i AS source, t.i AS target, {sq('weight')} AS weight FROM edges e
    JOIN places s ON s.node_id = e.src JOIN places t ON t.node_id = e.dst WHERE weight > 0"""))
def _(spark, sf):
    s = stations(spark, sf)
    out = graph.edge_index(graph.adjacency_edges(s, self_loop=False), graph.station_index(s))
    return out.withColumn("weight", rd("weight"))


@query("node_degree", with_sql(SQL_STATIONS, _sql_edges(10), select=f"""
    SELECT src, {sq('sum(weight)')} AS degree FROM edges GROUP BY 1"""))
def _(spark, sf):
    return graph.node_degree(graph.adjacency_edges(stations(spark, sf))).withColumn("degree", rd("degree"))


DEGREE = "degree AS (SELECT src, sum(weight) AS d FROM edges GROUP BY 1)"
SYMMETRIC = "weight / sqrt((a.d + 1e-8) * (b.d + 1e-8))"
NORMAL = f"normal AS (SELECT e.src, e.dst, {SYMMETRIC} AS weight, weight / (a.d + 1e-8) AS by_row " \
    "FROM edges e JOIN degree a ON a.src = e.src JOIN degree b ON b.src = e.dst)"


@query("normalize_edges", with_sql(SQL_STATIONS, _sql_edges(10), DEGREE, NORMAL, select=f"""
    SELECT 'symmetric' AS kind, src, dst, {sq('weight')} AS weight FROM normal
    UNION ALL SELECT 'row', src, dst, {sq('by_row')} FROM normal"""))
def _(spark, sf):
    edges = graph.adjacency_edges(stations(spark, sf))
    both = [
        graph.normalize_edges(edges, symmetric=kind == "symmetric").withColumn("kind", F.lit(kind))
        for kind in ("symmetric", "row")
    ]
    return both[0].union(both[1]).select("kind", "src", "dst", rd("weight").alias("weight"))


@query("graph_aggregate", with_sql(SCORED, SQL_STATIONS, _sql_edges(10), DEGREE, NORMAL, select=f"""
    SELECT n.src AS node_id, timestamp, {sq('sum(weight * aqi)')} AS aqi_neighbours
    FROM normal n JOIN scored s ON s.node_id = n.dst GROUP BY 1, 2"""))
def _(spark, sf):
    edges = graph.normalize_edges(graph.adjacency_edges(stations(spark, sf)))
    out = graph.graph_aggregate(scored(spark, sf).select(*ID, "aqi"), edges)
    return out.withColumn("aqi_neighbours", rd("aqi_neighbours"))


@query("station_lookup", with_sql(SQL_STATIONS, """
    requests AS (SELECT printf('N%02d', user_id) AS station_id, count(*) AS requests FROM events GROUP BY 1)""", select="""
    SELECT station_id, requests, CASE WHEN station_id IN (SELECT node_id FROM stations) THEN 1 ELSE 0 END AS found FROM requests"""))
def _(spark, sf):
    station = F.format_string("N%02d", "user_id").alias("station_id")
    requests = table(spark, sf, "events").groupBy(station).agg(F.count(F.lit(1)).alias("requests"))
    known = stations(spark, sf).withColumnRenamed("node_id", "station_id")
    return rows.station_lookup(requests, known).withColumn("found", F.col("found").cast("int"))


@query("missing_nodes", with_sql(sql_readings(), SQL_STATIONS, select="""
    SELECT node_id FROM stations EXCEPT SELECT node_id FROM readings"""))
def _(spark, sf):
    return rows.missing_nodes(stations(spark, sf), readings(spark, sf))


@query("sort_panel", with_sql(sql_readings(), select="SELECT timestamp, node_id, pm25 FROM readings ORDER BY 1, 2"))
def _(spark, sf):
    return rows.sort_panel(readings(spark, sf).select("timestamp", "node_id", "pm25"))


MEANS = "means AS (SELECT node_id, avg(aqi) AS aqi FROM scored GROUP BY 1)"


@query("rank_stations", with_sql(SCORED, SQL_STATIONS, MEANS, select=f"""
    SELECT name, node_id, {sq('aqi')} AS aqi, {SQL_CATEGORY.format('aqi')} AS category
    FROM means JOIN stations USING (node_id) ORDER BY aqi DESC, node_id LIMIT 5"""))
def _(spark, sf):
    means = scored(spark, sf).groupBy("node_id").agg(F.avg("aqi").alias("aqi"))
    top = rows.rank_stations(means.join(stations(spark, sf), "node_id"), 5)
    return top.select("name", "node_id", rd("aqi").alias("aqi"), category("aqi").alias("category"))
