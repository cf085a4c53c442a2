"""Sources and sinks: each query writes the derived table in a file format and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from airpanel.catalog.common import (
    ALL, MEASURES, ORACLES, SQL_STATIONS, query, rd, rds, readings, scored, sq, sql_readings, sqs, stations,
    table, with_sql,
)
from airpanel.catalog.forecasts import comparison
from airpanel.catalog.graphs import _sql_edges
from airpanel.catalog.panel import SPLIT
from airpanel.catalog.statistics import LEVELS
from airpanel.operators import graph, scaling, splits
from airpanel.session import new_path
from airpanel.sources import files

ID = ["node_id", "timestamp"]
R = sql_readings()
STATION_FIELDS = [*MEASURES, "temperature", "humidity", "wind_speed"]


def _text(c="timestamp", pattern="yyyy-MM-dd HH:mm:ss"):
    return F.date_format(c, pattern)


@query("read_station_csv", with_sql(R, select=f"""
    SELECT timestamp, node_id AS station_id, {', '.join(STATION_FIELDS)}, wind_direction AS wind_dir FROM readings"""))
def _(spark, sf):
    path = new_path(spark, "stations")
    header = {new: old for old, new in files.STATION_HEADERS.items()}
    r = readings(spark, sf).withColumnRenamed("wind_direction", "wind_dir")
    # Otherwise each task of the write would leave a file of a few rows for each station.
    files.spread_by_month(r).select(
        F.concat("node_id", F.lit(".csv")).alias("file"), _text().alias(header["timestamp"]),
        *[F.col(c).alias(header[c]) for c in [*STATION_FIELDS, "wind_dir"]],
    ).write.partitionBy("file").csv(path, header=True)
    return files.read_station_csv(spark, f"{path}/file=*.csv")


DAYS = "SELECT event_type AS City, CAST(ts AS DATE) AS Date, max(value) AS pm25, min(value) AS aqi FROM events GROUP BY 1, 2"


@query("read_city_day_csv", f"""
    SELECT CAST(Date AS TIMESTAMP) AS timestamp, pm25, aqi FROM ({DAYS}) WHERE lower(City) = 'view'""")
def _(spark, sf):
    path = new_path(spark, "cities")
    e = table(spark, sf, "events")
    days = e.groupBy(F.initcap("event_type").alias("City"), F.to_date("ts").alias("Date")).agg(
        F.max("value").alias("PM2.5"), F.min("value").alias("AQI")
    )
    days.write.csv(path, header=True)
    return files.read_city_day_csv(spark, path, "view")


@query("read_weather_json", with_sql(R, select="""
    SELECT node_id, timestamp, temperature, humidity, pm25 AS precipitation, wind_speed, wind_direction, pm10 AS pressure
    FROM readings"""))
def _(spark, sf):
    path = new_path(spark, "weather")
    source = {"precipitation": "pm25", "pressure": "pm10"}
    r = readings(spark, sf).withColumn("time", _text(pattern="yyyy-MM-dd'T'HH:mm"))
    # One document per node and day: its lists hold at most 24 hours.
    hours = F.sort_array(F.collect_list(F.struct("time", *[
        F.col(source.get(name, name)).alias(f) for f, name in files.WEATHER_FIELDS.items() if f != "time"
    ])))
    docs = r.groupBy("node_id", F.to_date("timestamp").alias("day")).agg(hours.alias("h"))
    docs.select(
        "node_id", F.struct(*[F.col("h")[f].alias(f) for f in files.WEATHER_FIELDS]).alias("hourly")
    ).write.json(path, ignoreNullFields=False)
    return files.read_weather_json(spark, path, lines=True)


@query("read_measurements_json", """
    SELECT date_trunc('second', ts) AS timestamp, 'L' || (event_id // 100) AS location, event_type AS parameter, value,
           'ug/m3' AS unit FROM events""")
def _(spark, sf):
    path = new_path(spark, "measurements")
    e = table(spark, sf, "events")
    result = F.struct(
        F.struct(_text("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("utc")).alias("date"),
        F.col("event_type").alias("parameter"), "value", F.lit("ug/m3").alias("unit"),
    )
    # Pages of a hundred events, as a paged service answers.
    page = F.concat(F.lit("L"), F.floor(F.col("event_id") / 100).cast("string"))
    e.groupBy(page.alias("name")).agg(F.collect_list(result).alias("results")).write.json(path)
    return files.read_measurements_json(spark, path, lines=True)


@query("read_node_csvs", with_sql(R, select="SELECT timestamp, node_id, pm25, pm10, no2, so2, co, o3 FROM readings"))
def _(spark, sf):
    path = new_path(spark, "nodes")
    files.write_node_csv(readings(spark, sf).select(*ID, *MEASURES), path)
    return files.read_node_csvs(spark, path)


@query("write_node_csv", with_sql(R, select="SELECT node_id, count(*) AS rows, max(pm25) AS pm25 FROM readings GROUP BY 1"))
def _(spark, sf):
    path = new_path(spark, "nodes")
    files.write_node_csv(readings(spark, sf).select(*ID, *MEASURES), path)
    back = files.read_node_csvs(spark, path, ordered=False)
    return back.groupBy("node_id").agg(F.count(F.lit(1)).alias("rows"), F.max("pm25").alias("pm25"))


@query("read_nodes_json", with_sql(SQL_STATIONS, select=f"""
    SELECT node_id, name, {sqs(['lat', 'lon'])}, 'supplier' AS characteristic FROM stations"""))
def _(spark, sf):
    path = new_path(spark, "stations")
    node = F.struct(
        F.col("node_id").alias("id"), "name", "lat", "lon", F.lit("supplier").alias("characteristic")
    )
    # Lists of at most a hundred stations, numbered by the name's key.
    part = F.floor(F.regexp_extract("name", r"(\d+)$", 1).cast("bigint") / 100)
    docs = stations(spark, sf).groupBy(part.alias("part")).agg(F.collect_list(node).alias("nodes"))
    docs.select("nodes").write.json(path)
    out = files.read_nodes_json(spark, path, lines=True)
    return out.select("node_id", "name", *rds(["lat", "lon"]), "characteristic")


@query("cached_parquet", with_sql(R, select="SELECT * FROM readings"))
def _(spark, sf):
    path = new_path(spark, "cache")
    files.cached_parquet(spark, path, lambda: readings(spark, sf))
    return files.cached_parquet(spark, path, lambda: readings(spark, sf).limit(0))


@query("write_processed", with_sql(R, select="SELECT * FROM readings"))
def _(spark, sf):
    path = new_path(spark, "processed")
    files.write_processed(readings(spark, sf), path)
    return spark.read.parquet(path).select(*ID, *ALL)


def _split(spark, sf):
    return splits.chrono_split(scored(spark, sf).select(*ID, *LEVELS))


@query("save_split", with_sql(SPLIT, select="SELECT node_id, timestamp, split FROM parts"))
def _(spark, sf):
    path = new_path(spark, "split")
    splits.save_split(_split(spark, sf), path)
    return splits.load_split(spark, path).select(*ID, "split")


@query("save_scaler", with_sql(SPLIT, select="SELECT " + ", ".join(
    f"{sq(f'min({c})')} AS {c}_shift, {sq(f'CASE WHEN max({c}) = min({c}) THEN 1 ELSE max({c}) - min({c}) END')} AS {c}_scale"
    for c in LEVELS) + " FROM parts WHERE split = 'train'"))
def _(spark, sf):
    path = new_path(spark, "scaler")
    scaling.save_scaler(scaling.fit_minmax(_split(spark, sf).where("split = 'train'"), LEVELS), path)
    back = scaling.load_scaler(spark, path)
    return back.select(*rds(back.columns))


@query("save_graph", with_sql(SQL_STATIONS, _sql_edges(10), select=f"""
    SELECT src, dst, {sq('weight')} AS weight, name, 'suppliers' AS meta FROM edges JOIN stations ON node_id = src"""))
def _(spark, sf):
    path = new_path(spark, "graph")
    s = stations(spark, sf)
    graph.save_graph(graph.adjacency_edges(s), s, path, {"origin": "suppliers"})
    back = graph.load_graph(spark, path)
    named = back["edges"].join(back["nodes"].withColumnRenamed("node_id", "src"), "src")
    meta = back["meta"].where("name = 'meta_origin'").select("value").scalar()
    return named.select("src", "dst", rd("weight").alias("weight"), "name", meta.alias("meta"))


@query("write_comparison", ORACLES["comparison_table"])
def _(spark, sf):
    path = new_path(spark, "comparison")
    files.write_comparison(comparison(spark, sf), path)
    return spark.read.csv(path, header=True)
