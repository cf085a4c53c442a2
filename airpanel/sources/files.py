"""Station CSV, city CSV, weather and measurement JSON, Parquet tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.functions.clock import hour_index
from airpanel.operators.chunks import CHUNK, chunk_of
from airpanel.operators.rows import filter_city, select_available, sort_panel
from airpanel.session import exists, is_folder, publish, qualified
from airpanel.sources.headered import file_system, read_headered

# Headers of the input files and the names used here.
STATION_HEADERS = {
    "From Date": "timestamp",
    "PM2.5 (ug/m3)": "pm25",
    "PM10 (ug/m3)": "pm10",
    "NO2 (ug/m3)": "no2",
    "SO2 (ug/m3)": "so2",
    "CO (mg/m3)": "co",
    "Ozone (ug/m3)": "o3",
    "RH (%)": "humidity",
    "AT (degree C)": "temperature",
    "WS (m/s)": "wind_speed",
    "WD (degree)": "wind_dir",
}
CITY_HEADERS = {
    "Date": "timestamp",
    "PM2.5": "pm25",
    "PM10": "pm10",
    "NO2": "no2",
    "SO2": "so2",
    "CO": "co",
    "O3": "o3",
    "AQI": "aqi",
}
WEATHER_FIELDS = {
    "time": "timestamp",
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "precipitation": "precipitation",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_direction",
    "pressure_msl": "pressure",
}
STATION_COLUMNS = [
    "timestamp", "station_id", "pm25", "pm10", "no2", "so2", "co", "o3",
    "temperature", "humidity", "wind_speed", "wind_dir",
]
MEASURES = ["aqi", "pm25", "pm10", "no2", "so2", "co", "o3"]


def _number(name: str) -> Column:
    """Text to DOUBLE; bad text and NaN become NULL."""
    value = F.col(f"`{name}`").try_cast("double")
    return F.when(~F.isnan(value), value)


def _wall_clock(name: str) -> Column:
    """Text to a timestamp without zone, year first or day first; bad text becomes NULL."""
    year_first = F.regexp_replace(F.col(f"`{name}`"), r"^\s*(\d{2})[-/.](\d{2})[-/.](\d{4})", "$3-$2-$1")
    return year_first.try_cast("timestamp_ntz")


def _no_such_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def _by_header(
    spark: SparkSession, path: str, wanted: Sequence[str], pick: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``pick`` of the wanted columns of the CSV files at ``path``, each file bound by its own header.

    One pass over the bytes, whatever the number of files and headers (:mod:`airpanel.sources.headered`); a column
    that a file lacks is NULL there, and one that all lack is absent. ``file`` is the path of a row's file. A store
    that only Spark's readers reach is read by them, the files of each distinct header together.
    """
    whole = qualified(spark, path)
    try:
        file_system(whole)
    except (pa.ArrowException, OSError):
        return _by_spark(spark, path, pick)
    found = read_headered(spark, whole, wanted)
    if found is None:  # let Spark say what is missing
        return pick(spark.read.csv(path, header=True).withColumn("file", F.col("_metadata.file_path")))
    return pick(found)


def _by_spark(spark: SparkSession, path: str, pick: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``pick`` of the CSV files at ``path``: the first line of every file is looked up, and each header is a read."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
    )
    # The lines of a file's first block come in order, so its first line is the header.
    heads = lines.where("start = 0").groupBy("file").agg(F.first("value").alias("header"))
    files: dict[str, list[str]] = {}
    for row in heads.collect():  # one row per file
        plain = unquote(row["file"])
        files.setdefault(row["header"], []).append(re.sub(r"([\\*?\[\]{}])", r"\\\1", plain))
    # Paths are URLs, in which a plus sign is itself.
    file = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    parts = [pick(spark.read.csv(names, header=True).withColumn("file", file)) for _, names in sorted(files.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _renamed(df: DataFrame, headers: dict[str, str], extra: Sequence[Column] = ()) -> DataFrame:
    """Known columns that exist, renamed and typed."""
    columns = [
        (_wall_clock(old) if new == "timestamp" else _number(old)).alias(new)
        for old, new in headers.items() if old in df.columns
    ]
    return df.select(*extra, *columns)


def read_station_csv(spark: SparkSession, path: str) -> DataFrame:
    """Station files ``<station_id>.csv``, or folders of that name holding parts.

    Each file is bound by its own header; its column order does not matter.
    """
    station = F.regexp_extract("file", r"([^/=]+)\.csv(?:/[^/]*)?$", 1).alias("station_id")
    found = _by_header(spark, path, list(STATION_HEADERS), lambda raw: _renamed(raw, STATION_HEADERS, [station]))
    return select_available(found, STATION_COLUMNS)


def read_city_day_csv(spark: SparkSession, path: str, city: str) -> DataFrame:
    """Daily rows of one city; each file is bound by its own header."""
    found = _by_header(spark, path, ["City", *CITY_HEADERS], lambda raw: _renamed(filter_city(raw, city), CITY_HEADERS))
    return select_available(found, list(CITY_HEADERS.values()))


def read_weather_json(
    spark: SparkSession, path: str, node_id: str | None = None, lines: bool = False,
) -> DataFrame:
    """Weather responses with parallel arrays under ``hourly``, one row per hour.

    The node is given, or stands beside ``hourly``. Files hold one document each,
    or one per line (``lines``), which Spark can split.
    """
    fields = ", ".join(
        f"{f}: array<{'string' if f == 'time' else 'double'}>" for f in WEATHER_FIELDS
    )
    raw = spark.read.schema(f"node_id string, hourly struct<{fields}>").json(path, multiLine=not lines)
    node = F.col("node_id") if node_id is None else F.lit(node_id)
    hours = F.arrays_zip(*[F.col(f"hourly.{f}") for f in WEATHER_FIELDS])
    rows = raw.select(node.alias("node_id"), F.inline(hours))
    return rows.select(
        "node_id",
        *[(F.col(f).try_cast("timestamp_ntz") if f == "time" else F.col(f)).alias(name)
          for f, name in WEATHER_FIELDS.items()],
    )


def read_measurements_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Measurement responses: ``results`` to long rows, under the location's name."""
    result = "struct<date: struct<utc: string>, parameter: string, value: double, unit: string>"
    raw = spark.read.schema(f"name string, results array<{result}>").json(
        path, multiLine=not lines
    )
    rows = raw.select(F.coalesce("name", F.lit("Unknown")).alias("location"),
                      F.explode("results").alias("r"))
    return rows.select(
        F.col("r.date.utc").try_cast("timestamp_ntz").alias("timestamp"), "location",
        F.col("r.parameter").alias("parameter"), F.col("r.value").alias("value"),
        F.col("r.unit").alias("unit"),
    )


def read_nodes_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Node dimension from the ``nodes`` lists of the documents."""
    node = "struct<id: string, name: string, lat: double, lon: double, characteristic: string>"
    raw = spark.read.schema(f"nodes array<{node}>").json(path, multiLine=not lines)
    return raw.select(F.inline("nodes")).withColumnRenamed("id", "node_id")


def read_node_csvs(spark: SparkSession, folder: str, ordered: bool = False) -> DataFrame:
    """All ``node_*.csv`` files, or ``node=*`` folders of parts, as one panel.

    Each file is bound by its own header. ``ordered`` sorts by (timestamp,
    node_id), for a final output only.
    """

    def pick(raw: DataFrame) -> DataFrame:
        return raw.select(
            _wall_clock("timestamp").alias("timestamp"), "node_id",
            *[_number(c).alias(c) for c in MEASURES if c in raw.columns],
        )

    try:
        out = _by_header(spark, f"{folder}/{{node_*.csv,node=*}}", ["timestamp", "node_id", *MEASURES], pick)
    except AnalysisException as e:
        if not _no_such_path(e):
            raise
        raise FileNotFoundError(f"no node_*.csv in {folder}") from e
    out = select_available(out, ["timestamp", "node_id", *MEASURES])
    return sort_panel(out) if ordered else out


def cached_parquet(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``; computed and written there when nothing is there.

    A table is written aside and renamed when it is finished, so that a reader never sees part of it, a writer
    that dies leaves nothing at ``path``, and of two writers at a time the first to finish wins. A folder
    without the success marker of a finished write is no table: it raises, and stays as it is.
    """
    if exists(spark, path):
        if is_folder(spark, path) and not exists(spark, f"{path}/_SUCCESS"):
            raise RuntimeError(f"{path} holds no finished table; remove it to compute it anew")
        return spark.read.parquet(path)
    aside = f"{path.rstrip('/')}.part-{uuid.uuid4().hex}"
    compute().write.mode("error").parquet(aside)
    publish(spark, aside, path)
    return spark.read.parquet(path)


def spread_by_month(df: DataFrame, key: str = "node_id") -> DataFrame:
    """Rows dealt by (node, month): a node's folder is then written by few or many tasks, as its history is long,
    and a task writes few folders. Files follow nodes and their months, not nodes times tasks.
    """
    hours = df.withColumn("_h", hour_index("timestamp"))
    return hours.repartition(F.col(key), chunk_of("_h", CHUNK)).drop("_h")


def write_processed(df: DataFrame, path: str, key: str = "node_id") -> None:
    """Panel as Parquet, one folder per node for pruning.

    Rows are spread by (node, month) first: a node's folder is then written by
    many tasks, and each task holds few folders.
    """
    spread = spread_by_month(df, key)
    spread.write.mode("overwrite").partitionBy(key).parquet(path)


def write_node_csv(df: DataFrame, path: str, key: str = "node_id") -> None:
    """One CSV folder per node; the node stays a column of the files.

    Rows are spread by (node, month) first, so a task opens few files and a node's
    folder is written by many tasks.
    """
    spread = spread_by_month(df, key)
    spread.withColumn("node", F.col(key)).write.mode("overwrite").partitionBy("node").csv(
        path, header=True
    )


def write_comparison(table: DataFrame, path: str) -> None:
    """Comparison table as CSV with its header."""
    table.write.mode("overwrite").csv(path, header=True)
