"""Registry, derived tables in Spark, and the same tables as SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.catalog.expected import BAND_INDEX, BANDS, POLLUTANTS
from airpanel.functions.clock import hour_index
from airpanel.operators.chunks import windowed
from airpanel.operators.gaps import clean_panel
from airpanel.plans.panel import with_aqi
from airpanel.session import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MEASURES = ["pm25", "pm10", "no2", "so2", "co", "o3"]
WEATHER = ["wind_speed", "wind_direction", "temperature", "humidity"]
ALL = MEASURES + WEATHER


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# -- rounding: the tiny shift keeps exact halves off the rounding edge, on which
# the two engines differ; adding zero turns -0.0 into 0.0.

def rd(c: str | Column, digits: int = 6) -> Column:
    if isinstance(c, str):
        return F.expr(f"round({c} + 1e-9D, {digits}) + 0D")
    return F.round(c + F.lit(1e-9), digits) + F.lit(0.0)


def sq(expr: str, digits: int = 6) -> str:
    return f"(round(({expr}) + 1e-9, {digits}) + 0.0::DOUBLE)"


def rds(columns: Sequence[str], digits: int = 6) -> list[Column]:
    return [rd(c, digits).alias(c) for c in columns]


def sqs(columns: Sequence[str], digits: int = 6) -> str:
    return ", ".join(f"{sq(c, digits)} AS {c}" for c in columns)


# -- tables

def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Readings follow the event number: a node of its own gets about 60 % of all events,
# every 2500 events bring one more node, and two events fall into one hour. So more
# events mean a longer history, more nodes and one node that dominates. Hours move on
# by 8 every 89 and by 25 every 364, which leaves gaps; those of a sparse panel also by
# 21 every 32. Every event enters.
SQL_BIG_NODE = "(event_id * 7919) % 101 < 60"
EVENTS_PER_NODE = 2500
START = "2022-04-01 00:00:00"
GAPS = ((8, 89), (25, 364))
SPARSE_GAPS = (*GAPS, (21, 32))


def moved(h: str, gaps: Sequence[tuple[int, int]], div: str) -> str:
    """An hour moved on by the gaps before it, as SQL; ``div`` divides whole numbers."""
    return h + "".join(f" + {hours} * (({h}) {div} {every})" for hours, every in gaps)



def readings(spark: SparkSession, sf: str, thin: bool = False) -> DataFrame:
    """Hourly readings per sensor node, aggregated from the events."""
    e = table(spark, sf, "events").selectExpr(
        "*", f"CASE WHEN {SQL_BIG_NODE} THEN 1 ELSE 2 + event_id DIV {EVENTS_PER_NODE} END AS node",
        f"CASE WHEN {SQL_BIG_NODE} THEN event_id DIV 2 ELSE (event_id % {EVENTS_PER_NODE}) DIV 2 END AS seen",
    ).selectExpr("*", f"{moved('seen', SPARSE_GAPS if thin else GAPS, 'DIV')} AS h")
    value = F.col("value")
    hour = F.expr(f"timestampadd(HOUR, h, TIMESTAMP_NTZ'{START}')")
    return e.groupBy(F.format_string("N%02d", "node").alias("node_id"), hour.alias("timestamp")).agg(
        F.max(value).alias("pm25"),
        F.sum(value.cast("decimal(18,2)")).cast("double").alias("pm10"),
        F.min(value).alias("no2"),
        (F.count(F.lit(1)).cast("double") * 10).alias("so2"),
        (F.min(value) / 10).alias("co"),
        F.max(F.when(F.col("event_type") == "view", value)).alias("o3"),
        F.min(F.col("event_id") % 15).cast("double").alias("wind_speed"),
        F.max(F.col("event_id") % 360).cast("double").alias("wind_direction"),
        (F.max(F.col("event_id") % 20) + 15).cast("double").alias("temperature"),
        (F.max(F.col("event_id") % 50) + 40).cast("double").alias("humidity"),
    )


def hours(ts: str) -> Column:
    """The hour a wall-clock time lies in."""
    return F.timestamp_add("HOUR", hour_index(ts), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def sparse(spark: SparkSession, sf: str) -> DataFrame:
    return readings(spark, sf, thin=True)


def signed(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with some negative values."""
    return readings(spark, sf).withColumn("pm25", F.col("pm25") - 20)


def scored(spark: SparkSession, sf: str, columns: Sequence[str] = ALL) -> DataFrame:
    """Clean panel of these columns, written once for the passes that follow, with its index."""
    raw = materialize(readings(spark, sf).select("node_id", "timestamp", *columns), "readings")
    return with_aqi(materialize(clean_panel(raw), "clean"))


def _grid(offset: int) -> str:
    """Every other bit of a supplier's number: with both offsets a place on a square grid.

    Neighbouring numbers lie near each other, so the grid grows with the suppliers
    and its density stays the same.
    """
    return " + ".join(f"((s_suppkey >> {2 * b + offset}) & 1) * {1 << b}" for b in range(16))


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Stations on a grid of about 5 km, one per supplier."""
    s = table(spark, sf, "supplier")
    return s.select(
        F.format_string("N%02d", F.col("s_suppkey") + 1).alias("node_id"),
        F.col("s_name").alias("name"),
        F.expr(f"18.4D + CAST({_grid(0)} AS DOUBLE) / 20.0D").alias("lat"),
        F.expr(f"73.6D + CAST({_grid(1)} AS DOUBLE) / 20.0D").alias("lon"),
    )


MODELS = ["lag1", "lag24", "mean24"]


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Truth and three simple forecasts per row: (node, time, model, y_true, y_pred, y_baseline)."""
    rows = windowed(
        scored(spark, sf).select("node_id", "timestamp", "aqi"),
        {
            "lag1": lambda w: F.lag("aqi", 1).over(w),
            "lag24": lambda w: F.lag("aqi", 24).over(w),
            "mean24": lambda w: F.avg("aqi").over(w.rowsBetween(-24, -1)),
        },
        lookback=24,
    ).where("lag24 IS NOT NULL")
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("y_pred")) for m in MODELS])
    return rows.select(
        "node_id", "timestamp", F.col("aqi").alias("y_true"),
        F.col("lag24").alias("y_baseline"), F.inline(models),
    )


# -- the same tables as SQL

def sql_readings(thin: bool = False, name: str = "readings") -> str:
    return f"""{name}_events AS (
      SELECT *, CASE WHEN {SQL_BIG_NODE} THEN 1 ELSE 2 + event_id // {EVENTS_PER_NODE} END AS node,
             CASE WHEN {SQL_BIG_NODE} THEN event_id // 2 ELSE (event_id % {EVENTS_PER_NODE}) // 2 END AS seen FROM events),
    {name} AS (
      SELECT printf('N%02d', node) AS node_id,
             TIMESTAMP '{START}' + to_hours(CAST({moved('seen', SPARSE_GAPS if thin else GAPS, '//')} AS INTEGER)) AS timestamp,
             max(value) AS pm25,
             CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS pm10,
             min(value) AS no2,
             CAST(count(*) AS DOUBLE) * 10 AS so2,
             min(value) / 10 AS co,
             max(CASE WHEN event_type = 'view' THEN value END) AS o3,
             CAST(min(event_id % 15) AS DOUBLE) AS wind_speed,
             CAST(max(event_id % 360) AS DOUBLE) AS wind_direction,
             CAST(15 + max(event_id % 20) AS DOUBLE) AS temperature,
             CAST(40 + max(event_id % 50) AS DOUBLE) AS humidity
      FROM {name}_events GROUP BY 1, 2)"""


SQL_SIGNED = sql_readings(name="unsigned") + """,
    readings AS (SELECT * REPLACE (pm25 - 20 AS pm25) FROM unsigned)"""

SQL_STATIONS = f"""stations AS (
      SELECT printf('N%02d', s_suppkey + 1) AS node_id, s_name AS name,
             18.4::DOUBLE + CAST({_grid(0)} AS DOUBLE) / 20.0::DOUBLE AS lat,
             73.6::DOUBLE + CAST({_grid(1)} AS DOUBLE) / 20.0::DOUBLE AS lon
      FROM supplier)"""


def sql_grid(source: str = "readings", columns: Sequence[str] = tuple(ALL), name: str = "grid") -> str:
    cols = ", ".join(f"r.{c}" for c in columns)
    return f"""{name}_hours AS (
      SELECT node_id, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp
      FROM {source} GROUP BY node_id),
    {name} AS (
      SELECT h.node_id, h.timestamp, {cols},
             row_number() OVER (PARTITION BY h.node_id ORDER BY h.timestamp) AS i
      FROM {name}_hours h LEFT JOIN {source} r USING (node_id, timestamp))"""


def sql_interpolate(source: str, columns: Sequence[str], limit: int, name: str) -> str:
    """Line by row position ``i`` from the last known value, at most ``limit`` rows after it."""
    looks, values = [], []
    for c in columns:
        known = f"CASE WHEN {c} IS NOT NULL THEN i END"
        looks += [
            f"last_value({known} IGNORE NULLS) OVER back AS {c}_pi",
            f"last_value({c} IGNORE NULLS) OVER back AS {c}_pv",
            f"first_value({known} IGNORE NULLS) OVER ahead AS {c}_ni",
            f"first_value({c} IGNORE NULLS) OVER ahead AS {c}_nv",
        ]
        values.append(
            f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN {c}_pi IS NULL THEN NULL
                     WHEN {c}_ni IS NULL THEN {c}_pv
                     ELSE (({c}_nv - {c}_pv) / ({c}_ni - {c}_pi)) * (i - {c}_pi) + {c}_pv END AS {c}"""
        )
    return f"""{name}_looks AS (
      SELECT *, {', '.join(looks)} FROM {source}
      WINDOW back AS (PARTITION BY node_id ORDER BY i ROWS BETWEEN {limit} PRECEDING AND CURRENT ROW),
             ahead AS (PARTITION BY node_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
    {name} AS (SELECT * REPLACE ({', '.join(values)}) FROM {name}_looks)"""


def sql_ffill(source: str, columns: Sequence[str], limit: int, name: str) -> str:
    fills = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in columns)
    return f"""{name} AS (
      SELECT * REPLACE ({fills}) FROM {source}
      WINDOW w AS (PARTITION BY node_id ORDER BY i ROWS BETWEEN {limit} PRECEDING AND CURRENT ROW))"""


def sql_clean(source: str = "readings", columns: Sequence[str] = tuple(ALL), name: str = "clean") -> str:
    cols = ", ".join(columns)
    return ",\n    ".join([
        sql_grid(source, columns),
        sql_ffill("grid", columns, 3, "held"),
        sql_interpolate("held", columns, 9, "filled"),
        f"""{name} AS (SELECT node_id, timestamp, {cols} FROM filled
            WHERE pm25 IS NOT NULL AND pm10 IS NOT NULL)""",
    ])


def sql_sub_index(column: str, pollutant: str) -> str:
    cases = []
    for (low, high), (c_low, c_high) in zip(BAND_INDEX, BANDS[pollutant], strict=True):
        slope = f"(({high}::DOUBLE - {low}::DOUBLE) / ({c_high}::DOUBLE - {c_low}::DOUBLE))"
        cases.append(
            f"WHEN {column} BETWEEN {c_low}::DOUBLE AND {c_high}::DOUBLE "
            f"THEN {slope} * ({column} - {c_low}::DOUBLE) + {low}::DOUBLE"
        )
    top = BANDS[pollutant][-1][1]
    return f"CASE {' '.join(cases)} WHEN {column} > {top} THEN 500::DOUBLE END"


def sql_aqi(columns: Sequence[str] = tuple(POLLUTANTS)) -> str:
    return f"greatest({', '.join(f'({sql_sub_index(c, c)})' for c in columns)})"


SQL_CATEGORY_INDEX = (
    "CASE WHEN {0} < 51 THEN 0 WHEN {0} < 101 THEN 1 WHEN {0} < 201 THEN 2 "
    "WHEN {0} < 301 THEN 3 WHEN {0} < 401 THEN 4 WHEN {0} >= 401 THEN 5 END"
)
SQL_CATEGORY = (
    "CASE WHEN {0} <= 50 THEN 'Good' WHEN {0} <= 100 THEN 'Satisfactory' "
    "WHEN {0} <= 200 THEN 'Moderate' WHEN {0} <= 300 THEN 'Poor' "
    "WHEN {0} <= 400 THEN 'Very Poor' WHEN {0} IS NOT NULL THEN 'Severe' END"
)
SQL_CATEGORY_BANDED = (
    "CASE WHEN {0} IS NULL THEN NULL WHEN {0} BETWEEN 0 AND 50 THEN 'Good' "
    "WHEN {0} BETWEEN 51 AND 100 THEN 'Satisfactory' "
    "WHEN {0} BETWEEN 101 AND 200 THEN 'Moderate' WHEN {0} BETWEEN 201 AND 300 THEN 'Poor' "
    "WHEN {0} BETWEEN 301 AND 400 THEN 'Very Poor' ELSE 'Severe' END"
)


def sql_scored() -> str:
    return ",\n    ".join([
        sql_readings(), sql_clean(),
        f"""scored AS (SELECT * FROM (SELECT *, {sql_aqi()} AS aqi FROM clean) WHERE aqi IS NOT NULL)""",
    ])


SQL_FORECASTS = sql_scored() + """,
    looks AS (
      SELECT node_id, timestamp, aqi,
             lag(aqi, 1) OVER w AS lag1, lag(aqi, 24) OVER w AS lag24,
             avg(aqi) OVER (PARTITION BY node_id ORDER BY timestamp ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS mean24
      FROM scored WINDOW w AS (PARTITION BY node_id ORDER BY timestamp)),
    forecasts AS (
      SELECT node_id, timestamp, aqi AS y_true, lag24 AS y_baseline, model,
             CASE model WHEN 'lag1' THEN lag1 WHEN 'lag24' THEN lag24 ELSE mean24 END AS y_pred
      FROM looks, (SELECT unnest(['lag1', 'lag24', 'mean24']) AS model) m WHERE lag24 IS NOT NULL)"""


def with_sql(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"
