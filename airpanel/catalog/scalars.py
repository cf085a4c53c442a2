"""Projections, filters, index scoring and time features."""

from __future__ import annotations

from pyspark.sql import functions as F

from airpanel.catalog import expected as X
from airpanel.catalog.common import (
    MEASURES, SQL_CATEGORY, SQL_CATEGORY_BANDED, SQL_CATEGORY_INDEX, SQL_SIGNED, query, rd,
    readings, signed, sq, sql_aqi, sql_readings, sql_sub_index, table, with_sql,
)
from airpanel.functions import aqi as A
from airpanel.functions import clock, physics
from airpanel.operators import rows

ID = ["node_id", "timestamp"]
R = sql_readings()


@query("select_available", with_sql(R, select="SELECT timestamp, pm25, o3, humidity FROM readings"))
def _(spark, sf):
    return rows.select_available(readings(spark, sf), ["timestamp", "pm25", "o3", "pressure", "humidity"])


@query("filter_city", "SELECT event_id, event_type AS City, value FROM events WHERE lower(event_type) = 'click'")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("event_type").alias("City"), "value")
    return rows.filter_city(e, "CLICK")


@query("filter_node", with_sql(R, select="SELECT node_id, timestamp, pm25 FROM readings WHERE node_id = 'N03'"))
def _(spark, sf):
    return rows.filter_node(readings(spark, sf), "N03").select(*ID, "pm25")


@query("drop_null_any", with_sql(R, select="SELECT * FROM readings WHERE o3 IS NOT NULL"))
def _(spark, sf):
    return rows.drop_null_any(readings(spark, sf))


@query("drop_null_critical", with_sql(R, select="""
    SELECT node_id, timestamp, o3 AS pm25, pm10 FROM readings WHERE o3 IS NOT NULL AND pm10 IS NOT NULL"""))
def _(spark, sf):
    r = readings(spark, sf).select(*ID, F.col("o3").alias("pm25"), "pm10")
    return rows.drop_null_critical(r)


@query("drop_null_all", with_sql(R, select="""
    SELECT * FROM (SELECT node_id, timestamp, o3 AS pm25, CASE WHEN pm10 > 100 THEN pm10 END AS pm10 FROM readings)
    WHERE pm25 IS NOT NULL OR pm10 IS NOT NULL"""))
def _(spark, sf):
    r = readings(spark, sf).select(
        *ID, F.col("o3").alias("pm25"), F.when(F.col("pm10") > 100, F.col("pm10")).alias("pm10")
    )
    return rows.drop_null_all(r)


@query("null_negatives", with_sql(SQL_SIGNED, select=f"""
    SELECT node_id, timestamp, CASE WHEN pm25 >= 0 THEN {sq('pm25')} END AS pm25 FROM readings"""))
def _(spark, sf):
    return signed(spark, sf).select(*ID, rd(physics.null_negatives("pm25")).alias("pm25"))


@query("clamp_aqi", with_sql(SQL_SIGNED, select=f"""
    SELECT node_id, timestamp, {sq('least(greatest(pm25 * 2, 0), 500)')} AS clamped,
           CASE WHEN o3 IS NOT NULL THEN {sq('least(greatest(o3 * 3 - 50, 0), 500)')} END AS o3 FROM readings"""))
def _(spark, sf):
    return signed(spark, sf).select(
        *ID, rd(A.clamp_aqi("pm25 * 2")).alias("clamped"),
        rd(A.clamp_aqi("o3 * 3 - 50")).alias("o3"),
    )


@query("clamp_nonneg", with_sql(SQL_SIGNED, select=f"""
    SELECT node_id, timestamp, {sq('greatest(pm25, 0)')} AS pm25 FROM readings"""))
def _(spark, sf):
    return signed(spark, sf).select(*ID, rd(physics.clamp_nonneg("pm25")).alias("pm25"))


@query("select_numeric", with_sql(R, select="SELECT * EXCLUDE (node_id, timestamp) FROM readings"))
def _(spark, sf):
    return rows.select_numeric(readings(spark, sf))


@query("usable_features", with_sql(R, select="""
    SELECT 'pm25' AS feature, count(pm25) AS known FROM readings
    UNION ALL SELECT 'o3', count(o3) FROM readings UNION ALL SELECT 'humidity', count(humidity) FROM readings"""))
def _(spark, sf):
    r = readings(spark, sf).withColumn("empty", F.lit(None).cast("double"))
    return rows.usable_features(r, ["pm25", "o3", "empty", "absent", "humidity"])


@query("union_nodes", with_sql(R, select="""
    SELECT node_id, timestamp, pm25, no2, NULL::DOUBLE AS wind_speed FROM readings
    UNION ALL SELECT node_id, timestamp, NULL, NULL, wind_speed FROM readings"""))
def _(spark, sf):
    r = readings(spark, sf)
    return rows.union_nodes([r.select(*ID, "pm25", "no2"), r.select(*ID, "wind_speed")])


# About every tenth reading has NaN for fine dust, which SQL writes as a missing value.
SQL_NAN = """
    holed AS (SELECT * REPLACE (CASE WHEN pm10 % 10 >= 9 THEN NULL ELSE pm25 END AS pm25) FROM readings)"""


def _holed(df):
    return df.withColumn("pm25", F.when(F.col("pm10") % 10 >= 9, F.lit(float("nan"))).otherwise(F.col("pm25")))


@query("sub_index", with_sql(SQL_SIGNED, SQL_NAN, select=f"""
    SELECT node_id, timestamp,
           {', '.join(f"{sq(sql_sub_index(p, p))} AS {p}" for p in MEASURES)},
           {sq(sql_sub_index('(pm10 / 2)', 'so2'))} AS half, NULL::DOUBLE AS unknown FROM holed"""))
def _(spark, sf):
    return _holed(signed(spark, sf)).select(
        *ID, *[rd(A.sub_index(p, p)).alias(p) for p in MEASURES],
        rd(A.sub_index("pm10 / 2", "SO2")).alias("half"),
        A.sub_index("pm25", "dust").alias("unknown"),
    )


@query("aqi", with_sql(R, SQL_NAN, select=f"SELECT node_id, timestamp, {sq(sql_aqi())} AS aqi FROM holed"))
def _(spark, sf):
    return _holed(readings(spark, sf)).select(*ID, rd(A.aqi()).alias("aqi"))


@query("aqi_column", with_sql(R, select=f"""
    SELECT * FROM (SELECT node_id, timestamp, {sq(sql_aqi(['co', 'o3']))} AS aqi FROM readings) WHERE aqi IS NOT NULL"""))
def _(spark, sf):
    r = readings(spark, sf).select(*ID, "co", "o3")
    return r.withColumn("aqi", A.aqi(r.columns)).dropna(subset=["aqi"]).select(*ID, rd("aqi").alias("aqi"))


def _sql_dominant() -> str:
    subs = ", ".join(f"{sql_sub_index(p, p)} AS s_{p}" for p in MEASURES)
    best = f"greatest({', '.join(f's_{p}' for p in MEASURES)})"
    cases = " ".join(f"WHEN s_{p} = {best} THEN '{p}'" for p in MEASURES)
    return f"SELECT node_id, timestamp, CASE {cases} END AS pollutant FROM (SELECT *, {subs} FROM holed)"


@query("dominant_pollutant", with_sql(R, SQL_NAN, select=_sql_dominant()))
def _(spark, sf):
    return _holed(readings(spark, sf)).select(*ID, A.dominant_pollutant().alias("pollutant"))


LEVEL = "(pm10 * CAST(1.5 AS DOUBLE))"  # reads the same in both engines


@query("aqi_category_index", with_sql(R, select=f"""
    SELECT node_id, timestamp, {SQL_CATEGORY_INDEX.format(LEVEL)} AS category, {SQL_CATEGORY_INDEX.format('o3')} AS of_o3
    FROM readings"""))
def _(spark, sf):
    return readings(spark, sf).select(
        *ID, A.category_index(LEVEL).alias("category"), A.category_index("o3").alias("of_o3")
    )


@query("aqi_category", with_sql(R, select=f"""
    SELECT node_id, timestamp, {SQL_CATEGORY.format(LEVEL)} AS category, {SQL_CATEGORY.format('o3')} AS of_o3 FROM readings"""))
def _(spark, sf):
    return readings(spark, sf).select(*ID, A.category(LEVEL).alias("category"), A.category("o3").alias("of_o3"))


@query("aqi_category_banded", with_sql(R, select=f"""
    SELECT node_id, timestamp, {SQL_CATEGORY_BANDED.format(LEVEL)} AS category,
           {SQL_CATEGORY_BANDED.format('o3')} AS of_o3 FROM readings"""))
def _(spark, sf):
    return readings(spark, sf).select(
        *ID, A.category_banded(LEVEL).alias("category"), A.category_banded("o3").alias("of_o3")
    )


def _sql_map(column: str, values: dict[str, str], default: str = "NULL") -> str:
    return f"CASE {column} {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in values.items())} ELSE {default} END"


@query("aqi_color", with_sql(R, select=f"""
    SELECT node_id, timestamp, {_sql_map(SQL_CATEGORY.format(LEVEL), X.MAP_COLORS)} AS map_color,
           {_sql_map(SQL_CATEGORY_BANDED.format(LEVEL), X.SERVICE_COLORS)} AS service_color FROM readings"""))
def _(spark, sf):
    r = readings(spark, sf).select(
        *ID, A.category(LEVEL).alias("on_map"), A.category_banded(LEVEL).alias("in_service")
    )
    return r.select(
        *ID, A.category_color("on_map").alias("map_color"),
        A.category_color("in_service", service=True).alias("service_color"),
    )


@query("health_advisory", with_sql(R, select=f"""
    SELECT node_id, timestamp, {_sql_map(SQL_CATEGORY.format('o3'), X.ADVISORIES, repr(X.DEFAULT_ADVISORY))} AS advisory
    FROM readings"""))
def _(spark, sf):
    r = readings(spark, sf).select(*ID, A.category("o3").alias("category"))
    return r.select(*ID, A.health_advisory().alias("advisory"))


# -- time and weather. Shifted copies of the hour reach every month and the
# festival days, also where the readings cover a few weeks.

SHIFTS = [0, 90, 190, 300, 384, 739]
SHIFTED = sql_readings() + f""",
    hours AS (SELECT node_id, timestamp + to_days(d) AS timestamp, pm25, pm10, wind_speed, wind_direction,
                     temperature, humidity
              FROM readings, (SELECT unnest({SHIFTS}::INT[]) AS d) x)"""


def _hours(spark, sf):
    days = F.explode(F.array(*[F.lit(s) for s in SHIFTS]))
    return readings(spark, sf).withColumn("d", days).withColumn(
        "timestamp", F.timestamp_add("DAY", F.col("d"), F.col("timestamp"))
    ).drop("d")


DOW = "(CAST(isodow(timestamp) AS INT) - 1)"
SQL_CYCLES = {
    "hour_sin": "sin(2 * pi() * hour(timestamp) / 24)", "hour_cos": "cos(2 * pi() * hour(timestamp) / 24)",
    "dow_sin": f"sin(2 * pi() * {DOW} / 7)", "dow_cos": f"cos(2 * pi() * {DOW} / 7)",
    "month_sin": "sin(2 * pi() * month(timestamp) / 12)", "month_cos": "cos(2 * pi() * month(timestamp) / 12)",
}
SQL_FESTIVAL = "CASE WHEN " + " OR ".join(
    f"timestamp BETWEEN TIMESTAMP '{d}' - INTERVAL 2 DAY AND TIMESTAMP '{d}' + INTERVAL 2 DAY"
    for d in X.FESTIVAL_DATES
) + " THEN 1 ELSE 0 END"
SQL_FLAGS = {
    "is_weekend": f"CASE WHEN {DOW} IN (5, 6) THEN 1 ELSE 0 END",
    "is_diwali_week": SQL_FESTIVAL,
    "is_monsoon": "CASE WHEN month(timestamp) IN (7, 8, 9) THEN 1 ELSE 0 END",
}


def _named(exprs: dict[str, str], digits: int | None = None) -> str:
    return ", ".join(f"{sq(e, digits) if digits else e} AS {n}" for n, e in exprs.items())


def _rounded(exprs, digits=6):
    return [rd(e, digits).alias(n) for n, e in exprs.items()]


def _plain(exprs):
    return [e.alias(n) for n, e in exprs.items()]


SQL_WIND = {
    "wind_u": "wind_speed * sin(radians(wind_direction))", "wind_v": "wind_speed * cos(radians(wind_direction))",
}


@query("wind_vectors", with_sql(R, select=f"SELECT node_id, timestamp, {_named(SQL_WIND, 6)} FROM readings"))
def _(spark, sf):
    r = readings(spark, sf)
    return r.select(*ID, *_rounded(physics.wind_vectors(r.columns)))


@query("cyclical_time", with_sql(SHIFTED, select=f"SELECT node_id, timestamp, {_named(SQL_CYCLES, 6)} FROM hours"))
def _(spark, sf):
    return _hours(spark, sf).select(*ID, *_rounded(clock.cyclical_time()))


@query("weekend_flag", with_sql(SHIFTED, select=f"SELECT node_id, timestamp, {SQL_FLAGS['is_weekend']} AS is_weekend FROM hours"))
def _(spark, sf):
    return _hours(spark, sf).select(*ID, clock.weekend_flag().alias("is_weekend"))


@query("festival_flag", with_sql(SHIFTED, select=f"SELECT node_id, timestamp, {SQL_FESTIVAL} AS is_diwali_week FROM hours"))
def _(spark, sf):
    return _hours(spark, sf).select(*ID, clock.festival_flag().alias("is_diwali_week"))


@query("monsoon_flag", with_sql(SHIFTED, select=f"SELECT node_id, timestamp, {SQL_FLAGS['is_monsoon']} AS is_monsoon FROM hours"))
def _(spark, sf):
    return _hours(spark, sf).select(*ID, clock.monsoon_flag().alias("is_monsoon"))


@query("calendar_features", with_sql(SHIFTED, select=f"""
    SELECT node_id, timestamp, {_named(SQL_CYCLES, 6)}, {_named(SQL_FLAGS)} FROM hours"""))
def _(spark, sf):
    every = clock.calendar_features()
    cycles = clock.cyclical_time()
    flags = {n: e for n, e in every.items() if n not in cycles}
    return _hours(spark, sf).select(*ID, *_rounded(cycles), *_plain(flags))


@query("time_parts", with_sql(SHIFTED, select=f"""
    SELECT node_id, timestamp, hour(timestamp) AS hour, {DOW} AS day_of_week, month(timestamp) AS month FROM hours"""))
def _(spark, sf):
    return _hours(spark, sf).select(*ID, *_plain(clock.time_parts()))


@query("rush_hour_flag", with_sql(R, select="""
    SELECT node_id, timestamp, CASE WHEN hour(timestamp) BETWEEN 7 AND 9 OR hour(timestamp) BETWEEN 17 AND 20
           THEN 1 ELSE 0 END AS is_rush_hour FROM readings"""))
def _(spark, sf):
    return readings(spark, sf).select(*ID, clock.rush_hour_flag().alias("is_rush_hour"))


SQL_SEASONS = {
    "is_diwali_season": "CASE WHEN month(timestamp) IN (10, 11) THEN 1 ELSE 0 END",
    "is_monsoon": "CASE WHEN month(timestamp) IN (6, 7, 8, 9) THEN 1 ELSE 0 END",
    "is_winter": "CASE WHEN month(timestamp) IN (12, 1, 2) THEN 1 ELSE 0 END",
}


@query("season_flags", with_sql(SHIFTED, select=f"SELECT node_id, timestamp, {_named(SQL_SEASONS)} FROM hours"))
def _(spark, sf):
    return _hours(spark, sf).select(*ID, *_plain(clock.season_flags()))


SQL_WEATHER = {"temp_humidity": "temperature * humidity / 100", "wind_speed_inv": "1 / (wind_speed + 0.1::DOUBLE)"}


@query("weather_interactions", with_sql(R, select=f"SELECT node_id, timestamp, {_named(SQL_WEATHER, 6)} FROM readings"))
def _(spark, sf):
    r = readings(spark, sf)
    return r.select(*ID, *_rounded(physics.weather_interactions(r.columns)))
