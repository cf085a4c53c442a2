"""Quantile rules, scaling, summaries and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from airpanel.catalog.common import (
    ALL, MEASURES, ORACLES, SQL_STATIONS, hours, query, rd, rds, readings, scored, sq, sql_ffill, sql_grid,
    sql_interpolate, sql_readings, stations, table, with_sql,
)
from airpanel.catalog.panel import SCORED, SPLIT, _raw
from airpanel.operators import graph, quality, rows, scaling, splits, summaries
from airpanel.operators import quantiles as Q
from airpanel.operators.gaps import hourly_fill

ID = ["node_id", "timestamp"]
R = sql_readings()
LEVELS = ["pm25", "pm10", "aqi"]


@query("clip_outliers", with_sql(
    R, "bounds AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.999) AS {c}_hi, quantile_cont({c}, 0.001) AS {c}_lo" for c in MEASURES
    ) + " FROM readings)",
    select="SELECT node_id, timestamp, " + ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {sq(f'least(greatest({c}, {c}_lo), {c}_hi)')} END AS {c}" for c in MEASURES
    ) + " FROM readings, bounds"))
def _(spark, sf):
    out = Q.clip_outliers(_raw(spark, sf, thin=False), MEASURES)
    return out.select(*ID, *rds(MEASURES))


@query("clip_narrowed", ORACLES["clip_outliers"])
def _(spark, sf):
    """The path for columns with more values than one task should order."""
    out = Q.clip_outliers(_raw(spark, sf, thin=False), MEASURES, small=200)
    return out.select(*ID, *rds(MEASURES))


TOPS = "tops AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.9) AS {c}_top" for c in MEASURES) + " FROM readings)"


@query("null_extremes", with_sql(R, TOPS, select="SELECT node_id, timestamp, " + ", ".join(
    f"CASE WHEN {c} <= {c}_top * 1.2 THEN {c} END AS {c}" for c in MEASURES) + " FROM readings, tops"))
def _(spark, sf):
    return Q.null_extremes(_raw(spark, sf, thin=False), MEASURES, 1.2, 0.9).select(*ID, *MEASURES)


@query("cap_extremes", with_sql(R, TOPS, select="SELECT node_id, timestamp, " + ", ".join(
    f"{sq(f'CASE WHEN {c} > {c}_top * 1.2 THEN {c}_top * 1.2 ELSE {c} END')} AS {c}" for c in MEASURES)
    + " FROM readings, tops"))
def _(spark, sf):
    return Q.cap_extremes(_raw(spark, sf, thin=False), MEASURES, 1.2, 0.9).select(*ID, *rds(MEASURES))


@query("median_fill", with_sql(R, "mids AS (SELECT median(o3) AS mid FROM readings)",
       select=f"SELECT node_id, timestamp, {sq('coalesce(o3, mid)')} AS o3 FROM readings, mids"))
def _(spark, sf):
    return Q.median_fill(_raw(spark, sf, thin=False), ["o3"]).select(*ID, rd("o3").alias("o3"))


def _split(spark, sf):
    return splits.chrono_split(scored(spark, sf).select(*ID, *LEVELS))


MINMAX = SPLIT + ", fitted AS (SELECT " + ", ".join(
    f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in LEVELS) + " FROM parts WHERE split = 'train')"
STANDARD = SPLIT + ", fitted AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in LEVELS) + " FROM parts WHERE split = 'train')"


def _fit(parts, how):
    return how(parts.where("split = 'train'"), LEVELS)


@query("minmax_scale", with_sql(MINMAX, select="SELECT node_id, timestamp, split, " + ", ".join(
    f"{sq(f'({c} - {c}_min) / CASE WHEN {c}_max = {c}_min THEN 1 ELSE {c}_max - {c}_min END')} AS {c}" for c in LEVELS)
    + " FROM parts, fitted"))
def _(spark, sf):
    parts = _split(spark, sf)
    return scaling.scale(parts, _fit(parts, scaling.fit_minmax)).select(*ID, "split", *rds(LEVELS))


@query("minmax_inverse", with_sql(MINMAX, select=f"""
    SELECT node_id, timestamp, {sq('(least(pm25, 100) / 100) * (aqi_max - aqi_min) + aqi_min')} AS y_pred FROM parts, fitted"""))
def _(spark, sf):
    parts = _split(spark, sf)
    share = parts.withColumn("y_pred", F.least(F.col("pm25"), F.lit(100.0)) / 100)
    out = scaling.unscale(share, _fit(parts, scaling.fit_minmax), "aqi", ["y_pred"])
    return out.select(*ID, rd("y_pred").alias("y_pred"))


@query("standard_scale", with_sql(STANDARD, select="SELECT node_id, timestamp, split, " + ", ".join(
    f"{sq(f'({c} - {c}_mean) / CASE WHEN {c}_std = 0 THEN 1 ELSE {c}_std END')} AS {c}" for c in LEVELS)
    + " FROM parts, fitted"))
def _(spark, sf):
    parts = _split(spark, sf)
    return scaling.scale(parts, _fit(parts, scaling.fit_standard)).select(*ID, "split", *rds(LEVELS))


@query("standard_inverse", with_sql(STANDARD, select=f"""
    SELECT node_id, timestamp, {sq('least(greatest((pm25 / 50 - 1) * aqi_std + aqi_mean, 0), 500)')} AS y_pred
    FROM parts, fitted"""))
def _(spark, sf):
    parts = _split(spark, sf)
    z = parts.withColumn("y_pred", F.col("pm25") / 50 - 1)
    out = scaling.unscale(z, _fit(parts, scaling.fit_standard), "aqi", ["y_pred"], clamp=True)
    return out.select(*ID, rd("y_pred").alias("y_pred"))


CORR = ["pm25", "pm10", "no2", "so2"]


@query("correlation_adjacency", with_sql(
    R, "edges AS (" + " UNION ALL ".join(
        f"SELECT '{a}' AS src, '{b}' AS dst, abs(corr({a}, {b})) AS weight FROM readings"
        for a in CORR for b in CORR if a != b
    ) + " UNION ALL " + " UNION ALL ".join(f"SELECT '{a}', '{a}', 1.0::DOUBLE" for a in CORR) + ")",
    "degree AS (SELECT src, sum(weight) AS d FROM edges GROUP BY 1)", select=f"""
    SELECT e.src, e.dst, {sq('e.weight / sqrt((a.d + 1e-8) * (b.d + 1e-8))')} AS weight
    FROM edges e JOIN degree a ON a.src = e.src JOIN degree b ON b.src = e.dst"""))
def _(spark, sf):
    edges = graph.correlation_edges(readings(spark, sf), CORR)
    return graph.normalize_edges(edges).withColumn("weight", rd("weight"))


KINDS = ["click", "error", "purchase", "signup", "view"]


@query("pivot_measurements", "SELECT timestamp, location, " + ", ".join(
    f"{sq(f'''avg(value) FILTER (event_type = '{k}')''')} AS {k}" for k in KINDS
) + """ FROM (SELECT date_trunc('hour', ts) AS timestamp, 'L' || (user_id % 10) AS location, event_type, value FROM events)
      GROUP BY 1, 2""")
def _(spark, sf):
    long = table(spark, sf, "events").select(
        hours("ts").alias("timestamp"),
        F.concat(F.lit("L"), (F.col("user_id") % 10).cast("string")).alias("location"),
        F.col("event_type").alias("parameter"), "value",
    )
    return rows.pivot_measurements(long, KINDS).select("timestamp", "location", *rds(KINDS))


@query("split_summary", with_sql(SPLIT, select=f"""
    SELECT split, count(*) AS rows, {sq('avg(aqi)')} AS mean, {sq('stddev_samp(aqi)')} AS std FROM parts GROUP BY 1"""))
def _(spark, sf):
    return splits.split_summary(_split(spark, sf)).select("split", "rows", *rds(["mean", "std"]))


@query("series_range", with_sql(SCORED, select=f"""
    SELECT count(*) AS rows, min(timestamp) AS first, max(timestamp) AS last, {sq('min(aqi)')} AS lowest,
           {sq('max(aqi)')} AS highest, {sq('avg(aqi)')} AS mean FROM scored"""))
def _(spark, sf):
    return summaries.series_range(scored(spark, sf)).select(
        "rows", "first", "last", *rds(["lowest", "highest", "mean"])
    )


@query("node_mean_aqi", with_sql(SCORED, "means AS (SELECT node_id, avg(aqi) AS mean FROM scored GROUP BY 1)", select=f"""
    SELECT node_id, {sq('mean')} AS mean, {sq("mean - (SELECT mean FROM means WHERE node_id = 'N01')")} AS difference FROM means"""))
def _(spark, sf):
    return summaries.node_means(scored(spark, sf), "N01").select("node_id", *rds(["mean", "difference"]))


# -- quality

@query("null_report", with_sql(R, select=" UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls, {sq(f'(count(*) - count({c})) * 100.0 / count(*)')} AS percent FROM readings"
    for c in ["node_id", "timestamp", *ALL])))
def _(spark, sf):
    return quality.null_report(readings(spark, sf)).withColumn("percent", rd("percent"))


@query("range_report", with_sql(sql_readings(name="unsigned"), select="""
    SELECT count(*) FILTER (pm10 * 3 - 100 < 0) AS below, count(*) FILTER (pm10 * 3 - 100 > 500) AS above FROM unsigned"""))
def _(spark, sf):
    return quality.range_report(readings(spark, sf).withColumn("aqi", F.col("pm10") * 3 - 100))


@query("validate_panel", with_sql(sql_readings(thin=True), SQL_STATIONS, """
    wide AS (SELECT node_id, timestamp, pm10 AS aqi, CASE WHEN o3 < 50 THEN 'NaN'::DOUBLE ELSE o3 END AS o3 FROM readings),
    panel AS (SELECT * FROM wide WHERE NOT (node_id = 'N03' AND hour(timestamp) = 5)
              UNION ALL SELECT * FROM wide WHERE node_id = 'N03' AND hour(timestamp) = 6),
    first_ AS (SELECT timestamp FROM panel WHERE node_id = (SELECT min(node_id) FROM panel))""", select="""
    SELECT 'null_values' AS "check", node_id, count(*) FILTER (o3 IS NULL OR isnan(o3)) AS found FROM panel GROUP BY 2 HAVING found > 0
    UNION ALL SELECT 'out_of_range', node_id, count(*) FILTER (aqi < 0 OR aqi > 500) AS found FROM panel GROUP BY 2 HAVING found > 0
    UNION ALL SELECT 'mismatched_timestamps', node_id, found FROM (
      SELECT n.node_id, (SELECT count(DISTINCT timestamp) FROM panel p WHERE p.node_id = n.node_id AND p.timestamp NOT IN (SELECT timestamp FROM first_))
           + (SELECT count(*) - count(DISTINCT timestamp) FROM panel p WHERE p.node_id = n.node_id)
           + (SELECT count(*) FROM first_ f WHERE f.timestamp NOT IN (SELECT timestamp FROM panel p WHERE p.node_id = n.node_id)) AS found
      FROM (SELECT DISTINCT node_id FROM panel) n) WHERE found > 0
    UNION ALL SELECT 'missing_node', node_id, 1 FROM stations WHERE node_id NOT IN (SELECT node_id FROM panel)"""))
def _(spark, sf):
    nan = F.when(F.col("o3") < 50, F.lit(float("nan"))).otherwise(F.col("o3"))
    wide = _raw(spark, sf).select(*ID, F.col("pm10").alias("aqi"), nan.alias("o3"))
    # One node lacks an hour of each day and has another one twice.
    panel = wide.where("NOT (node_id = 'N03' AND hour(timestamp) = 5)").unionAll(
        wide.where("node_id = 'N03' AND hour(timestamp) = 6")
    )
    return quality.validate_panel(panel, stations(spark, sf))


@query("hourly_continuity", with_sql(sql_readings(thin=True), select="""
    SELECT * FROM (SELECT node_id, timestamp, previous, datediff('minute', previous, timestamp) AS minutes FROM (
      SELECT node_id, timestamp, lag(timestamp) OVER (PARTITION BY node_id ORDER BY timestamp) AS previous FROM readings))
    WHERE minutes <> 60"""))
def _(spark, sf):
    return quality.hourly_continuity(_raw(spark, sf))


@query("split_no_leak", with_sql(SPLIT, select="""
    SELECT *, CASE WHEN train_to <= test_from THEN 1 ELSE 0 END AS ordered FROM (
      SELECT max(timestamp) FILTER (split = 'train') AS train_to, min(timestamp) FILTER (split = 'test') AS test_from FROM parts)"""))
def _(spark, sf):
    return splits.split_no_leak(_split(spark, sf)).withColumn("ordered", F.col("ordered").cast("int"))


@query("fill_report", with_sql(
    sql_readings(thin=True), sql_grid(columns=MEASURES), sql_ffill("grid", MEASURES, 3, "held"),
    sql_interpolate("held", MEASURES, 9, "filled"), select=" UNION ALL ".join(
        f"SELECT '{c}' AS column, (SELECT count(*) - count({c}) FROM grid) - (count(*) - count({c})) AS filled, "
        f"count(*) - count({c}) AS \"left\" FROM filled" for c in MEASURES)))
def _(spark, sf):
    filled = hourly_fill(_raw(spark, sf), MEASURES, 3, 9, keep_raw=True)
    return quality.fill_report(filled, MEASURES)


@query("drop_report", with_sql(sql_readings(thin=True), sql_grid(columns=MEASURES), select="""
    SELECT count(*) FILTER (pm25 IS NOT NULL AND pm10 IS NOT NULL) AS kept,
           count(*) FILTER (pm25 IS NULL OR pm10 IS NULL) AS dropped FROM grid"""))
def _(spark, sf):
    return quality.drop_report(hourly_fill(_raw(spark, sf), MEASURES))


@query("clip_report", with_sql(R, "bounds AS (SELECT " + ", ".join(
    f"round(quantile_cont({c}, 0.95), 6) AS {c}_hi, round(quantile_cont({c}, 0.05), 6) AS {c}_lo" for c in MEASURES) + " FROM readings)",
    select=" UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER ({c} < {c}_lo OR {c} > {c}_hi) AS clipped FROM readings, bounds" for c in MEASURES)))
def _(spark, sf):
    raw = _raw(spark, sf, thin=False)
    # Engines differ in the last bit of an interpolated bound, which may be a value.
    bounds = {c: (round(lo, 6), round(hi, 6)) for c, (lo, hi) in Q.clip_bounds(raw, MEASURES, 0.95).items()}
    return quality.clip_report(raw, bounds)
