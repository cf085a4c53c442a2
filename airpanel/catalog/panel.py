"""Grid, gap filling, windows, splits and the composed feature jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from airpanel.catalog import expected as X
from airpanel.catalog.common import (
    ALL, MEASURES, query, rd, rds, readings, scored, sparse, sq, sql_aqi, sql_clean,
    sql_ffill, sql_grid, sql_interpolate, sql_readings, sql_scored, sqs, with_sql,
)
from airpanel.catalog.scalars import (
    DOW, SQL_CYCLES, SQL_FLAGS, SQL_SEASONS, SQL_WEATHER, SQL_WIND, _named,
)
from airpanel.functions.clock import hour_index
from airpanel.operators import features as ft
from airpanel.operators import gaps, splits
from airpanel.plans import panel as plans
from airpanel.session import materialize

ID = ["node_id", "timestamp"]
SPARSE = sql_readings(thin=True)
W = "PARTITION BY node_id ORDER BY timestamp"


def _raw(spark, sf, thin=True):
    return materialize(readings(spark, sf, thin), "readings")


@query("hourly_grid", with_sql(SPARSE, sql_grid(), select=f"SELECT node_id, timestamp, {', '.join(ALL)} FROM grid"))
def _(spark, sf):
    return gaps.hourly_grid(_raw(spark, sf))


@query("ffill_limit", with_sql(SPARSE, sql_grid(columns=MEASURES), sql_ffill("grid", MEASURES, 3, "held"),
       select=f"SELECT node_id, timestamp, {', '.join(MEASURES)} FROM held"))
def _(spark, sf):
    grid = gaps.hourly_grid(_raw(spark, sf), MEASURES)
    return gaps.ffill_limit(grid, MEASURES, 3, position=hour_index("timestamp"))


ROWS = f"rows_ AS (SELECT *, row_number() OVER ({W}) AS i FROM readings)"


@query("interpolate_limit", with_sql(SPARSE, ROWS, sql_interpolate("rows_", ["o3"], 9, "lines"),
       select=f"SELECT node_id, timestamp, {sq('o3')} AS o3 FROM lines"))
def _(spark, sf):
    r = _raw(spark, sf).select(*ID, "o3")
    return gaps.interpolate_limit(r, ["o3"], 9).withColumn("o3", rd("o3"))


@query("ffill_bfill", with_sql(SPARSE, select=f"""
    SELECT node_id, timestamp, coalesce(
      last_value(o3 IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(o3 IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS o3
    FROM readings"""))
def _(spark, sf):
    return gaps.ffill_bfill(_raw(spark, sf).select(*ID, "o3"), ["o3"])


@query("clean_panel", with_sql(SPARSE, sql_clean(), select=f"SELECT node_id, timestamp, {sqs(ALL)} FROM clean"))
def _(spark, sf):
    return gaps.clean_panel(_raw(spark, sf)).select(*ID, *rds(ALL))


def _sql_fill_both(source: str, columns, limit: int, name: str) -> str:
    fills = ", ".join(
        f"""coalesce(last_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                     first_value({c} IGNORE NULLS) OVER ({W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}"""
        for c in columns
    )
    return f"""numbered AS (SELECT *, row_number() OVER ({W}) AS i FROM {source}),
    {sql_interpolate('numbered', columns, limit, 'lines')},
    {name} AS (SELECT * REPLACE ({fills}) FROM lines)"""


MET = ["temperature", "humidity", "wind_speed"]
STATIONS_RAW = SPARSE + """,
    raw AS (SELECT * REPLACE (pm25 - 20 AS pm25, CASE WHEN node_id = 'N02' THEN NULL ELSE o3 END AS o3) FROM readings)"""


def _station_rows(spark, sf):
    """Rows with negatives, and one station without a single o3 value."""
    r = sparse(spark, sf).withColumns({
        "pm25": F.col("pm25") - 20, "o3": F.when(F.col("node_id") != "N02", F.col("o3")),
    })
    return materialize(r, "stations")


def _sql_stations() -> str:
    top = ", ".join(f"quantile_cont({c}, 0.999) FILTER ({c} >= 0) AS {c}_top" for c in MEASURES)
    cut = ", ".join(f"CASE WHEN {c} >= 0 AND {c} <= {c}_top * 2 THEN {c} END AS {c}" for c in MEASURES)
    mid = ", ".join(f"median({c}) AS {c}_mid" for c in MEASURES)
    out = ", ".join(f"{sq(f'coalesce({c}, {c}_mid)')} AS {c}" for c in MEASURES)
    return with_sql(
        STATIONS_RAW, f"tops AS (SELECT {top} FROM raw)",
        f"cut AS (SELECT * REPLACE ({cut}) FROM raw, tops)",
        _sql_fill_both("cut", MEASURES + MET, 6, "filled"),
        "kept AS (SELECT * FROM filled WHERE pm25 IS NOT NULL OR pm10 IS NOT NULL)",
        f"mids AS (SELECT {mid} FROM kept)",
        select=f"SELECT node_id, timestamp, {out}, {sqs(MET)} FROM kept, mids",
    )


@query("clean_stations", _sql_stations())
def _(spark, sf):
    return plans.clean_stations(_station_rows(spark, sf)).select(*ID, *rds(MEASURES + MET))


CAPPED = MEASURES + MET


def _sql_capped(name: str = "capped") -> str:
    top = ", ".join(f"quantile_cont({c}, 0.999) FILTER ({c} >= 0) AS {c}_top" for c in CAPPED)
    cut = ", ".join(
        f"CASE WHEN {c} < 0 THEN NULL WHEN {c}_top > 0 AND {c} > {c}_top * 1.5 THEN {c}_top * 1.5 ELSE {c} END AS {c}"
        for c in CAPPED
    )
    mid = ", ".join(f"median({c}) AS {c}_mid" for c in CAPPED)
    out = ", ".join(f"coalesce({c}, {c}_mid) AS {c}" for c in CAPPED)
    return ", ".join([
        STATIONS_RAW, f"tops AS (SELECT {top} FROM raw)",
        f"cut AS (SELECT * REPLACE ({cut}) FROM raw, tops)",
        _sql_fill_both("cut", CAPPED, 12, "filled"),
        f"mids AS (SELECT {mid} FROM filled)",
        f"{name} AS (SELECT node_id, timestamp, {out} FROM filled, mids)",
    ])


@query("clean_capped", with_sql(_sql_capped(), select=f"SELECT node_id, timestamp, {sqs(CAPPED)} FROM capped"))
def _(spark, sf):
    return plans.clean_capped(_station_rows(spark, sf)).select(*ID, *rds(CAPPED))


SCORED = sql_scored()


def _score(spark, sf):
    return scored(spark, sf).select(*ID, "pm25", "aqi")


LAGGED = ["aqi_lag_1h", "aqi_lag_6h", "aqi_lag_24h"]


@query("lag_features", with_sql(SCORED, select=f"""
    SELECT node_id, timestamp, {', '.join(f"{sq(f'lag(aqi, {k}) OVER ({W})')} AS aqi_lag_{k}h" for k in (1, 6, 24))}
    FROM scored"""))
def _(spark, sf):
    return ft.lag_features(_score(spark, sf)).select(*ID, *rds(LAGGED))


def _sql_filled_lags() -> str:
    return ", ".join(
        f"{sq(f'coalesce(lag({c}, {k}) OVER ({W}), {c}_mid)')} AS {c}_lag_{k}h"
        for k in X.LONG_LAGS for c in ("aqi", "pm25")
    )


@query("lag_median_filled", with_sql(
    SCORED, "mids AS (SELECT median(aqi) AS aqi_mid, median(pm25) AS pm25_mid FROM scored)",
    select=f"SELECT node_id, timestamp, {_sql_filled_lags()} FROM scored, mids"))
def _(spark, sf):
    out = ft.lag_median_filled(_score(spark, sf))
    return out.select(*ID, *rds([c for c in out.columns if "_lag_" in c]))


def _sql_over(fn: str, c: str, n: int) -> str:
    return f"{fn}({c}) OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _sql_means(columns, windows) -> str:
    return ", ".join(f"{sq(_sql_over('avg', c, n), 5)} AS {c}_{n}h_mean" for c in columns for n in windows)


def _sql_stds(columns, windows) -> str:
    return ", ".join(f"{sq(_sql_over('stddev_samp', c, n), 4)} AS {c}_{n}h_std" for c in columns for n in windows)


@query("rolling_mean", with_sql(SCORED, select=f"""
    SELECT node_id, timestamp, {_sql_means(['pm25', 'aqi'], [6, 12, 24, 72])} FROM scored"""))
def _(spark, sf):
    out = ft.rolling_features(_score(spark, sf), ["pm25", "aqi"], [6, 12, 24, 72])
    return out.select(*ID, *rds([c for c in out.columns if c.endswith("_mean")], 5))


@query("rolling_std", with_sql(SCORED, select=f"""
    SELECT node_id, timestamp, {_sql_stds(['pm25', 'aqi'], [24, 72])} FROM scored"""))
def _(spark, sf):
    out = ft.rolling_features(_score(spark, sf), ["pm25", "aqi"])
    return out.select(*ID, *rds([c for c in out.columns if c.endswith("_std")], 4))


@query("rate_of_change", with_sql(SCORED, select=f"""
    SELECT node_id, timestamp, {sq(f'coalesce(aqi - lag(aqi) OVER ({W}), 0)')} AS aqi_diff FROM scored"""))
def _(spark, sf):
    return ft.rate_of_change(_score(spark, sf)).select(*ID, rd("aqi_diff").alias("aqi_diff"))


# -- windows: lists are compared by size, ends and sum.

def _ahead(fn: str, c: str, a: int, b: int) -> str:
    return f"{fn}({c}) OVER ({W} ROWS BETWEEN {a} FOLLOWING AND {b} FOLLOWING)"


def _digest(df, first: str, last: str):
    total = F.aggregate("x", F.lit(0.0), lambda s, r: s + r[first])
    return df.select(
        *ID, F.size("x").alias("n_x"), F.size("y").alias("n_y"),
        rd(F.col("x")[0][last]).alias("x_first"), rd(F.element_at("x", -1)[last]).alias("x_last"),
        rd(total, 4).alias("x_sum"), rd(F.col("y")[0]).alias("y_first"),
        rd(F.element_at("y", -1)).alias("y_last"),
        rd(F.aggregate("y", F.lit(0.0), lambda s, v: s + v), 4).alias("y_sum"),
    )


@query("sliding_windows", with_sql(SCORED, select=f"""
    SELECT * EXCLUDE (n) FROM (SELECT node_id, timestamp, 72 AS n_x, 24 AS n_y, {sq('aqi')} AS x_first,
      {sq(f'lead(aqi, 71) OVER ({W})')} AS x_last, {sq(_ahead('sum', 'pm25', 0, 71), 4)} AS x_sum,
      {sq(f'lead(aqi, 72) OVER ({W})')} AS y_first, {sq(f'lead(aqi, 95) OVER ({W})')} AS y_last,
      {sq(_ahead('sum', 'aqi', 72, 95), 4)} AS y_sum, {_ahead('count', '*', 72, 95)} AS n FROM scored) WHERE n = 24"""))
def _(spark, sf):
    return _digest(ft.sliding_windows(_score(spark, sf), ["pm25", "aqi"]), "pm25", "aqi")


@query("single_target_windows", with_sql(SCORED, select=f"""
    SELECT node_id, timestamp, 72 AS n_x, {sq('aqi')} AS x_first, x_sum, {sq('target')} AS y FROM (
      SELECT node_id, timestamp, aqi, {sq(_ahead('sum', 'pm25', 0, 71), 4)} AS x_sum,
             lead(aqi, 95) OVER ({W}) AS target FROM scored) WHERE target IS NOT NULL"""))
def _(spark, sf):
    out = ft.single_target_windows(_score(spark, sf), ["pm25", "aqi"])
    total = F.aggregate("x", F.lit(0.0), lambda s, r: s + r["pm25"])
    return out.select(
        *ID, F.size("x").alias("n_x"), rd(F.col("x")[0]["aqi"]).alias("x_first"),
        rd(total, 4).alias("x_sum"), rd("y").alias("y"),
    )


@query("matrix_windows", with_sql(SCORED, select=f"""
    SELECT * EXCLUDE (n) FROM (SELECT node_id, timestamp, 48 AS steps, 3 AS entities, 24 AS n_y,
      {sq('pm25')} AS cell_0_0, {sq(f'lead(no2, 10) OVER ({W})')} AS cell_10_1, {sq(f'lead(aqi, 47) OVER ({W})')} AS cell_47_2,
      {sq(f'lead(aqi, 71) OVER ({W})')} AS y_last, {_ahead('count', '*', 48, 71)} AS n FROM scored) WHERE n = 24"""))
def _(spark, sf):
    rows = scored(spark, sf).select(*ID, "pm25", "no2", "aqi")
    out = ft.matrix_windows(rows, ["pm25", "no2", "aqi"], window=48, horizon=24)
    return out.select(
        *ID, F.size("x").alias("steps"), F.size(F.col("x")[0]).alias("entities"), F.size("y").alias("n_y"),
        rd(F.col("x")[0][0]).alias("cell_0_0"), rd(F.col("x")[10][1]).alias("cell_10_1"),
        rd(F.col("x")[47][2]).alias("cell_47_2"), rd(F.element_at("y", -1)).alias("y_last"),
    )


@query("persistence_circular", with_sql(SCORED, f"""
    numbered AS (SELECT node_id, timestamp, aqi, row_number() OVER ({W}) - 1 AS position,
                        count(*) OVER (PARTITION BY node_id) AS n FROM scored)""", select=f"""
    SELECT a.node_id, a.timestamp, a.position, {sq('a.aqi')} AS aqi, {sq('b.aqi')} AS y_pred
    FROM numbered a JOIN numbered b ON a.node_id = b.node_id AND b.position = (a.position - 24 + 24 * a.n) % a.n"""))
def _(spark, sf):
    out = ft.persistence_circular(_score(spark, sf))
    return out.select(*ID, "position", *rds(["aqi", "y_pred"]))


SPLIT = SCORED + """,
    counted AS (SELECT *, row_number() OVER (ORDER BY timestamp, node_id) - 1 AS i, count(*) OVER () AS n FROM scored),
    parts AS (SELECT *, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train'
                             WHEN i < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
              FROM counted)"""


@query("persistence_last", with_sql(SPLIT, select=f"""
    SELECT node_id, CAST(h AS INT) AS h, {sq('y')} AS y_pred
    FROM (SELECT node_id, arg_max(aqi, timestamp) AS y FROM parts WHERE split = 'train' GROUP BY 1),
         (SELECT unnest(range(1, 25)) AS h) hs"""))
def _(spark, sf):
    train = splits.chrono_split(_score(spark, sf)).where("split = 'train'")
    return ft.persistence_last(train).withColumn("y_pred", rd("y_pred"))


def _sql_origins(tail: int, context: int) -> str:
    return with_sql(SCORED, f"""
    numbered AS (SELECT node_id, timestamp, aqi, row_number() OVER ({W}) - 1 AS p,
                        count(*) OVER (PARTITION BY node_id) AS n FROM scored),
    ends AS (SELECT DISTINCT node_id, n, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS te,
                    CAST(floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) AS ve FROM numbered),
    origins AS (SELECT node_id, te, ve, unnest(range(0, n - ve - 24, 24)) AS o FROM ends),
    context AS (
      SELECT o.node_id, o.o // 24 AS origin, r.timestamp, r.aqi,
             row_number() OVER (PARTITION BY o.node_id, o.o ORDER BY r.p DESC) AS back
      FROM origins o JOIN numbered r ON r.node_id = o.node_id
       AND ((r.p >= o.te - {tail} AND r.p < o.te) OR (r.p >= o.ve AND r.p < o.ve + o.o)))""", select=f"""
    SELECT node_id, origin, count(*) AS context_rows, min(timestamp) AS context_from, max(timestamp) AS context_to,
           {sq('avg(aqi)', 5)} AS context_mean, {sq('arg_max(aqi, timestamp)')} AS context_last
    FROM context WHERE back <= {context} GROUP BY 1, 2""")


def _origins(spark, sf, **limits):
    out = ft.rolling_origin(_score(spark, sf), **limits)
    return out.withColumns({
        "context_mean": rd("context_mean", 5), "context_last": rd("context_last"),
    })


@query("rolling_origin", _sql_origins(10**9, 10**9))
def _(spark, sf):
    return _origins(spark, sf)


@query("rolling_origin_limited", _sql_origins(100, 130))
def _(spark, sf):
    return _origins(spark, sf, train_tail=100, context=130)


@query("chrono_split", with_sql(SPLIT, select="SELECT node_id, timestamp, split FROM parts"))
def _(spark, sf):
    return splits.chrono_split(_score(spark, sf)).select(*ID, "split")


# -- composed jobs

def _sql_features(source: str, clip, rolling) -> str:
    bounds = ", ".join(
        f"quantile_cont({c}, 0.999) AS {c}_hi, quantile_cont({c}, 0.001) AS {c}_lo" for c in clip
    )
    # greatest and least skip NULL, so a missing value must stay missing.
    cut = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {c}_lo), {c}_hi) END AS {c}" for c in clip)
    lags = ", ".join(f"lag(aqi, {k}) OVER ({W}) AS aqi_lag_{k}h" for k in X.LAGS)
    means = ", ".join(f"{_sql_over('avg', c, n)} AS {c}_{n}h_mean" for c in rolling for n in X.WINDOWS)
    stds = ", ".join(f"{_sql_over('stddev_samp', c, n)} AS {c}_{n}h_std" for c in rolling for n in X.WINDOWS)
    return ", ".join([
        f"bounds AS (SELECT {bounds} FROM {source})",
        f"cut AS (SELECT node_id, timestamp, {', '.join(c for c in ALL if c not in clip) + ', ' if set(ALL) - set(clip) else ''}{cut} FROM {source}, bounds)",
        f"valued AS (SELECT *, {sql_aqi()} AS aqi FROM cut)",
        f"framed AS (SELECT *, {lags}, {means}, {stds} FROM valued)",
        f"full_ AS (SELECT * FROM framed WHERE COLUMNS(*) IS NOT NULL)",
    ])


ROLLED = [f"{c}_{n}h_{s}" for c in ("pm25", "aqi") for n in X.WINDOWS for s in ("mean", "std")]
PANEL_SQL = with_sql(
    sql_readings(), sql_clean(), _sql_features("clean", ALL, ["pm25", "aqi"]),
    select=f"""SELECT node_id, timestamp, {sqs(ALL + ['aqi'] + LAGGED)}, {sqs(ROLLED, 4)}, {_named(SQL_WIND, 5)},
               {_named(SQL_CYCLES, 6)}, {_named(SQL_FLAGS)} FROM full_""",
)


@query("engineer_panel", PANEL_SQL)
def engineer_panel(spark, sf):
    out = plans.engineer_panel(_raw(spark, sf, thin=False))
    return out.select(
        *ID, *rds(ALL + ["aqi"] + LAGGED), *rds(ROLLED, 4), *rds(SQL_WIND, 5), *rds(SQL_CYCLES),
        *SQL_FLAGS,
    )


PREPARED = ", ".join([
    sql_readings(), sql_clean(), _sql_features("clean", MEASURES, ["pm25"]),
    "counted AS (SELECT *, row_number() OVER (ORDER BY timestamp, node_id) - 1 AS i, count(*) OVER () AS n FROM full_)",
    """parts AS (SELECT *, CASE WHEN i < floor(n * 0.7::DOUBLE) THEN 'train'
                              WHEN i < floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM counted)""",
])
SCALED = ["pm25", "aqi", "temperature", "aqi_lag_24h", "pm25_24h_mean", "pm25_72h_std"]


@query("prepare", with_sql(
    PREPARED, "fitted AS (SELECT " + ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max" for c in SCALED) + " FROM parts WHERE split = 'train')",
    select="SELECT node_id, timestamp, split, " + ", ".join(
        f"{sq(f'({c} - {c}_min) / CASE WHEN {c}_max = {c}_min THEN 1 ELSE {c}_max - {c}_min END', 5)} AS {c}" for c in SCALED) + " FROM parts, fitted"))
def _(spark, sf):
    out = plans.prepare(_raw(spark, sf, thin=False)).scaled
    return out.select(*ID, "split", *rds(SCALED, 5))


@query("run_summary", with_sql(PREPARED, select=f"""
    SELECT count(*) AS total_rows, count(*) FILTER (split = 'train') AS train_rows, count(*) FILTER (split = 'val') AS val_rows,
           count(*) FILTER (split = 'test') AS test_rows, 31 AS n_features,
           {sq("avg(aqi) FILTER (split = 'train')")} AS train_mean, {sq("stddev_samp(aqi) FILTER (split = 'train')")} AS train_std,
           {sq("avg(aqi) FILTER (split = 'val')")} AS val_mean, {sq("avg(aqi) FILTER (split = 'test')")} AS test_mean FROM parts"""))
def _(spark, sf):
    out = splits.run_summary(plans.prepare(_raw(spark, sf, thin=False)).full)
    means = ["train_mean", "train_std", "val_mean", "test_mean"]
    return out.select(*[c for c in out.columns if c not in means], *rds(means))


@query("node_windows", with_sql(SCORED, """
    steps AS (SELECT timestamp, count(*) AS nodes, sum(aqi) AS total, min(node_id) AS first_node FROM scored GROUP BY 1)""", select=f"""
    SELECT * EXCLUDE (n) FROM (SELECT timestamp, 12 AS n_x, 6 AS n_y, nodes AS nodes_first,
      lead(nodes, 11) OVER t AS nodes_last, first_node, {sq('sum(total) OVER (t ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)', 4)} AS x_sum,
      {sq('sum(total) OVER (t ROWS BETWEEN 12 FOLLOWING AND 17 FOLLOWING)', 4)} AS y_sum,
      count(*) OVER (t ROWS BETWEEN 12 FOLLOWING AND 17 FOLLOWING) AS n FROM steps WINDOW t AS (ORDER BY timestamp)) WHERE n = 6"""))
def _(spark, sf):
    out = ft.node_windows(scored(spark, sf).select(*ID, "aqi"), window=12, horizon=6)
    total = lambda steps: F.aggregate(
        F.flatten(steps), F.lit(0.0), lambda s, cell: s + cell["value"])
    return out.select(
        "timestamp", F.size("x").alias("n_x"), F.size("y").alias("n_y"), F.size(F.col("x")[0]).cast("bigint").alias("nodes_first"),
        F.size(F.element_at("x", -1)).cast("bigint").alias("nodes_last"), F.col("x")[0][0]["node"].alias("first_node"),
        rd(total(F.col("x")), 4).alias("x_sum"), rd(total(F.col("y")), 4).alias("y_sum"),
    )


def _sql_advanced() -> str:
    base = ["pm25", "pm10", "aqi"]
    out = [f"{sqs(CAPPED + ['aqi'])}"]
    out += [f"{sq(_sql_over('avg', c, n), 5)} AS {c}_roll_{n}h" for c in base for n in (6, 12, 24)]
    out += [
        f"{sq(f'''coalesce({_sql_over('stddev_samp', c, n)}, 0)''', 4)} AS {c}_std_{n}h"
        for c in base for n in (6, 24)
    ]
    out += [f"{sq(f'coalesce({c} - lag({c}) OVER ({W}), 0)')} AS {c}_diff" for c in base]
    out += [_sql_filled_lags()]
    out += [f"hour(timestamp) AS hour, {DOW} AS dayofweek, month(timestamp) AS month"]
    out += [_named({k: SQL_CYCLES[k] for k in ("hour_sin", "hour_cos", "month_sin", "month_cos")}, 6)]
    out += [f"{SQL_FLAGS['is_weekend']} AS is_weekend"]
    out += ["""CASE WHEN hour(timestamp) BETWEEN 7 AND 9 OR hour(timestamp) BETWEEN 17 AND 20
               THEN 1 ELSE 0 END AS is_rush_hour"""]
    out += [_named(SQL_WEATHER, 6), _named(SQL_SEASONS)]
    return with_sql(
        _sql_capped(),
        f"valued AS (SELECT * FROM (SELECT *, {sql_aqi()} AS aqi FROM capped) WHERE aqi IS NOT NULL)",
        "aqi_mids AS (SELECT median(aqi) AS aqi_mid, median(pm25) AS pm25_mid FROM valued)",
        select=f"SELECT node_id, timestamp, {', '.join(out)} FROM valued, aqi_mids",
    )


@query("engineer_advanced", _sql_advanced())
def _(spark, sf):
    out = plans.engineer_advanced(_station_rows(spark, sf).select(*ID, *CAPPED))
    base = ["pm25", "pm10", "aqi"]
    means = [f"{c}_roll_{n}h" for c in base for n in (6, 12, 24)]
    stds = [f"{c}_std_{n}h" for c in base for n in (6, 24)]
    exact = ["hour", "dayofweek", "month", "is_weekend", "is_rush_hour", *SQL_SEASONS]
    rest = [c for c in out.columns if c not in [*ID, *means, *stds, *exact]]
    return out.select(*ID, *rds(rest), *rds(means, 5), *rds(stds, 4), *exact)
