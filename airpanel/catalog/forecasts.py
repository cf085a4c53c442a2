"""Forecast metrics, forecast jobs and serving tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from airpanel.catalog import expected as X
from airpanel.catalog.common import (
    MEASURES, MODELS, SQL_CATEGORY_BANDED, SQL_CATEGORY_INDEX, SQL_FORECASTS, SQL_STATIONS, forecasts, query,
    rd, rds, scored, sq, sqs, stations, with_sql,
)
from airpanel.catalog.graphs import DEGREE, NORMAL, _sql_edges
from airpanel.catalog.panel import SCORED, SPLIT
from airpanel.catalog.scalars import _sql_map
from airpanel.operators import features as ft
from airpanel.operators import autoregression, boosting, forecast, graph, metrics, serving, splits
from airpanel.operators.chunks import windowed
from airpanel.operators.rows import left_join_default
from airpanel.session import materialize

ID = ["node_id", "timestamp"]
W = "PARTITION BY node_id ORDER BY timestamp"
GAP = f"abs(({SQL_CATEGORY_INDEX.format('y_true')}) - ({SQL_CATEGORY_INDEX.format('y_pred')}))"
SQL_METRICS = {
    "mae": "avg(abs(y_true - y_pred))",
    "rmse": "sqrt(avg((y_true - y_pred) ** 2))",
    "mape": "avg(abs((y_true - y_pred) / (y_true + 1e-8))) * 100",
    "r2": "1 - sum((y_true - y_pred) ** 2) / (var_pop(y_true) * count(*))",
    "category_accuracy": f"avg(CASE WHEN {GAP} = 0 THEN 1.0 ELSE 0.0 END)",
    "adjacent_category_accuracy": f"avg(CASE WHEN {GAP} <= 1 THEN 1.0 ELSE 0.0 END)",
    "skill_score": """CASE WHEN avg((y_true - y_baseline) ** 2) = 0 THEN 0
        ELSE 1 - avg((y_true - y_pred) ** 2) / avg((y_true - y_baseline) ** 2) END""",
}


def _metric_sql(*names: str) -> str:
    columns = ", ".join(f"{sq(SQL_METRICS[n])} AS {n}" for n in names)
    return with_sql(SQL_FORECASTS, select=f"SELECT model, {columns} FROM forecasts GROUP BY model")


def _metric(name, expr):
    @query(name, _metric_sql(name))
    def run(spark, sf):
        return forecasts(spark, sf).groupBy("model").agg(rd(expr()).alias(name))


_metric("mae", metrics.mae)
_metric("rmse", metrics.rmse)
_metric("mape", metrics.mape)
_metric("r2", metrics.r2)
_metric("category_accuracy", metrics.category_accuracy)
_metric("adjacent_category_accuracy", metrics.adjacent_category_accuracy)
_metric("skill_score", metrics.skill_score)


@query("all_metrics", _metric_sql(*SQL_METRICS))
def _(spark, sf):
    out = metrics.all_metrics(forecasts(spark, sf), baseline="y_baseline")
    return out.select("model", *rds(SQL_METRICS))


STEPS = [1, 6, 12, 24]


def _sql_horizons() -> str:
    parts = []
    for h in STEPS:
        for model, guess in (("seasonal", f"lag(aqi, {24 - h}) OVER w"), ("last", "aqi")):
            parts.append(f"""SELECT '{model}' AS model, {h} AS h, lead(aqi, {h}) OVER w AS y_true, {guess} AS y_pred,
                row_number() OVER w AS i, count(*) OVER (PARTITION BY node_id) AS n FROM scored WINDOW w AS ({W})""")
    return " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


@query("horizon_metrics", with_sql(SCORED, f"steps AS ({_sql_horizons()})", select=f"""
    SELECT model, h, {sq(SQL_METRICS['mae'])} AS mae, {sq(SQL_METRICS['rmse'])} AS rmse,
           {sq(SQL_METRICS['category_accuracy'])} AS category_accuracy
    FROM steps WHERE i >= 24 AND n - i >= 24 GROUP BY 1, 2"""))
def _(spark, sf):
    ahead = {f"t{h}": (lambda w, h=h: F.lead("aqi", h).over(w)) for h in STEPS}
    back = {f"s{h}": (lambda w, h=h: F.lag("aqi", 24 - h).over(w)) for h in STEPS}
    rows = windowed(
        scored(spark, sf).select(*ID, "aqi"), {**ahead, **back, "first": lambda w: F.lag("aqi", 23).over(w)},
        lookback=23, lookahead=24,
    ).where("t24 IS NOT NULL AND first IS NOT NULL")

    def at(columns):  # an array of 24 steps of which only the wanted ones are filled
        return F.array(*[columns.get(h, F.lit(None).cast("double")) for h in range(1, 25)])

    models = F.array(
        F.struct(F.lit("seasonal").alias("model"), at({h: F.col(f"s{h}") for h in STEPS}).alias("y_pred")),
        F.struct(F.lit("last").alias("model"), at({h: F.col("aqi") for h in STEPS}).alias("y_pred")),
    )
    rows = rows.select(at({h: F.col(f"t{h}") for h in STEPS}).alias("y_true"), F.inline(models))
    out = metrics.horizon_metrics(rows, horizons=[*STEPS, 48])
    return out.select("model", "h", *rds(["mae", "rmse", "category_accuracy"]))


@query("node_mae", with_sql(SQL_FORECASTS, f"""
    firsts AS (SELECT model, node_id, y_true, y_pred, row_number() OVER (PARTITION BY model, node_id ORDER BY timestamp) AS i FROM forecasts),
    maes AS (SELECT model, node_id, avg(abs(y_true - y_pred)) AS mae FROM firsts WHERE i <= 24 GROUP BY 1, 2 HAVING count(*) = 24)""",
    select=f"""SELECT model, node_id, {sq('mae')} AS mae FROM maes
               UNION ALL SELECT model, 'average', {sq('avg(mae)')} FROM maes GROUP BY 1"""))
def _(spark, sf):
    rows = materialize(forecasts(spark, sf).select("model", *ID, "y_true", "y_pred"), "models")
    return metrics.node_mae(rows, by=["model"]).select("model", "node_id", rd("mae").alias("mae"))


@query("combined_loss", with_sql(SQL_FORECASTS, select="SELECT model, " + ", ".join(
    sq(f"{a}::DOUBLE * avg(abs(y_pred - y_true)) + (1 - {a}::DOUBLE) * avg(abs(y_pred - y_true) / (abs(y_true) + 1)) * 100")
    + f" AS {n}" for n, a in (("loss_07", 0.7), ("loss_08", 0.8))) + " FROM forecasts GROUP BY 1"))
def _(spark, sf):
    return forecasts(spark, sf).groupBy("model").agg(
        rd(metrics.combined_loss()).alias("loss_07"), rd(metrics.combined_loss(alpha=0.8)).alias("loss_08")
    )


@query("category_error_breakdown", with_sql(SQL_FORECASTS, select="SELECT model, " + ", ".join(
    f"{sq(f'avg(CASE WHEN {GAP} {c} THEN 1.0 ELSE 0.0 END) * 100')} AS {n}"
    for n, c in (("correct", "= 0"), ("off_by_one", "= 1"), ("wrong", ">= 2"))) + " FROM forecasts GROUP BY 1"))
def _(spark, sf):
    out = metrics.category_error_breakdown(forecasts(spark, sf))
    return out.select("model", *rds(["correct", "off_by_one", "wrong"]))


@query("ensemble_mean", with_sql(SQL_FORECASTS, select=f"""
    SELECT node_id, timestamp, {sq('min(y_true)')} AS y_true, {sq('avg(y_pred)')} AS y_pred FROM forecasts GROUP BY 1, 2"""))
def _(spark, sf):
    return metrics.ensemble_mean(forecasts(spark, sf), ID).select(*ID, *rds(["y_true", "y_pred"]))


TARGETS = {"lag1": 30.0, "lag24": 20.0}


@query("comparison_table", with_sql(SQL_FORECASTS, "m AS (SELECT model, " + ", ".join(
    f"{e} AS {n}" for n, e in SQL_METRICS.items()) + " FROM forecasts GROUP BY 1)", select="""
    SELECT model AS "Model", printf('%.2f', mae) AS "MAE", printf('%.2f', rmse) AS "RMSE",
           printf('%.2f', mape) AS "MAPE (%)", printf('%.4f', r2) AS "R²",
           printf('%.1f', category_accuracy * 100) || '%' AS "Category Accuracy",
           printf('%.1f', adjacent_category_accuracy * 100) || '%' AS "Adjacent Cat. Acc.",
           CASE model WHEN 'lag1' THEN '≤30' WHEN 'lag24' THEN '≤20' ELSE 'N/A' END AS "Target MAE",
           CASE WHEN mae <= CASE model WHEN 'lag1' THEN 30 WHEN 'lag24' THEN 20 ELSE 999 END THEN 'Yes' ELSE 'No' END AS "Target Met"
    FROM m"""))
def comparison(spark, sf):
    return metrics.comparison_table(metrics.all_metrics(forecasts(spark, sf)), TARGETS)


@query("aligned_forecasts", with_sql(SQL_FORECASTS, select=f"""
    SELECT timestamp, node_id, {sq('max(y_true)')} AS actual, """ + ", ".join(
    f"{sq(f'''max(y_pred) FILTER (model = '{m}')''')} AS {m}" for m in MODELS) + " FROM forecasts GROUP BY 1, 2"))
def _(spark, sf):
    out = metrics.aligned_forecasts(forecasts(spark, sf), MODELS)
    return out.select("timestamp", "node_id", *rds(["actual", *MODELS]))


# -- forecast jobs

def _sql_ar(horizon: int) -> str:
    return f"""
    pairs AS (SELECT node_id, timestamp, aqi, lag(aqi) OVER ({W}) AS before FROM scored),
    fitted AS (SELECT node_id, regr_slope(aqi, before) AS phi, regr_intercept(aqi, before) AS c,
                      arg_max(aqi, timestamp) AS y, max(timestamp) AS t FROM pairs GROUP BY 1),
    ar AS (SELECT node_id, CAST(h AS INT) AS h, t + to_hours(CAST(h AS INT)) AS timestamp, t,
                  coalesce(CASE WHEN phi = 1 THEN y + c * h ELSE c * (1 - phi ** h) / (1 - phi) + phi ** h * y END, y) AS y_pred
           FROM fitted, (SELECT unnest(range(1, {horizon + 1})) AS h) hs)"""


@query("forecast_ar", with_sql(SCORED, _sql_ar(24), select=f"SELECT node_id, h, timestamp, {sq('y_pred')} AS y_pred FROM ar"))
def _(spark, sf):
    return forecast.forecast_ar(scored(spark, sf)).withColumn("y_pred", rd("y_pred"))


def _sql_sar(source: str, where: str = "TRUE", season: int = 24, top: int = 5, horizon: int = 24) -> str:
    """Yule-Walker fits by the recursion spelled out order by order, and forecasts step by step."""
    lags = season + top
    ctes = [f"""
    kept AS (SELECT node_id, timestamp, aqi, row_number() OVER ({W}) AS i, count(*) OVER (PARTITION BY node_id) AS n,
                    avg(aqi) OVER (PARTITION BY node_id) AS m FROM {source} WHERE {where}),
    lags AS (SELECT unnest(range(0, {lags + 1})) AS k),
    products AS (SELECT a.node_id, k, sum((a.aqi - a.m) * (b.aqi - b.m)) / any_value(a.n) AS g
                 FROM kept a, lags JOIN kept b ON b.node_id = a.node_id AND b.i = a.i - k GROUP BY 1, 2),
    nodes AS (SELECT node_id, any_value(n) AS n, any_value(m) AS m, max(timestamp) AS t FROM kept GROUP BY 1),
    spans AS (SELECT node_id, any_value(n) AS n, any_value(m) AS m, any_value(t) AS t, list(coalesce(g, 0) ORDER BY k) AS g
              FROM nodes CROSS JOIN lags LEFT JOIN products USING (node_id, k) GROUP BY 1),
    tried AS (SELECT *, 0.0::DOUBLE AS s, 1 AS extra, g[1:{top + 1}] AS c FROM spans
              UNION ALL SELECT *, g[{season + 1}] / g[1] AS s, 2 AS extra,
                  [(1 + (g[{season + 1}] / g[1]) ** 2) * g[k + 1] - g[{season + 1}] / g[1] * (g[{season} + k + 1] + g[{season} - k + 1]) for k in range(0, {top + 1})] AS c
              FROM spans WHERE n >= {2 * season} AND g[1] > 0 AND g[{season + 1}] <> 0),
    level0 AS (SELECT *, []::DOUBLE[] AS a, c[1] AS e, 0 AS p FROM tried)"""]
    for k in range(1, top + 1):
        earlier = " + ".join(f"a[{j}] * c[{k - j + 1}]" for j in range(1, k)) or "0"
        new = ", ".join([*(f"a[{j}] - r * a[{k - j}]" for j in range(1, k)), "r"])
        ctes.append(f"""
    level{k} AS (SELECT * EXCLUDE (r, a, e, p), [{new}] AS a, e * (1 - r * r) AS e, {k} AS p FROM
      (SELECT *, CASE WHEN e > 1e-12 * g[1] THEN (c[{k + 1}] - ({earlier})) / e ELSE 0 END AS r FROM level{k - 1}))""")
    every = " UNION ALL ".join(f"SELECT node_id, n, m, t, g, s, extra, a, e, p FROM level{k}" for k in range(top + 1))
    ctes.append(f"""
    models AS (SELECT *, n * ln(greatest(e, g[1] * 1e-12, 1e-300)) + 2 * (p + extra) AS criterion FROM ({every}) WHERE p < n),
    chosen AS (SELECT *, [{", ".join(_cells(season, top))}] AS w FROM models
               QUALIFY row_number() OVER (PARTITION BY node_id ORDER BY round(criterion, 6), p, abs(s)) = 1),
    ends AS (SELECT node_id, list(aqi - m ORDER BY i) AS known FROM kept WHERE i > n - {lags} GROUP BY 1),
    step0 AS (SELECT node_id, m, t, p, s, w, list_concat([0.0::DOUBLE for x in range(0, {lags} - len(known))], known) AS v FROM chosen JOIN ends USING (node_id))""")
    for h in range(1, horizon + 1):
        ctes.append(f"""
    step{h} AS (SELECT * EXCLUDE (v), list_append(v, list_inner_product(list_reverse(w), v[{h}:{h + lags - 1}])) AS v FROM step{h - 1})""")
    ctes.append(f"""
    sar AS (SELECT node_id, CAST(h AS INT) AS h, t + to_hours(CAST(h AS INT)) AS timestamp, m + v[{lags} + h] AS y_pred
            FROM step{horizon}, (SELECT unnest(range(1, {horizon + 1})) AS h) hs)""")
    return ",".join(ctes)


def _cells(season: int, top: int) -> list[str]:
    """The weights of all lags, from those of the order (``a``) and the season (``s``)."""
    return [
        f"coalesce(a[{j}], 0)" if j <= top else "s" if j == season else f"-s * coalesce(a[{j - season}], 0)" if j > season else "0.0"
        for j in range(1, season + top + 1)
    ]


@query("forecast_sar", with_sql(SCORED, _sql_sar("scored"), select=f"SELECT node_id, h, timestamp, {sq('y_pred', 5)} AS y_pred FROM sar"))
def _(spark, sf):
    made = autoregression.forecast_seasonal_ar(scored(spark, sf).select(*ID, "aqi"))
    return made.withColumn("y_pred", rd("y_pred", 5))


@query("sar_order", with_sql(SCORED, _sql_sar("scored", horizon=0), select=f"""
    SELECT node_id, n, p AS "order", {sq('s')} AS seasonal, {sq('e', 4)} AS error, {sq('criterion', 3)} AS criterion FROM chosen"""))
def _(spark, sf):
    fitted = autoregression.fit_seasonal_ar(scored(spark, sf).select(*ID, "aqi"))
    return fitted.select("node_id", "n", "order", rd("seasonal").alias("seasonal"), rd("error", 4).alias("error"), rd("criterion", 3).alias("criterion"))


@query("forecast_sar_mae", with_sql(SPLIT, _sql_sar("parts", "split = 'train'"), f"""
    tests AS (SELECT node_id, aqi AS y_true, row_number() OVER ({W}) AS h FROM parts WHERE split = 'test'),
    maes AS (SELECT node_id, avg(abs(y_true - y_pred)) AS mae FROM tests JOIN sar USING (node_id, h) GROUP BY 1 HAVING count(*) = 24)""", select=f"""
    SELECT node_id, {sq('mae', 5)} AS mae FROM maes UNION ALL SELECT 'average', {sq('avg(mae)', 5)} FROM maes"""))
def _(spark, sf):
    parts = splits.chrono_split(materialize(scored(spark, sf).select(*ID, "aqi"), "scored"))
    rows = materialize(autoregression.holdout_seasonal_ar(parts), "held")
    return metrics.node_mae(rows).select("node_id", rd("mae", 5).alias("mae"))


@query("forecast_seasonal", with_sql(SCORED, f"""
    tail AS (SELECT node_id, aqi, 25 - row_number() OVER (PARTITION BY node_id ORDER BY timestamp DESC) AS step FROM scored)""",
    select=f"""SELECT node_id, CAST(step + 24 * k AS INT) AS h, {sq('aqi')} AS y_pred
               FROM tail, (SELECT unnest([0, 1]) AS k) ks WHERE step BETWEEN 1 AND 24"""))
def _(spark, sf):
    return forecast.forecast_seasonal(scored(spark, sf), horizon=48).withColumn("y_pred", rd("y_pred"))


POOLED = ["aqi", "aqi_neighbours"]


def _sql_pooled() -> str:
    """Two features: the weights are the solution of two equations in variances and covariances."""
    fits, made = [], []
    for h in STEPS:
        y = f"y{h}"
        fits.append(f"""SELECT {h} AS h, avg(aqi) AS m1, avg(nb) AS m2, avg({y}) AS my, var_pop(aqi) AS s11, var_pop(nb) AS s22,
            covar_pop(aqi, nb) AS s12, covar_pop(aqi, {y}) AS c1, covar_pop(nb, {y}) AS c2
            FROM looked WHERE s{h} = 'train' AND {y} IS NOT NULL""")
        made.append(f"SELECT node_id, timestamp, {h} AS h, aqi, nb, {y} AS y_true FROM looked WHERE split = 'test' AND {y} IS NOT NULL")
    ahead = ", ".join(f"lead(aqi, {h}) OVER ({W}) AS y{h}, lead(split, {h}) OVER ({W}) AS s{h}" for h in STEPS)
    return with_sql(
        SPLIT, SQL_STATIONS, _sql_edges(10), DEGREE, NORMAL, """
    sums AS (SELECT n.src AS node_id, timestamp, sum(weight * aqi) AS nb FROM normal n JOIN scored s ON s.node_id = n.dst GROUP BY 1, 2),
    wide AS (SELECT node_id, timestamp, split, aqi, nb FROM parts JOIN sums USING (node_id, timestamp))""",
        f"looked AS (SELECT *, {ahead} FROM wide)", f"stats AS ({' UNION ALL '.join(fits)})", """
    fitted AS (SELECT *, (c1 * s22 - c2 * s12) / (s11 * s22 - s12 * s12) AS w1, (c2 * s11 - c1 * s12) / (s11 * s22 - s12 * s12) AS w2 FROM stats)""",
        f"made AS ({' UNION ALL '.join(made)})",
        select=f"""SELECT node_id, timestamp, h, {sq('y_true')} AS y_true, {sq('my + w1 * (aqi - m1) + w2 * (nb - m2)', 5)} AS y_pred
                   FROM made JOIN fitted USING (h)""")


@query("forecast_pooled", _sql_pooled())
def _(spark, sf):
    rows = materialize(scored(spark, sf).select(*ID, "aqi"), "scored")
    edges = graph.normalize_edges(graph.adjacency_edges(stations(spark, sf)))
    wide = splits.chrono_split(rows).join(graph.graph_aggregate(rows, edges), ID)
    out = forecast.forecast_pooled(wide, POOLED)
    return out.select(*ID, "h", rd("y_true").alias("y_true"), rd("y_pred", 5).alias("y_pred"))


@query("forecast_boosted")
def _(spark, sf):
    """Trees over lags, a rolling mean and the hour; growing them is no SQL, so the tests hold them against brute force."""
    rows = scored(spark, sf, MEASURES).select(*ID, "aqi")  # what the index is made of
    lags = {**ft.lag_columns("aqi", (1, 24)), "aqi_24h_mean": lambda w: F.avg("aqi").over(w.rowsBetween(-23, 0))}
    wide = materialize(windowed(rows, lags, lookback=24).withColumn("hour", F.hour("timestamp").cast("double")), "features")
    out = boosting.forecast_boosted(splits.chrono_split(wide), ["aqi", "aqi_lag_1h", "aqi_lag_24h", "aqi_24h_mean", "hour"], trees=6)
    return out.select(*ID, "h", rd("y_true").alias("y_true"), rd("y_pred").alias("y_pred"))


SQL_HOLDOUT = f"""
    pairs AS (SELECT node_id, timestamp, aqi, lag(aqi) OVER ({W}) AS before FROM parts WHERE split = 'train'),
    fitted AS (SELECT node_id, regr_slope(aqi, before) AS phi, regr_intercept(aqi, before) AS c, arg_max(aqi, timestamp) AS y FROM pairs GROUP BY 1),
    tests AS (SELECT node_id, timestamp, aqi AS y_true, row_number() OVER ({W}) AS h FROM parts WHERE split = 'test'),
    heldout AS (SELECT node_id, timestamp, h, y_true,
                    coalesce(CASE WHEN phi = 1 THEN y + c * h ELSE c * (1 - phi ** h) / (1 - phi) + phi ** h * y END, y) AS y_pred
             FROM tests JOIN fitted USING (node_id) WHERE h <= 24)"""


@query("forecast_ar_mae", with_sql(SPLIT, SQL_HOLDOUT, """
    maes AS (SELECT node_id, avg(abs(y_true - y_pred)) AS mae FROM heldout GROUP BY 1 HAVING count(*) = 24)""", select=f"""
    SELECT node_id, {sq('mae')} AS mae FROM maes UNION ALL SELECT 'average', {sq('avg(mae)')} FROM maes"""))
def _(spark, sf):
    parts = splits.chrono_split(materialize(scored(spark, sf).select(*ID, "aqi"), "scored"))
    rows = materialize(forecast.holdout_forecast(parts), "held")
    return metrics.node_mae(rows).select("node_id", rd("mae").alias("mae"))


SQL_BACKTEST = f"""
    numbered AS (SELECT node_id, timestamp, aqi, row_number() OVER ({W}) - 1 AS p, lag(aqi) OVER ({W}) AS before,
                        count(*) OVER (PARTITION BY node_id) AS n FROM scored),
    placed AS (SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS te, CAST(floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) AS BIGINT) AS ve FROM numbered),
    origins AS (SELECT node_id, te, ve, unnest(range(0, n - ve - 24, 24)) AS o FROM (SELECT DISTINCT node_id, te, ve, n FROM placed)),
    fitted AS (
      SELECT o.node_id, o.o // 24 AS origin, regr_slope(r.aqi, CASE WHEN r.p <> o.ve THEN r.before END) AS phi,
             regr_intercept(r.aqi, CASE WHEN r.p <> o.ve THEN r.before END) AS c, arg_max(r.aqi, r.p) AS y
      FROM origins o JOIN placed r ON r.node_id = o.node_id AND (r.p < o.te OR (r.p >= o.ve AND r.p < o.ve + o.o)) GROUP BY 1, 2),
    backtest AS (
      SELECT node_id, timestamp, origin, CAST((p - ve) % 24 + 1 AS INT) AS h, aqi AS y_true,
             coalesce(CASE WHEN phi = 1 THEN y + c * ((p - ve) % 24 + 1)
                      ELSE c * (1 - phi ** ((p - ve) % 24 + 1)) / (1 - phi) + phi ** ((p - ve) % 24 + 1) * y END, y) AS y_pred
      FROM placed JOIN fitted USING (node_id) WHERE p >= ve AND (p - ve) // 24 = origin)"""


def _backtest(spark, sf):
    return forecast.rolling_origin_forecast(scored(spark, sf).select(*ID, "aqi"))


@query("rolling_origin_forecast", with_sql(SCORED, SQL_BACKTEST, select=f"""
    SELECT node_id, timestamp, origin, h, {sq('y_true')} AS y_true, {sq('y_pred', 4)} AS y_pred FROM backtest"""))
def _(spark, sf):
    return _backtest(spark, sf).withColumns({"y_true": rd("y_true"), "y_pred": rd("y_pred", 4)})


@query("rolling_origin_metrics", with_sql(SCORED, SQL_BACKTEST, select="SELECT node_id, " + ", ".join(
    f"{sq(SQL_METRICS[n], 4)} AS {n}" for n in ("mae", "rmse", "mape", "category_accuracy")) + " FROM backtest GROUP BY 1"))
def _(spark, sf):
    names = ["mae", "rmse", "mape", "category_accuracy"]
    return metrics.all_metrics(_backtest(spark, sf), by=["node_id"]).select("node_id", *rds(names, 4))


@query("tail_context", with_sql(SCORED, select=f"""
    SELECT node_id, timestamp, {sq('aqi')} AS aqi FROM (SELECT *, row_number() OVER (PARTITION BY node_id ORDER BY timestamp DESC) AS back
    FROM scored) WHERE back <= 200"""))
def _(spark, sf):
    return ft.tail_context(scored(spark, sf).select(*ID, "aqi"), 200).withColumn("aqi", rd("aqi"))


# -- serving

@query("explode_forecast", with_sql(SCORED, _sql_ar(72), "clamped AS (SELECT *, least(greatest(y_pred, 0), 500) AS v FROM ar)", select=f"""
    SELECT node_id AS station_id, 'ar' AS model, h - 1 AS hour, t + to_hours(h - 1) AS timestamp, {sq('v', 1)} AS aqi,
           {SQL_CATEGORY_BANDED.format('v')} AS category,
           {_sql_map(SQL_CATEGORY_BANDED.format('v'), X.SERVICE_COLORS)} AS color,
           first_value({sq('v', 1)}) OVER (PARTITION BY node_id ORDER BY h) AS current_aqi
    FROM clamped"""))
def _(spark, sf):
    ar = forecast.forecast_ar(scored(spark, sf), horizon=72)
    # A forecast has 72 steps, so the list of a node is bounded.
    steps = F.sort_array(F.collect_list(F.struct("h", "y_pred")))
    base = F.timestamp_add("HOUR", F.lit(-1), F.min("timestamp"))
    one = ar.groupBy(F.col("node_id").alias("station_id")).agg(
        F.lit("ar").alias("model"), base.alias("base_time"), steps["y_pred"].alias("values")
    )
    out = serving.explode_forecast(one)
    return out.withColumns({"aqi": rd("aqi", 1), "current_aqi": rd("current_aqi", 1)})


LATEST = "latest AS (SELECT node_id, arg_max(aqi, timestamp) AS latest FROM scored GROUP BY 1)"
MARKED = "marked AS (SELECT s.node_id, lat, lon, coalesce(latest, 100) AS aqi FROM stations s LEFT JOIN latest USING (node_id))"


def _latest(spark, sf):
    return scored(spark, sf).groupBy("node_id").agg(F.max_by("aqi", "timestamp").alias("aqi"))


@query("left_join_default", with_sql(SCORED, SQL_STATIONS, LATEST, MARKED, select=f"""
    SELECT node_id, {sqs(['lat', 'lon', 'aqi'])} FROM marked"""))
def _(spark, sf):
    out = left_join_default(stations(spark, sf), _latest(spark, sf))
    return out.select("node_id", *rds(["lat", "lon", "aqi"]))


LABEL = "CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Satisfactory' WHEN aqi <= 200 THEN 'Moderate' " \
    "WHEN aqi <= 300 THEN 'Poor' WHEN aqi <= 400 THEN 'Very Poor' ELSE 'Severe' END"


@query("heatmap_points", with_sql(SCORED, SQL_STATIONS, LATEST, MARKED, select=f"""
    SELECT node_id, {sqs(['lat', 'lon', 'aqi'])}, {LABEL} AS category, {_sql_map(LABEL, X.MAP_COLORS)} AS color,
           {_sql_map(LABEL, X.ADVISORIES)} AS advisory, {sq('least(25, greatest(8, 8 + aqi / 500 * 17))')} AS radius,
           {sq('aqi / 500')} AS intensity FROM marked"""))
def _(spark, sf):
    out = serving.heatmap_points(stations(spark, sf), _latest(spark, sf))
    return out.select(
        "node_id", *rds(["lat", "lon", "aqi"]), "category", "color", "advisory", *rds(["radius", "intensity"])
    )


@query("station_dim", with_sql(SQL_STATIONS, select="""
    SELECT node_id AS station_id, name, count(*) OVER () AS count FROM stations"""))
def _(spark, sf):
    dim = stations(spark, sf).select(F.col("node_id").alias("station_id"), "name")
    return serving.station_dim(dim)
