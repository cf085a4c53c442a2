"""Seasonal autoregressions of every node, with their order chosen per node.

The model of a node is ``(1 - s B^season)(1 - a1 B - ... - ap B^p)(y - mean) = e`` with ``B`` the step back by one row.
Autocovariances up to ``season + max_order`` rows come from one aggregation. The seasonal weight ``s`` is the
autocorrelation at one season; with it the autocovariances of the series without its season follow from those
of the series itself. The Levinson-Durbin recursion then yields the weights and the error variance of every
order, and the information criterion of order and season is least for the model that is kept. All of it runs
on a node's one row, in array functions.

A series in which a value is missing is taken without it, as rows, not hours, make the steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.operators.chunks import NODE, TIME, windowed, with_positions
from airpanel.operators.rows import quoted

SEASON = 24
MAX_ORDER = 5
#: Relative error variance at which a series counts as explained in full.
TINY = 1e-12


def autocovariances(df: DataFrame, column: str, lags: int, key: str = NODE, time: str = TIME, keep: int = 0, **kw) -> DataFrame:
    """(key, ``n``, ``mean``, ``covariances``, ``tail``, ``last_time``): autocovariances at lags 0 to ``lags``.

    Every one is divided by the number of values, so that they are those of a stationary series. Lags beyond the
    history are 0. ``tail`` holds the last ``keep`` values, the oldest first, fewer if there are no more.
    """
    c = quoted(column)
    rows = df.select(key, time, F.expr(f"CAST({c} AS DOUBLE) AS _y")).where("_y IS NOT NULL AND NOT isnan(_y)")
    reach = max(lags, keep - 1)
    before = {f"_y{k}": (lambda w, k=k: F.lag("_y", k).over(w)) for k in range(1, reach + 1)}
    rows = windowed(rows, before, lookback=reach, keys=[key], order=[time], **kw)
    products = [
        e for k in range(1, lags + 1) for e in (
            F.sum(F.expr(f"_y * _y{k}")).alias(f"_p{k}"), F.sum(f"_y{k}").alias(f"_b{k}"),
            F.sum(F.expr(f"CASE WHEN _y{k} IS NOT NULL THEN _y END")).alias(f"_a{k}"), F.count(f"_y{k}").alias(f"_n{k}"),
        )
    ]
    if keep:
        last = F.array(*[F.col(f"_y{k}") for k in range(keep - 1, 0, -1)], F.col("_y"))
        products.append(F.max_by(last, time).alias("_last"))
    sums = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"), F.var_pop("_y").alias("_p0"), F.max(time).alias("last_time"), *products,
    )
    mean = F.col("mean")
    covariance = [F.col("_p0")] + [
        F.coalesce((F.col(f"_p{k}") - mean * (F.col(f"_a{k}") + F.col(f"_b{k}")) + F.col(f"_n{k}") * mean * mean) / F.col("n"), F.lit(0.0))
        for k in range(1, lags + 1)
    ]
    tail = [F.array_compact("_last").alias("tail")] if keep else []
    return sums.select(key, "n", "mean", F.array(*covariance).alias("covariances"), *tail, "last_time")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _recursion(g: Column, max_order: int) -> Column:
    """[(order, weights, error variance)] of orders 0 to ``max_order``, from autocovariances ``g``."""
    none = F.array().cast("array<double>")
    entry = lambda p, a, e: F.struct(p.alias("p"), a.alias("weights"), e.alias("error"))

    def step(acc: Column, k: Column) -> Column:
        last = F.element_at(acc, -1)
        a, e = last["weights"], last["error"]
        gap = F.element_at(g, k + 1) - _dot(a, F.reverse(F.slice(g, F.lit(2), k - 1)))
        r = F.when(e > TINY * F.element_at(g, 1), gap / e).otherwise(0.0)
        weights = F.concat(F.zip_with(a, F.reverse(a), lambda x, y: x - r * y), F.array(r))
        return F.concat(acc, F.array(entry(k, weights, e * (F.lit(1.0) - r * r))))

    first = F.array(entry(F.lit(0), none, F.element_at(g, 1)))
    kind = "array<struct<p:int,weights:array<double>,error:double>>"
    return F.aggregate(F.sequence(F.lit(1), F.lit(max_order)), first.cast(kind), lambda acc, k: step(acc, k).cast(kind))


def fit_seasonal_ar(
    df: DataFrame, column: str = "aqi", max_order: int = MAX_ORDER, season: int = SEASON, key: str = NODE, time: str = TIME, **kw,
) -> DataFrame:
    """One row per node: its model with the least ``n ln(error) + 2 * parameters``.

    ``order`` and ``seasonal`` (0 where no season is kept) name the model, ``weights`` are those of lags
    1 to ``season + max_order``, ``error`` is the error variance and ``criterion`` what was least; ``tail``
    holds the last values. A season is tried where the history holds two.
    """
    lags = season + max_order
    rows = autocovariances(df, column, lags, key, time, keep=lags, **kw)
    g = F.col("covariances")
    lag = lambda k: F.element_at(g, F.abs(k) + 1)
    s = F.when((F.col("n") >= 2 * season) & (F.element_at(g, 1) > 0), F.element_at(g, season + 1) / F.element_at(g, 1)).otherwise(0.0)
    rows = rows.withColumn("_s", s)
    ks = F.sequence(F.lit(0), F.lit(max_order))
    rows = rows.withColumn("_plain", F.slice(g, 1, max_order + 1)).withColumn(
        "_bare", F.transform(ks, lambda k: (F.lit(1.0) + F.col("_s") * F.col("_s")) * lag(k) - F.col("_s") * (lag(k + season) + lag(k - season))),
    )
    rows = rows.withColumn("_orders", _recursion(F.col("_plain"), max_order)).withColumn("_seasonal", _recursion(F.col("_bare"), max_order))
    floor = F.greatest(F.element_at(g, 1) * TINY, F.lit(1e-300))

    def models(orders: str, kept: Column, parameters: int) -> Column:
        usable = F.filter(orders, lambda m: m["p"] < F.col("n"))
        return F.transform(usable, lambda m: F.struct(
            (F.col("n") * F.ln(F.greatest(m["error"], floor)) + F.lit(2.0) * (m["p"] + parameters)).alias("criterion"),
            m["p"].alias("order"), kept.alias("seasonal"), m["weights"].alias("weights"), m["error"].alias("error"),
        ))

    plain = models("_orders", F.lit(0.0), 1)
    tried = F.when(F.col("_s") != 0, F.concat(plain, models("_seasonal", F.col("_s"), 2))).otherwise(plain)
    # Of equal criteria the smaller order, then the model without season.
    best = F.array_min(F.transform(tried, lambda m: F.struct(F.round(m["criterion"], 6).alias("rounded"), m["order"].alias("order"), F.abs(m["seasonal"]).alias("strength"), m.alias("model"))))
    rows = rows.withColumn("_best", best["model"])
    a = F.col("_best.weights")
    at = lambda j: F.coalesce(F.get(a, j - 1), F.lit(0.0))
    weights = F.transform(F.sequence(F.lit(1), F.lit(lags)), lambda j: (
        F.when(j <= max_order, at(j)).otherwise(0.0) + F.when(j == season, F.col("_best.seasonal")).otherwise(0.0)
        - F.when(j > season, F.col("_best.seasonal") * at(j - season)).otherwise(0.0)
    ))
    return rows.select(
        key, "n", "mean", F.col("_best.order").alias("order"), F.col("_best.seasonal").alias("seasonal"), weights.alias("weights"),
        F.col("_best.error").alias("error"), F.col("_best.criterion").alias("criterion"), "tail", "last_time",
    )


def forecast_seasonal_ar(
    df: DataFrame, column: str = "aqi", horizon: int = 24, max_order: int = MAX_ORDER, season: int = SEASON,
    key: str = NODE, time: str = TIME, **kw,
) -> DataFrame:
    """(key, h, time, y_pred) of every node's own model, step by step from its last values."""
    if max_order >= season:
        raise ValueError("the orders must stay below the season")
    lags = season + max_order
    fitted = fit_seasonal_ar(df, column, max_order, season, key, time, **kw)
    known = F.transform("tail", lambda y: y - F.col("mean"))
    start = F.concat(F.array_repeat(F.lit(0.0), F.lit(lags) - F.size("tail")), known)
    back = F.reverse("weights")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)), start, lambda v, _: F.concat(v, F.array(_dot(back, F.slice(v, F.lit(-lags), F.lit(lags))))),
    )
    rows = fitted.select(key, "last_time", "mean", F.posexplode(F.slice(walked, lags + 1, horizon)).alias("_at", "_y"))
    h = (F.col("_at") + 1).cast("int")
    return rows.select(key, h.alias("h"), F.timestamp_add("HOUR", h, F.col("last_time")).alias(time), (F.col("mean") + F.col("_y")).alias("y_pred"))


def holdout_seasonal_ar(
    df: DataFrame, column: str = "aqi", horizon: int = 24, key: str = NODE, time: str = TIME, split: str = "split", **kw,
) -> DataFrame:
    """(node, time, h, y_true, y_pred): each node's model, chosen on its train rows, beside its first test rows."""
    made = forecast_seasonal_ar(df.where(F.col(split) == "train"), column, horizon, key=key, time=time, **kw)
    test = df.where(F.col(split) == "test").select(key, time, F.col(column).alias("y_true"))
    test = with_positions(test, [key], [time], name="_p").where(F.col("_p") < horizon)
    return test.withColumn("h", (F.col("_p") + 1).cast("int")).join(
        made.select(key, "h", "y_pred"), [key, "h"],
    ).select(key, time, "h", "y_true", "y_pred")
