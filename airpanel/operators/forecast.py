"""Forecast jobs: closed-form per node, seasonal, and one pooled model."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from airpanel.operators.chunks import CHUNK, NODE, TIME, chunk_of, windowed, with_positions
from airpanel.operators.rows import quoted
from airpanel.session import materialize

SEASON = 24


def fit_ar(df: DataFrame, column: str = "aqi", key: str = NODE, time: str = TIME, **kw) -> DataFrame:
    """Slope and intercept of each value on the one before, and the last value, per node."""
    rows = windowed(
        df.select(key, time, column), {"_before": lambda w: F.lag(column).over(w)}, lookback=1,
        keys=[key], order=[time], **kw,
    )
    return rows.groupBy(key).agg(
        F.regr_slope(column, "_before").alias("slope"),
        F.regr_intercept(column, "_before").alias("intercept"),
        F.max_by(column, time).alias("last"),
        F.max(time).alias("last_time"),
    )


def forecast_ar(df: DataFrame, column: str = "aqi", horizon: int = 24,
                key: str = NODE, time: str = TIME, **kw) -> DataFrame:
    """First-order autoregressive forecast of each node, all steps in closed form."""
    models = fit_ar(df, column, key, time, **kw)
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    rows = models.withColumn("h", steps)
    phi, c, y, h = F.col("slope"), F.col("intercept"), F.col("last"), F.col("h")
    decay = F.pow(phi, h)
    value = F.when(phi == 1, y + c * h).otherwise(
        c * (F.lit(1.0) - decay) / (F.lit(1.0) - phi) + decay * y
    )
    value = F.coalesce(value, y)  # a constant or single value has no slope
    return rows.select(
        key, "h", F.timestamp_add("HOUR", h, F.col("last_time")).alias(time), value.alias("y_pred")
    )


def forecast_seasonal(df: DataFrame, column: str = "aqi", horizon: int = 24, season: int = SEASON,
                      key: str = NODE, time: str = TIME, **kw) -> DataFrame:
    """Repeat each node's last season over the horizon."""
    rows = with_positions(df.select(key, time, column), [key], [time], total="_n", **kw)
    back = F.col("_n") - 1 - F.col("position")
    last = rows.where(back < season).withColumn("_step", (F.lit(season) - back).cast("int"))
    repeats = F.explode(F.sequence(F.lit(0), F.lit(-(-horizon // season) - 1)))
    rows = last.withColumn("_k", repeats).withColumn("h", F.col("_step") + F.col("_k") * season)
    return rows.where(F.col("h") <= horizon).select(key, "h", F.col(column).alias("y_pred"))


def _least_squares(row: Row, n: int, h: int) -> tuple[list[float], float]:
    """Weights and intercept from the centred cross-products of one horizon."""
    between = np.array([[row[f"s{h}_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])
    with_y = np.array([row[f"c{h}_{i}"] or 0.0 for i in range(n)])
    weights = np.linalg.lstsq(between, with_y, rcond=None)[0]
    means = np.array([row[f"m{h}_{i}"] or 0.0 for i in range(n)])
    return weights.tolist(), float((row[f"m{h}_y"] or 0.0) - weights @ means)


def forecast_pooled(
    df: DataFrame, features: Sequence[str], target: str = "aqi", horizons: Sequence[int] = (1, 6, 12, 24),
    key: str = NODE, time: str = TIME, split: str = "split", **kw,
) -> DataFrame:
    """One linear model over all nodes per step ahead, fitted on the train rows.

    Returns (node, time, h, y_true, y_pred) for the test rows. One aggregation
    gives the centred cross-products of the features and the labels of all
    horizons; their size is the feature count squared, and the driver solves for
    the weights. One projection emits the forecasts of every horizon.
    """
    features = list(features)
    ahead = {f"_y{h}": (lambda w, h=h: F.lead(target, h).over(w)) for h in horizons}
    # Where the future row lies decides the fit, so no label of val or test leaks.
    ahead |= {f"_s{h}": (lambda w, h=h: F.lead(split, h).over(w)) for h in horizons}
    needed = [key, time, split, target, *[f for f in features if f != target]]
    rows = materialize(windowed(
        df.select(*needed).dropna(), ahead, lookahead=max(horizons), keys=[key], order=[time], **kw,
    ), "pooled")
    stats = []
    for h in horizons:
        fit = (F.col(f"_s{h}") == "train") & F.col(f"_y{h}").isNotNull()
        x = [F.when(fit, F.col(quoted(f))) for f in features]
        y = F.when(fit, F.col(f"_y{h}"))
        stats += [F.avg(y).alias(f"m{h}_y")]
        for i, a in enumerate(x):
            stats += [F.avg(a).alias(f"m{h}_{i}"), F.covar_pop(a, y).alias(f"c{h}_{i}")]
            stats += [F.covar_pop(a, x[j]).alias(f"s{h}_{i}_{j}") for j in range(i, len(x))]
    row = rows.agg(*stats).first()
    steps = []
    for h in horizons:
        weights, intercept = _least_squares(row, len(features), h)
        value = F.lit(intercept)
        for f, w in zip(features, weights, strict=True):
            value = value + F.col(quoted(f)) * F.lit(w)
        steps.append(F.struct(F.lit(h).alias("h"), F.col(f"_y{h}").alias("y_true"), value.alias("y_pred")))
    out = rows.where(F.col(split) == "test").select(key, time, F.inline(F.array(*steps)))
    return out.where("y_true IS NOT NULL")


def holdout_forecast(
    df: DataFrame, column: str = "aqi", horizon: int = 24, key: str = NODE, time: str = TIME, split: str = "split", **kw,
) -> DataFrame:
    """(node, time, h, y_true, y_pred): each node's model, fitted on its train rows, beside its first test rows."""
    made = forecast_ar(df.where(F.col(split) == "train"), column, horizon, key, time, **kw)
    test = df.where(F.col(split) == "test").select(key, time, F.col(column).alias("y_true"))
    test = with_positions(test, [key], [time], name="_p", **kw).where(F.col("_p") < horizon)
    return test.withColumn("h", (F.col("_p") + 1).cast("int")).join(
        made.select(key, "h", "y_pred"), [key, "h"]
    ).select(key, time, "h", "y_true", "y_pred")


def rolling_origin_forecast(
    df: DataFrame, column: str = "aqi", horizon: int = 24, train_ratio: float = 0.7, val_ratio: float = 0.15,
    key: str = NODE, time: str = TIME, **kw,
) -> DataFrame:
    """Backtest of the first-order model, refitted at every origin: (node, time, origin, h, y_true, y_pred).

    Origins lie ``horizon`` test rows apart; each sees the train rows and all test
    rows before it. The sums behind a fit are taken once per block of ``horizon``
    rows, and a running sum over the blocks gives every fit: it runs inside chunks
    of blocks, and one row per chunk carries the sums before it. A test row looks
    up the fit of its origin and gets its step in closed form.
    """
    rows = windowed(
        with_positions(df.select(key, time, column), [key], [time], total="_n", **kw),
        {"_x": lambda w: F.lag(column).over(w)}, lookback=1, position=F.col("position"), keys=[key], order=[time], **kw,
    )
    n, pos = F.col("_n"), F.col("position")
    test_at, train_end = F.floor(n * F.lit(train_ratio + val_ratio)), F.floor(n * F.lit(train_ratio))
    place = F.when(pos < train_end, pos - train_end).when(pos >= test_at, pos - test_at)
    rows = rows.withColumn("_place", place).where("_place IS NOT NULL").withColumn("_origins", F.ceil((n - test_at - horizon) / F.lit(horizon)))
    # The first test row follows the validation rows, which no fit sees.
    rows = rows.withColumn("_x", F.when(F.col("_place") != 0, F.col("_x")))
    rows = rows.withColumn("origin", F.floor(F.col("_place") / F.lit(horizon)))
    y, x = F.when(F.col("_x").isNotNull(), F.col(column)), F.when(F.col(column).isNotNull(), F.col("_x"))
    sums = {"n": F.count(y * x), "x": F.sum(x), "y": F.sum(y), "xx": F.sum(x * x), "xy": F.sum(x * y)}
    blocks = materialize(rows.groupBy(key, "origin").agg(
        *[s.alias(f"_{name}") for name, s in sums.items()], F.max_by(column, time).alias("_last"),
    ), "blocks").withColumn("_chunk", chunk_of("origin", max(1, kw.get("size", CHUNK) // horizon)))
    earlier = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.groupBy(key, "_chunk").agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in sums]).select(
        key, "_chunk", *[F.coalesce(F.sum(f"_{name}").over(earlier), F.lit(0)).alias(f"_{name}_before") for name in sums],
    )
    seen = Window.partitionBy(key, "_chunk").orderBy("origin").rowsBetween(Window.unboundedPreceding, 0)
    fits = blocks.join(carried, [key, "_chunk"]).withColumns(
        {f"_{name}": F.coalesce(F.sum(f"_{name}").over(seen), F.lit(0)) + F.col(f"_{name}_before") for name in sums}
    )
    n, sx, sy, sxx, sxy = (F.col(f"_{name}") for name in sums)
    spread = n * sxx - sx * sx
    fits = fits.withColumn("phi", F.when(spread > 0, (n * sxy - sx * sy) / spread))
    fits = fits.withColumn("c", (sy - F.col("phi") * sx) / n).select(
        # The block before an origin ends what it sees.
        key, (F.col("origin") + 1).alias("origin"), "phi", "c", "_last",
    )
    test = rows.where("origin >= 0 AND origin < _origins").select(
        key, time, "origin", F.col(column).alias("y_true"), (F.pmod("_place", F.lit(horizon)) + 1).cast("int").alias("h"),
    )
    phi, c, h, last = F.col("phi"), F.col("c"), F.col("h"), F.col("_last")
    decay = F.pow(phi, h)
    value = F.when(phi == 1, last + c * h).otherwise(c * (F.lit(1.0) - decay) / (F.lit(1.0) - phi) + decay * last)
    return test.join(fits, [key, "origin"]).select(key, time, "origin", "h", "y_true", F.coalesce(value, last).alias("y_pred"))
