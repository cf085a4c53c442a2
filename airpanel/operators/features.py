"""Lag, rolling and window features per node."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from airpanel.operators.chunks import NODE, TIME, frame, windowed, with_positions
from airpanel.operators.quantiles import medians

Maker = Callable[[WindowSpec], Column]

LAGS = (1, 6, 24)
LONG_LAGS = (1, 3, 6, 12, 24)
WINDOWS = (24, 72)
STD_FROM = 24


def lag_columns(target: str = "aqi", lags: Sequence[int] = LAGS) -> dict[str, Maker]:
    return {f"{target}_lag_{k}h": (lambda w, k=k: F.lag(target, k).over(w)) for k in lags}


def filled_lag_columns(
    middle: dict[str, float | None], lags: Sequence[int] = LONG_LAGS,
) -> dict[str, Maker]:
    """Lags with the column's median where no value came before."""
    return {
        f"{c}_lag_{k}h": (
            lambda w, c=c, k=k, m=m: F.coalesce(F.lag(c, k).over(w), F.lit(m).cast("double"))
        )
        for k in lags for c, m in middle.items()
    }


def rolling_columns(
    columns: Sequence[str] = ("pm25",), windows: Sequence[int] = WINDOWS,
) -> dict[str, Maker]:
    """Mean of the last n rows; sample deviation too for long windows."""
    out: dict[str, Maker] = {}
    for c in columns:
        for n in windows:
            out[f"{c}_{n}h_mean"] = lambda w, c=c, n=n: F.avg(c).over(frame(w, n - 1))
            if n >= STD_FROM:
                out[f"{c}_{n}h_std"] = lambda w, c=c, n=n: F.stddev_samp(c).over(frame(w, n - 1))
    return out


def advanced_rolling_columns(columns: Sequence[str] = ("pm25", "pm10", "aqi")) -> dict[str, Maker]:
    """Means over 6, 12, 24 rows, deviations over 6 and 24 (0 for one row), change."""
    out: dict[str, Maker] = {}
    for c in columns:
        for n in (6, 12, 24):
            out[f"{c}_roll_{n}h"] = lambda w, c=c, n=n: F.avg(c).over(frame(w, n - 1))
        for n in (6, 24):
            out[f"{c}_std_{n}h"] = lambda w, c=c, n=n: F.coalesce(
                F.stddev_samp(c).over(frame(w, n - 1)), F.lit(0.0)
            )
        out[f"{c}_diff"] = change_column(c)
    return out


def change_column(c: str) -> Maker:
    return lambda w: F.coalesce(F.col(c) - F.lag(c, 1).over(w), F.lit(0.0))


def lag_features(
    df: DataFrame, target: str = "aqi", lags: Sequence[int] = LAGS, **kw,
) -> DataFrame:
    return windowed(df, lag_columns(target, lags), lookback=max(lags), **kw)


def lag_median_filled(
    df: DataFrame, columns: Sequence[str] = ("aqi", "pm25"), lags: Sequence[int] = LONG_LAGS, **kw,
) -> DataFrame:
    return windowed(df, filled_lag_columns(medians(df, columns), lags), lookback=max(lags), **kw)


def rolling_features(
    df: DataFrame, columns: Sequence[str] = ("pm25",), windows: Sequence[int] = WINDOWS, **kw,
) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return windowed(df, rolling_columns(present, windows), lookback=max(windows) - 1, **kw)


def advanced_rolling(
    df: DataFrame, columns: Sequence[str] = ("pm25", "pm10", "aqi"), **kw,
) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return windowed(df, advanced_rolling_columns(present), lookback=23, **kw)


def rate_of_change(df: DataFrame, column: str = "aqi", **kw) -> DataFrame:
    return windowed(df, {f"{column}_diff": change_column(column)}, lookback=1, **kw)


def sliding_windows(
    df: DataFrame, features: Sequence[str], target: str = "aqi",
    window: int = 72, horizon: int = 24, **kw,
) -> DataFrame:
    """Training samples per node, stamped with the time of their first row.

    ``x`` holds ``window`` rows of features, ``y`` the next ``horizon`` targets.
    Rows go through structs because lists skip bare NULLs.
    """
    columns = {
        "x": lambda w: F.collect_list("_x").over(w.rowsBetween(0, window - 1)),
        "y": lambda w: F.collect_list("_y").over(w.rowsBetween(window, window + horizon - 1)),
    }
    out = windowed(_cells(df, features, target, **kw), columns, lookahead=window + horizon - 1, **kw)
    out = out.where(F.size("y") == horizon).select(*_ids(df), "x", "y")
    return out.withColumn("y", F.transform("y", lambda s: s[target]))


def single_target_windows(
    df: DataFrame, features: Sequence[str], target: str = "aqi",
    window: int = 72, horizon: int = 24, **kw,
) -> DataFrame:
    """Training samples whose ``y`` is only the target ``horizon`` rows after ``x``."""
    reach = window + horizon - 1
    columns = {
        "x": lambda w: F.collect_list("_x").over(w.rowsBetween(0, window - 1)),
        "y": lambda w: F.lead("_y", reach).over(w),
    }
    out = windowed(_cells(df, features, target, **kw), columns, lookahead=reach, **kw)
    out = out.where(F.col("y").isNotNull()).select(*_ids(df), "x", "y")
    return out.withColumn("y", F.col("y")[target])


def matrix_windows(
    df: DataFrame, entities: Sequence[str], target: str = "aqi",
    window: int = 72, horizon: int = 24, **kw,
) -> DataFrame:
    """Training samples whose ``x`` is a matrix: one row per hour, one cell per entity."""
    out = sliding_windows(df, entities, target, window, horizon, **kw)
    return out.withColumn("x", F.transform("x", lambda s: F.array(*[s[e] for e in entities])))


def node_windows(
    df: DataFrame, column: str = "aqi", window: int = 72, horizon: int = 24, key: str = NODE, time: str = TIME, **kw,
) -> DataFrame:
    """Training samples whose steps hold all nodes: ``x`` and ``y`` are lists of steps, a step a list of (node, value).

    Nodes are in order within a step. They are data, not columns, so no list of
    nodes is needed, and a step lists the nodes measured then.
    """
    cells = F.sort_array(F.collect_list(F.struct(F.col(key).alias("node"), F.col(column).alias("value"))))
    steps = df.groupBy(time).agg(cells.alias("_step"))
    return sliding_windows(steps, ["_step"], "_step", window, horizon, keys=(), order=(time,), **kw).withColumn(
        "x", F.transform("x", lambda s: s["_step"])
    )


def pivot_nodes(df: DataFrame, nodes: Sequence[str], column: str = "aqi") -> DataFrame:
    """One row per timestamp with a column per node, the entities of a graph window."""
    return df.groupBy(TIME).pivot(NODE, list(nodes)).agg(F.first(column))


def _cells(
    df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str] = (NODE,), order: Sequence[str] = (TIME,), **_,
) -> DataFrame:
    """What a window needs: the features as ``_x``, the target as ``_y``, made before the shuffle."""
    kept = [c for c in df.columns if c in {*_ids(df), *keys, *order}]
    return df.select(*kept, F.struct(*features).alias("_x"), F.struct(target).alias("_y"))


def _ids(df: DataFrame) -> list[str]:
    return [c for c in (NODE, TIME) if c in df.columns]


def persistence_circular(
    df: DataFrame, column: str = "aqi", horizon: int = 24, key: str = NODE, time: str = TIME, **kw,
) -> DataFrame:
    """Each node's series moved ``horizon`` rows on, with the rows' places; the last rows wrap to the front.

    All rows but the first ``horizon`` of a node look back. The first ones, which have
    no row so far back, get the last ones, which have none so far ahead: at most
    ``horizon`` of either per node.
    """
    cell = F.struct(F.col(column).alias("v")).alias("_cell")
    rows = windowed(
        df.select(key, time, column, cell),
        {"_before": lambda w: F.lag("_cell", horizon).over(w), "_after": lambda w: F.lead("_cell", horizon).over(w)},
        lookback=horizon, lookahead=horizon, keys=[key], order=[time], place="position", **kw,
    )
    node = Window.partitionBy(key)
    first = rows.where("_before IS NULL").select(key, "position", time, column, F.col("position").alias("_i"))
    last = rows.where("_after IS NULL").select(
        key, F.col(column).alias("y_pred"), (F.col("position") - F.min("position").over(node)).alias("_i"), F.count(F.lit(1)).over(node).alias("_n"),
    )
    last = last.select(key, F.pmod(F.col("_i") + F.lit(horizon), F.col("_n")).alias("_i"), "y_pred")
    first = first.join(last, [key, "_i"])
    moved = rows.where("_before IS NOT NULL").select(key, "position", time, column, F.col("_before.v").alias("y_pred"))
    return moved.unionByName(first.select(key, "position", time, column, "y_pred"))


def persistence_last(
    df: DataFrame, column: str = "aqi", horizon: int = 24, key: str = NODE, time: str = TIME,
) -> DataFrame:
    """The last value of each node for every step of the horizon."""
    last = df.groupBy(key).agg(F.max_by(column, time).alias("y_pred"))
    return last.select(key, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"), "y_pred")


def tail_context(df: DataFrame, n: int, key: str = NODE, time: str = TIME, **kw) -> DataFrame:
    """The last ``n`` rows of each node."""
    rows = with_positions(df, [key], [time], total="_n", **kw)
    return rows.where(F.col("_n") - F.col("position") <= n).drop("_n", "position")


def rolling_origin(
    df: DataFrame, column: str = "aqi", horizon: int = 24, train_tail: int | None = None,
    context: int | None = None, train_ratio: float = 0.7, val_ratio: float = 0.15,
    max_predictions: int | None = None, key: str = NODE, time: str = TIME, **kw,
) -> DataFrame:
    """Backtest origins per node with a summary of the context each one sees.

    Origins lie ``horizon`` test rows apart. The context of an origin is the train
    rows and all test rows before it; ``train_tail`` keeps only the last train
    rows, ``context`` only the last rows of all. ``max_predictions`` stops after
    that many forecast rows per node.

    Rows are summed once, in blocks between the places where some context begins
    or ends; a running frame over these few block rows gives every context.
    """
    rows = with_positions(df.select(key, time, column), [key], [time], total="_n", **kw)
    n, pos = F.col("_n"), F.col("position")
    test_at = F.floor(n * F.lit(train_ratio + val_ratio))
    train_end = F.floor(n * F.lit(train_ratio))
    kept = train_end if train_tail is None else F.least(F.lit(train_tail), train_end)
    # Places count from the first test row; train rows lie below zero.
    place = (
        F.when((pos >= train_end - kept) & (pos < train_end), pos - train_end)
        .when(pos >= test_at, pos - test_at)
    )
    origins = F.ceil((n - test_at - horizon) / F.lit(horizon))
    if max_predictions is not None:
        origins = F.least(origins, F.lit(-(-max_predictions // horizon)))
    # Contexts end at multiples of the horizon and begin ``context`` places before.
    # A block is a stretch between such places: two per horizon, or one if they coincide.
    begins = -context % horizon if context is not None else 0
    block = 2 * F.floor(F.col("_place") / F.lit(horizon)) + F.when(
        F.lit(begins > 0) & (F.pmod(F.col("_place"), F.lit(horizon)) >= begins), 1
    ).otherwise(0)
    blocks = (
        rows.select(key, time, column, place.alias("_place"), origins.alias("_origins"))
        .where("_place IS NOT NULL").withColumn("_block", block)
        .groupBy(key, "_block").agg(
            F.max("_origins").alias("_origins"), F.count(F.lit(1)).alias("_rows"), F.sum(column).alias("_sum"),
            F.count(column).alias("_known"), F.min(time).alias("_from"), F.max(time).alias("_to"),
            F.max_by(column, time).alias("_last"),
        )
    )
    first = Window.unboundedPreceding if context is None else -(2 * -(-context // horizon) - 2)
    seen = Window.partitionBy(key).orderBy("_block").rangeBetween(first, 0)
    # The block before an origin ends its context.
    origin = F.floor((F.col("_block") + (1 if begins else 2)) / 2)
    ends = F.pmod(F.col("_block"), F.lit(2)) == (1 if begins else 0)
    return (
        blocks.withColumns({
            "origin": F.when(ends, origin), "context_rows": F.sum("_rows").over(seen),
            "context_from": F.min("_from").over(seen), "context_to": F.col("_to"),
            "context_mean": F.sum("_sum").over(seen) / F.sum("_known").over(seen), "context_last": F.col("_last"),
        })
        .where("origin >= 0 AND origin < _origins")
        .select(key, "origin", "context_rows", "context_from", "context_to", "context_mean", "context_last")
    )
