"""Forecast metrics: aggregate expressions and the tables built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.functions.aqi import category_index_sql
from airpanel.operators.chunks import NODE, TIME, with_positions

HORIZONS = (1, 6, 12, 24)
EPSILON = 1e-8
# Error each model is expected to stay under.
TARGET_MAE = {"ARIMA": 30.0, "LSTM": 20.0, "ST-GNN": 15.0}

T, P, B = "y_true", "y_pred", "y_baseline"


def mae(t: str = T, p: str = P) -> Column:
    return F.expr(f"avg(abs({t} - {p}))")


def _mse(t: str, p: str) -> str:
    return f"avg(({t} - {p}) * ({t} - {p}))"


def rmse(t: str = T, p: str = P) -> Column:
    return F.expr(f"sqrt({_mse(t, p)})")


def mape(t: str = T, p: str = P) -> Column:
    return F.expr(f"avg(abs(({t} - {p}) / ({t} + {EPSILON}D))) * 100")


def r2(t: str = T, p: str = P) -> Column:
    """Share of variance explained; 0 when the truth is constant."""
    return F.expr(f"CASE WHEN var_pop({t}) = 0 THEN 0D ELSE 1 - {_mse(t, p)} / var_pop({t}) END")


def _category_gap(t: str = T, p: str = P) -> str:
    return f"abs({category_index_sql(t)} - {category_index_sql(p)})"


def category_accuracy(t: str = T, p: str = P) -> Column:
    return F.expr(f"avg(CAST({_category_gap(t, p)} = 0 AS DOUBLE))")


def adjacent_category_accuracy(t: str = T, p: str = P) -> Column:
    return F.expr(f"avg(CAST({_category_gap(t, p)} <= 1 AS DOUBLE))")


def skill_score(t: str = T, p: str = P, b: str = B) -> Column:
    """Gain over the baseline's squared error; 0 when the baseline is perfect."""
    return F.expr(f"CASE WHEN {_mse(t, b)} = 0 THEN 0D ELSE 1 - {_mse(t, p)} / {_mse(t, b)} END")


def combined_loss(t: str = T, p: str = P, alpha: float = 0.7) -> Column:
    """Blend of the mean error and the mean error relative to the truth, in percent."""
    error = f"abs({p} - {t})"
    return F.expr(
        f"{alpha}D * avg({error}) + {1 - alpha!r}D * avg({error} / (abs({t}) + 1)) * 100"
    )


def all_metrics(df: DataFrame, by: Sequence[str] = ("model",), baseline: str | None = None) -> DataFrame:
    """Every metric per model in one aggregation."""
    columns = [
        mae().alias("mae"), rmse().alias("rmse"), mape().alias("mape"), r2().alias("r2"),
        category_accuracy().alias("category_accuracy"),
        adjacent_category_accuracy().alias("adjacent_category_accuracy"),
    ]
    if baseline:
        columns.append(skill_score(b=baseline).alias("skill_score"))
    return df.groupBy(*by).agg(*columns)


def category_error_breakdown(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Percent of forecasts in the right category, one off, and two or more off."""
    share = {"correct": "= 0", "off_by_one": "= 1", "wrong": ">= 2"}
    return df.groupBy(*by).agg(*[
        F.expr(f"avg(CAST({_category_gap()} {hit} AS DOUBLE)) * 100 AS {name}")
        for name, hit in share.items()
    ])


def horizon_metrics(
    df: DataFrame, by: Sequence[str] = ("model",), horizons: Sequence[int] = HORIZONS,
) -> DataFrame:
    """MAE, RMSE and category accuracy at single steps of array forecasts.

    ``y_true`` and ``y_pred`` are arrays; only the wanted steps are taken out of
    them, and a step beyond the end gives no row.
    """
    steps = F.explode(F.array(*[F.lit(h) for h in horizons]))
    rows = df.select(*by, T, P, steps.alias("h")).where(F.col("h") <= F.size(T))
    rows = rows.select(
        *by, "h", F.element_at(T, F.col("h")).alias(T), F.element_at(P, F.col("h")).alias(P)
    )
    return rows.groupBy(*by, "h").agg(
        mae().alias("mae"), rmse().alias("rmse"), category_accuracy().alias("category_accuracy")
    )


def node_mae(
    df: DataFrame, horizon: int = 24, key: str = NODE, time: str = TIME, by: Sequence[str] = (), **kw,
) -> DataFrame:
    """MAE per node over its first ``horizon`` rows, and the mean of these as ``average``; per ``by``, such as the model.

    Nodes with fewer rows are left out.
    """
    rows = with_positions(df, [*by, key], [time], total="_n", **kw)
    rows = rows.where((F.col("position") < horizon) & (F.col("_n") >= horizon))
    per_node = rows.groupBy(*by, key).agg(mae().alias("mae"))
    average = per_node.groupBy(*by).agg(F.lit("average").alias(key), F.avg("mae").alias("mae"))
    return per_node.unionByName(average)


def ensemble_mean(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean prediction of all models per forecast row."""
    return df.groupBy(*by).agg(F.first(T).alias(T), F.avg(P).alias(P))


def comparison_table(metrics: DataFrame, targets: dict[str, float] = TARGET_MAE) -> DataFrame:
    """Formatted metrics, the target error and whether it is met, one row per model."""
    target = F.lit(None).cast("double")
    for model, value in targets.items():
        target = F.when(F.col("model") == model, F.lit(value)).otherwise(target)
    percent = lambda c: F.format_string("%.1f%%", F.col(c) * F.lit(100.0))
    met = F.when(F.col("mae") <= F.coalesce(F.col("_target"), F.lit(999.0)), "Yes").otherwise("No")
    return metrics.withColumn("_target", target).select(
        F.col("model").alias("Model"),
        F.format_string("%.2f", "mae").alias("MAE"),
        F.format_string("%.2f", "rmse").alias("RMSE"),
        F.format_string("%.2f", "mape").alias("MAPE (%)"),
        F.format_string("%.4f", "r2").alias("R²"),
        percent("category_accuracy").alias("Category Accuracy"),
        percent("adjacent_category_accuracy").alias("Adjacent Cat. Acc."),
        F.when(F.col("_target").isNull(), "N/A")
        .otherwise(F.concat(F.lit("≤"), F.col("_target").cast("int").cast("string")))
        .alias("Target MAE"),
        met.alias("Target Met"),
    )


def aligned_forecasts(
    df: DataFrame, models: Sequence[str], key: str = NODE, time: str = TIME,
) -> DataFrame:
    """Truth and the prediction of each model side by side, one aggregation."""
    return df.groupBy(time, key).agg(
        F.max(T).alias("actual"),
        *[F.max(F.when(F.col("model") == m, F.col(P))).alias(m) for m in models],
    )
