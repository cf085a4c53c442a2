"""Scalers: statistics fitted once as a one-row table, applied as constants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.functions.aqi import clamp_aqi
from airpanel.operators.rows import numeric_columns, quoted

EXCLUDE = ("timestamp", "node_id", "split")


def fit_minmax(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with ``{c}_shift`` (minimum) and ``{c}_scale`` (range, 1 when constant)."""
    columns = numeric_columns(df, EXCLUDE) if columns is None else columns
    return df.agg(*[e for c in columns for e in _stats(c, F.min(quoted(c)), F.max(quoted(c)) - F.min(quoted(c)))])


def fit_standard(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with ``{c}_shift`` (mean) and ``{c}_scale`` (population deviation or 1)."""
    columns = numeric_columns(df, EXCLUDE) if columns is None else columns
    return df.agg(*[e for c in columns for e in _stats(c, F.avg(quoted(c)), F.stddev_pop(quoted(c)))])


def _stats(c: str, shift: Column, scale: Column) -> list[Column]:
    return [
        shift.cast("double").alias(f"{c}_shift"),
        F.when(scale == 0, F.lit(1.0)).otherwise(scale).cast("double").alias(f"{c}_scale"),
    ]


def _constants(stats: DataFrame) -> dict[str, tuple[float, float]]:
    row = stats.first()
    names = [n[: -len("_shift")] for n in stats.columns if n.endswith("_shift")]
    return {c: (row[f"{c}_shift"], row[f"{c}_scale"]) for c in names}


def scale(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Scale the fitted columns; values outside the fitted range are not clipped."""
    return df.withColumns({
        c: (F.col(quoted(c)) - F.lit(shift)) / F.lit(by)
        for c, (shift, by) in _constants(stats).items() if c in df.columns
    })


def unscale(df: DataFrame, stats: DataFrame, fitted: str, columns: Sequence[str],
            clamp: bool = False) -> DataFrame:
    """Bring columns back to the unit of the ``fitted`` one, optionally clipped to the index range."""
    shift, by = _constants(stats)[fitted]
    back = {c: f"{quoted(c)} * {by!r}D + {shift!r}D" for c in columns}
    return df.withColumns({c: clamp_aqi(e) if clamp else F.expr(e) for c, e in back.items()})


def save_scaler(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise ValueError(f"no scaler at {path}") from e
