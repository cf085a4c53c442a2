"""From raw readings to features, splits and scaled tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.functions import clock, physics
from airpanel.functions.aqi import POLLUTANTS, aqi, aqi_sql
from airpanel.functions.physics import null_negatives
from airpanel.operators import features as ft
from airpanel.operators.chunks import numbered, placed, windowed
from airpanel.operators.gaps import clean_panel, interpolate_fill
from airpanel.operators.quantiles import (
    cap_extremes, clip_outliers, exact_quantiles, median_fill, null_extremes,
)
from airpanel.operators.rows import drop_null_all, known, numeric_columns
from airpanel.operators.scaling import fit_minmax, scale
from airpanel.operators.splits import chrono_split
from airpanel.session import materialize

WEATHER = ["temperature", "humidity", "wind_speed"]


def with_aqi(df: DataFrame) -> DataFrame:
    """Score every row and drop rows without a score.

    A list that is empty without a score drops the row as it is taken apart, so
    the score is computed once; a filter would move below it and compute it again.
    """
    score = aqi_sql(_present(df, POLLUTANTS))
    return df.drop("aqi").selectExpr("*", f"explode(array_remove(array({score}), -1D)) AS aqi")


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _features(df: DataFrame, rolling: Sequence[str]) -> DataFrame:
    """Lags, rolling columns, wind and calendar; one shuffle for all frames.

    Rows come numbered by chunk, so their positions need no shuffle of their own.
    """
    columns = {**ft.lag_columns("aqi"), **ft.rolling_columns(_present(df, rolling))}
    df = placed(df, "_chunk")
    df = windowed(df, columns, lookback=max(ft.WINDOWS), position=F.col("position")).drop("position")
    return df.withColumns({**physics.wind_vectors(df.columns), **clock.calendar_features()})


def engineer_panel(
    readings: DataFrame, clip: Sequence[str] | None = None,
    rolling: Sequence[str] = ("pm25", "aqi"),
) -> DataFrame:
    """Clean, clip, score, add features, drop incomplete rows.

    ``clip`` defaults to every numeric column. The clean panel is written once,
    because the clip bounds and the features both need all of it. It is written
    with the row numbers of its chunks, which cost nothing while the rows still
    lie together.
    """
    clean = materialize(numbered(clean_panel(readings, keep_chunk=True), "_chunk"), "clean")
    own = numeric_columns(clean, ["_chunk", "_rn"])
    columns = own if clip is None else _present(clean, clip)
    panel = clip_outliers(clean, columns)
    if "aqi" not in panel.columns:
        present = _present(panel, POLLUTANTS)
        panel = panel.withColumn("aqi", aqi(present))
    return _features(panel, rolling).dropna()


def clean_stations(df: DataFrame, key: str = "node_id") -> DataFrame:
    """Thorough cleaning of raw station rows, each station on its own."""
    pollutants = _present(df, POLLUTANTS)
    columns = pollutants + _present(df, WEATHER)
    df = known(df.dropna(subset=["timestamp"]), columns).withColumns({c: null_negatives(c) for c in pollutants})
    df = materialize(df, "typed")  # the quantiles and the cleaning read it, not the raw input
    df = interpolate_fill(null_extremes(df, pollutants), columns, limit=6, key=key)
    df = materialize(drop_null_all(df, _present(df, ["pm25", "pm10"])), "filled")
    return median_fill(df, pollutants)


def clean_capped(df: DataFrame, key: str = "node_id") -> DataFrame:
    """Cleaning that caps extremes instead of removing them."""
    columns = _present(df, POLLUTANTS + WEATHER)
    df = materialize(known(df, columns).withColumns({c: null_negatives(c) for c in columns}), "typed")
    df = interpolate_fill(cap_extremes(df, columns), columns, limit=12, key=key)
    return median_fill(materialize(df, "filled"), columns)


def engineer_advanced(df: DataFrame, key: str = "node_id") -> DataFrame:
    """Capped cleaning, score, and the wide feature set."""
    panel = with_aqi(clean_capped(df, key))
    middle = exact_quantiles(panel, {c: (c, 0.5) for c in ("aqi", "pm25")})
    columns = {
        **ft.advanced_rolling_columns(_present(panel, ["pm25", "pm10", "aqi"])),
        **ft.filled_lag_columns(middle),
    }
    panel = windowed(panel, columns, lookback=max(ft.LONG_LAGS), keys=[key])
    parts = clock.time_parts()
    cycles = clock.cyclical_time()
    return panel.withColumns({
        "hour": parts["hour"], "dayofweek": parts["day_of_week"], "month": parts["month"],
        "is_weekend": clock.weekend_flag(),
        **{c: cycles[c] for c in ("hour_sin", "hour_cos", "month_sin", "month_cos")},
        "is_rush_hour": clock.rush_hour_flag(),
        **physics.weather_interactions(panel.columns),
        **clock.season_flags(),
    })


@dataclass
class Prepared:
    """Outcome of :func:`prepare`: the features with ``split``, scaled rows, the scaler."""

    full: DataFrame
    scaled: DataFrame
    scaler: DataFrame


def prepare(readings: DataFrame, clip: Sequence[str] = POLLUTANTS,
            rolling: Sequence[str] = ("pm25",)) -> Prepared:
    """Features, chronological split, and scaling fitted on the train rows only."""
    features = materialize(engineer_panel(readings, clip, rolling), "features")
    if features.isEmpty():
        raise ValueError("no rows are left after feature engineering")
    full = chrono_split(features)
    scaler = materialize(fit_minmax(full.where(F.col("split") == "train")), "scaler")
    return Prepared(full, scale(full, scaler), scaler)
