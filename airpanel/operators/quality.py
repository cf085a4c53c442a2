"""Checks and reports over a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.functions.aqi import AQI_MAX
from airpanel.operators.chunks import NODE, TIME, windowed
from airpanel.operators.rows import drop_null_critical, known, missing_nodes, quoted


class DataValidationError(ValueError):
    """Raised when data that must be complete is not."""


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percent per column, in one pass."""
    columns = df.columns if columns is None else list(columns)
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col("_rows") - F.col(c)).alias("nulls"),
            ((F.col("_rows") - F.col(c)) / F.col("_rows") * F.lit(100.0)).alias("percent"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*cells)))


def require_no_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` itself, or an error that names the columns with NULLs."""
    bad = null_report(df, columns).where("nulls > 0").collect()  # one row per column
    if bad:
        raise DataValidationError(
            ", ".join(f"{r['column']}: {r['nulls']} NULLs ({r['percent']:.2f}%)" for r in bad)
        )
    return df


def range_report(df: DataFrame, column: str = "aqi") -> DataFrame:
    """Rows below and above the index range."""
    return df.agg(
        F.count_if(F.col(column) < 0).alias("below"),
        F.count_if(F.col(column) > AQI_MAX).alias("above"),
    )


def validate_panel(
    df: DataFrame, expected: DataFrame | None = None, column: str = "aqi",
    key: str = NODE, time: str = TIME,
) -> DataFrame:
    """Violations as rows (check, node_id, found); no row means a valid panel.

    Checks the node set, NULLs, the index range and that every node has the
    timestamps of the first node, each once.
    """
    df = known(df)
    blank = sum((F.col(quoted(c)).isNull().cast("bigint") for c in df.columns if c != key), F.lit(0))
    per_node = df.groupBy(key).agg(
        F.sum(blank).alias("null_values"),
        F.count_if((F.col(column) < 0) | (F.col(column) > AQI_MAX)).alias("out_of_range"),
    )
    cells = F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(key).alias(key), F.col(c).alias("found"))
        for c in ("null_values", "out_of_range")
    ])
    found = per_node.select(F.inline(cells)).where("found > 0")

    first = df.agg(F.min(key).alias("k")).first()["k"]
    ref = df.where(F.col(key) == F.lit(first)).select(time).distinct().withColumn("_ref", F.lit(1))
    # Per node: times that the first node lacks, times of the first node that are
    # missing, and rows beyond the first at one time. Each is counted on its own, so
    # none makes up for another.
    times = df.groupBy(key, time).agg(F.count(F.lit(1)).alias("_times"))
    match = times.join(ref, time, "left").groupBy(key).agg(
        F.count_if(F.col("_ref").isNull()).alias("extra"), F.count("_ref").alias("hit"),
        F.sum(F.col("_times") - 1).alias("repeats"),
    )
    total = ref.agg(F.count(F.lit(1)).alias("n"))
    wrong = match.withColumn("found", F.col("extra") + (total.scalar() - F.col("hit")) + F.col("repeats"))
    found = found.union(
        wrong.where("found > 0").select(F.lit("mismatched_timestamps"), key, "found")
    )
    if expected is not None:
        gone = missing_nodes(expected, df, key)
        found = found.union(
            gone.select(F.lit("missing_node"), key, F.lit(1).cast("bigint"))
        )
    return found


def hourly_continuity(df: DataFrame, key: str = NODE, time: str = TIME, **kw) -> DataFrame:
    """Neighbouring rows of a node that are not one hour apart."""
    gap = F.timestamp_diff("MINUTE", F.col("previous"), F.col(time))
    rows = windowed(
        df.select(key, time), {"previous": lambda w: F.lag(time).over(w)}, lookback=1,
        keys=[key], order=[time], **kw,
    )
    return rows.withColumn("minutes", gap).where("minutes <> 60")


def fill_report(filled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: gaps filled and gaps left; needs the ``{c}_raw`` columns."""
    cells, aggs = [], []
    for c in columns:
        raw = F.col(f"{c}_raw")
        aggs += [
            F.count_if(raw.isNull() & F.col(c).isNotNull()).alias(f"{c}_f"),
            F.count_if(F.col(c).isNull()).alias(f"{c}_l"),
        ]
        cells.append(F.struct(F.lit(c).alias("column"), F.col(f"{c}_f").alias("filled"),
                              F.col(f"{c}_l").alias("left")))
    return filled.agg(*aggs).select(F.inline(F.array(*cells)))


def drop_report(df: DataFrame) -> DataFrame:
    """Rows that lack a critical value, out of all rows."""
    kept = drop_null_critical(df.withColumn("_one", F.lit(1)))
    return kept.agg(F.count("_one").alias("kept")).select(
        "kept", (df.agg(F.count(F.lit(1))).scalar() - F.col("kept")).alias("dropped")
    )


def clip_report(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values per column outside the clip bounds."""
    aggs = [
        F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(c) if lo is not None
        else F.lit(0).cast("bigint").alias(c)
        for c, (lo, hi) in bounds.items()
    ]
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("clipped")) for c in bounds]
    return df.agg(F.count(F.lit(1)), *aggs).select(F.inline(F.array(*cells)))
