"""Chronological train, validation and test rows."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airpanel.functions.clock import hour_index, hour_start
from airpanel.operators.chunks import CHUNK, NODE, TIME, chunk_of


def _instant(df: DataFrame, time: str, value: datetime) -> Column:
    """A wall-clock constant of the column's type, whatever the session zone."""
    return F.lit(value.isoformat(sep=" ")).cast(df.schema[time].dataType)


def _rows_at(
    df: DataFrame, starts: dict[int, tuple[int, int]], time: str, key: str, size: int,
) -> dict[int, tuple[datetime, str]]:
    """The (time, key) of the row at each rank, given its chunk and the rows before that.

    Only the instants of the wanted chunks are counted, then only the rows of the
    wanted instants are ordered by key, one per node.
    """
    here = [
        (F.col(time) >= hour_start(f"{c * size}")) & (F.col(time) < hour_start(f"{(c + 1) * size}"))
        for c, _ in starts.values()
    ]
    counts = (
        df.where(reduce(or_, here)).withColumn("_h", hour_index(time))
        .groupBy(chunk_of("_h", size).alias("_tc"), time).agg(F.count(F.lit(1)).alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("_tc").orderBy(time))
    hits = " OR ".join(
        f"(_tc = {c} AND upto > {r - before} AND upto - n <= {r - before})"
        for r, (c, before) in starts.items()
    )
    instants = counts.withColumn("upto", upto).where(hits).collect()  # one row per rank
    at = {
        r: (i[time], r - before - i["upto"] + i["n"])
        for r, (c, before) in starts.items() for i in instants
        if i["_tc"] == c and i["upto"] - i["n"] <= r - before < i["upto"]
    }
    rows = df.where(F.col(time).isin([_instant(df, time, t) for t, _ in at.values()]))
    place = F.row_number().over(Window.partitionBy(time).orderBy(key)) - 1
    rows = rows.select(time, key).withColumn("i", place)
    rows = rows.where(F.col("i").isin([i for _, i in at.values()])).collect()  # a row per pair
    keys = {(r[time], r["i"]): r[key] for r in rows}
    return {r: (t, keys[t, i]) for r, (t, i) in at.items()}


def chrono_split(
    df: DataFrame, train_ratio: float = 0.7, val_ratio: float = 0.15,
    time: str = TIME, key: str = NODE, size: int = CHUNK,
) -> DataFrame:
    """Add ``split``: the first rows by (time, key) train, the next val, the rest test.

    The two boundary rows are found by counting, from chunks of time to instants
    to rows; each row is then compared with them, so the table itself is neither
    sorted nor shuffled. (time, key) must be unique, as it is on a clean panel.
    """
    chunks = df.withColumn("_h", hour_index(time)).groupBy(chunk_of("_h", size).alias("_tc")).count()
    counts = sorted((r["_tc"], r["count"]) for r in chunks.collect())  # one row per chunk of time
    n = sum(c for _, c in counts)
    if n == 0:
        return df.withColumn("split", F.lit("test"))
    train_end, val_end = int(n * train_ratio), int(n * (train_ratio + val_ratio))
    train_end, val_end = min(train_end, n), min(val_end, n)
    starts, before = {}, 0
    for chunk, c in counts:
        starts |= {r: (chunk, before) for r in (train_end, val_end) if before <= r < before + c}
        before += c
    bounds = _rows_at(df, starts, time, key, size) if starts else {}

    def earlier(rank: int) -> Column:
        if rank >= n:  # no row lies at or after the end
            return F.lit(True)
        t, k = bounds[rank]
        t = _instant(df, time, t)
        return (F.col(time) < t) | ((F.col(time) == t) & (F.col(key) < F.lit(k)))

    return df.withColumn(
        "split",
        F.when(earlier(train_end), "train").when(earlier(val_end), "val").otherwise("test"),
    )


def save_split(df: DataFrame, path: str, time: str = TIME, key: str = NODE) -> None:
    """Persist which split each row belongs to, by its key."""
    df.select(time, key, "split").write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def split_summary(df: DataFrame, column: str = "aqi") -> DataFrame:
    """Rows, mean and sample deviation per split."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
    )


def run_summary(df: DataFrame, column: str = "aqi") -> DataFrame:
    """One row about a prepared table: rows in all and per part, columns, and the index in each part."""
    part = lambda name, value: F.when(F.col("split") == name, value)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count(part(p, F.lit(1))).alias(f"{p}_rows") for p in ("train", "val", "test")],
        F.lit(len(df.columns) - 1).alias("n_features"),
        F.avg(part("train", F.col(column))).alias("train_mean"), F.stddev_samp(part("train", F.col(column))).alias("train_std"),
        F.avg(part("val", F.col(column))).alias("val_mean"), F.avg(part("test", F.col(column))).alias("test_mean"),
    )


def split_no_leak(df: DataFrame, time: str = TIME) -> DataFrame:
    """Last train time, first test time and whether they are in order."""
    last = F.max(F.when(F.col("split") == "train", F.col(time)))
    first = F.min(F.when(F.col("split") == "test", F.col(time)))
    return df.agg(last.alias("train_to"), first.alias("test_from")).withColumn(
        "ordered", F.col("train_to") <= F.col("test_from")
    )
