"""Hourly grid and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.functions.clock import hour_index, hour_start
from airpanel.operators.chunks import (
    CHUNK, NODE, TIME, chunk_of, known_neighbours, windowed, with_positions,
)
from airpanel.operators.rows import drop_null_critical, known, numeric_columns, quoted

GAP_FILL_LIMIT = 3
INTERPOLATE_LIMIT = 12


def _line(c: str, hold: int, line: int) -> list[str]:
    """The line that fills column ``c`` after its last known value.

    The value is held for ``hold`` rows; the next ``line`` rows lie on the
    straight line from there to the next known value, or stay at the held value
    when there is none. As SQL columns: value, slope, where the line starts and ends.
    """
    before, after = quoted(f"{c}_prev"), quoted(f"{c}_next")
    run = f"({after}.at - {before}.at - {hold})"
    slope = f"CASE WHEN {run} > 0 THEN ({after}.value - {before}.value) / {run} ELSE 0D END"
    base, rise, start, end = map(quoted, _line_columns([c]))
    return [
        f"{before}.value AS {base}",
        f"{slope if line else '0D'} AS {rise}",
        f"{before}.at + {hold} AS {start}",
        f"{before}.at + {hold + line} AS {end}",
    ]


def _on_line(c: str, at: str) -> str:
    """Value of the line at a position, as SQL; NULL past its end."""
    base, slope, start, end = map(quoted, _line_columns([c]))
    return f"CASE WHEN {at} <= {end} THEN {slope} * greatest({at} - {start}, 0) + {base} END"


def _line_columns(columns: Sequence[str]) -> list[str]:
    return [f"{c}_{part}" for c in columns for part in ("base", "slope", "from", "upto")]


def hourly_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    hold: int = 0,
    line: int = 0,
    key: str = NODE,
    time: str = TIME,
    size: int = CHUNK,
    keep_raw: bool = False,
    keep_chunk: bool = False,
    most: int | None = None,
) -> DataFrame:
    """Rows at every hour of each node, with gaps filled, in one shuffle.

    Each reading emits itself and the missing hours up to the next reading, so
    no grid is joined. Readings off the hour count for the extent only. A
    repeated timestamp of a node is an error. ``keep_raw`` adds the unfilled
    values as ``{c}_raw``, ``keep_chunk`` the ``_chunk`` the rows are partitioned
    by, which rises with time.

    A chunk holds ``size`` hours, which is even work for a few readings an hour. For
    denser ones ``most`` bounds the readings of a chunk: they are counted first, and
    chunks with more are split into shorter stretches of hours.
    """
    columns = list(columns) if columns is not None else numeric_columns(df, exclude=[key, time])
    rows = known(df, columns).select(
        key, F.col(time).cast("timestamp_ntz").alias("_t"), hour_index(time).alias("_h"),
        *map(quoted, columns),
    ).withColumn("_on", F.col("_t") == hour_start("_h"))
    rows = rows.withColumn("_chunk", chunk_of("_h", size))
    if most is not None:
        rows = _split_dense(rows, key, size, most)
    rows = rows.selectExpr(
        key, "_t", "_h", "_chunk", *[f"CASE WHEN _on THEN {quoted(c)} END AS {quoted(c)}" for c in columns]
    )
    looks = {"_ahead": "lead(_h)", "_same": "lag(_t)"}
    rows = known_neighbours(
        rows, columns, "_h", "_chunk", [key], order="_t", ahead=line > 0, extra=looks
    )
    # The last reading of an hour stands for it: its last known value is that of
    # the reading on the hour, if there is one.
    rows = rows.where(
        "CASE WHEN _same = _t THEN CAST(raise_error('duplicate timestamp') AS BOOLEAN) "
        "ELSE _ahead IS NULL OR _ahead > _h END"
    )
    lines = [e for c in columns for e in _line(c, hold, line)]
    hours = "explode(sequence(_h, coalesce(_ahead - 1, _h))) AS _at"
    rows = rows.selectExpr(key, "_chunk", "_h", "_ahead", *lines).selectExpr("*", hours)
    values = {c: _on_line(c, "_at") for c in columns}
    if keep_raw:
        values |= {
            f"{c}_raw": f"CASE WHEN _at = {quoted(f'{c}_from')} - {hold} THEN {quoted(f'{c}_base')} END" for c in columns
        }
    chunk = ["_chunk"] if keep_chunk else []
    return rows.withColumn(time, hour_start("_at")).selectExpr(
        key, time, *chunk, *[f"{e} AS {quoted(n)}" for n, e in values.items()]
    )


def _split_dense(rows: DataFrame, key: str, size: int, most: int) -> DataFrame:
    """Number chunks by their first hour, and split those with more than ``most`` rows at hours, by the rows before.

    The directory lists the hours of dense chunks only; an hour is never split.
    """
    hours = rows.groupBy(key, "_chunk", "_h").agg(F.count(F.lit(1)).alias("_n"))
    chunk = Window.partitionBy(key, "_chunk")
    before = F.coalesce(F.sum("_n").over(chunk.orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hours = hours.withColumn("_part", F.floor(before / F.lit(most))).withColumn("_all", F.sum("_n").over(chunk)).where(F.col("_all") > most)
    first = F.min("_h").over(Window.partitionBy(key, "_chunk", "_part"))
    hours = hours.select(key, "_chunk", "_h", first.alias("_first"))
    met = rows.join(hours, [key, "_chunk", "_h"], "left")
    return met.withColumn("_chunk", F.coalesce("_first", F.expr(f"_chunk * {size}"))).drop("_first")


def hourly_grid(df: DataFrame, columns: Sequence[str] | None = None, **kw) -> DataFrame:
    """Rows at every hour from the first to the last of each node; gaps are NULL."""
    return hourly_fill(df, columns, hold=0, line=0, **kw)


def ffill_limit(
    df: DataFrame, columns: Sequence[str], limit: int = GAP_FILL_LIMIT,
    position: Column | None = None, **kw,
) -> DataFrame:
    """Carry the last known value forward over at most ``limit`` rows."""
    fills = {
        c: (lambda w, c=c: F.last(quoted(c), ignorenulls=True).over(w.rowsBetween(-limit, 0)))
        for c in columns
    }
    return windowed(df, fills, lookback=limit, position=position, **kw)


def _with_neighbours(
    df: DataFrame, columns: Sequence[str], key: str, time: str, size: int, line: int = 0,
) -> DataFrame:
    rows = with_positions(df, [key], [time], size, name="_pos")
    rows = rows.withColumn("_chunk", chunk_of("_pos", size))
    rows = known_neighbours(rows, columns, "_pos", "_chunk", [key])
    return rows.selectExpr("*", *[e for c in columns for e in _line(c, 0, line)])


def _replace(df: DataFrame, columns: Sequence[str], values: dict[str, Column]) -> DataFrame:
    drop = [f"{c}_{side}" for c in columns for side in ("prev", "next")]
    return df.withColumns(values).drop(*drop, *_line_columns(columns), "_pos", "_chunk")


def interpolate_limit(
    df: DataFrame, columns: Sequence[str], limit: int = INTERPOLATE_LIMIT - GAP_FILL_LIMIT,
    key: str = NODE, time: str = TIME, size: int = CHUNK,
) -> DataFrame:
    """Straight line by row between known values, at most ``limit`` rows after each."""
    rows = _with_neighbours(df, columns, key, time, size, limit)
    return _replace(rows, columns, {c: F.expr(_on_line(c, "_pos")) for c in columns})


def ffill_bfill(
    df: DataFrame, columns: Sequence[str], key: str = NODE, time: str = TIME, size: int = CHUNK,
) -> DataFrame:
    """Last known value of the node, or the next one where none came before."""
    rows = _with_neighbours(df, columns, key, time, size)
    values = {c: F.expr(f"coalesce({quoted(f'{c}_prev')}.value, {quoted(f'{c}_next')}.value)") for c in columns}
    return _replace(rows, columns, values)


def interpolate_fill(
    df: DataFrame, columns: Sequence[str], limit: int,
    key: str = NODE, time: str = TIME, size: int = CHUNK,
) -> DataFrame:
    """:func:`interpolate_limit` followed by :func:`ffill_bfill`, in one shuffle.

    A row still empty after interpolation takes the value reached by the last
    interpolated row before it, else the next known value.
    """
    rows = _with_neighbours(df, columns, key, time, size, limit)
    values = {}
    for c in columns:
        reached = _on_line(c, f"least(_pos, {quoted(f'{c}_upto')})")
        values[c] = F.expr(f"coalesce({reached}, {quoted(f'{c}_next')}.value)")
    return _replace(rows, columns, values)


def clean_panel(
    df: DataFrame, columns: Sequence[str] | None = None,
    gap_fill_limit: int = GAP_FILL_LIMIT, interpolate_limit: int = INTERPOLATE_LIMIT, **kw,
) -> DataFrame:
    """Hourly grid with short gaps held, medium gaps interpolated, the rest dropped."""
    filled = hourly_fill(
        df, columns, hold=gap_fill_limit, line=interpolate_limit - gap_fill_limit, **kw
    )
    return drop_null_critical(filled)
