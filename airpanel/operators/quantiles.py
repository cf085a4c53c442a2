"""Exact quantiles of large columns, and the outlier rules built on them.

A mergeable sketch of every column brackets the values at the wanted ranks; one more pass counts what lies
beside the brackets and gathers what lies inside. Both passes scan the caller's rows once, whatever the
outliers; all that follows works on the gathered values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.operators.rows import numeric_columns, quoted
from airpanel.session import materialize

BUCKETS = 1000
SMALL = 1_000_000
#: Ranks of the sketches are right to a part in so many.
ACCURACY = 5000


@dataclass(frozen=True)
class _Span:
    """Value range known to hold the wanted rank of a column."""

    column: str
    low: float
    high: float
    before: int  # values below ``low``
    inside: int


def _narrow(held: DataFrame, spans: dict[tuple[str, int], _Span], origin: dict[tuple[str, int], int]) -> dict[tuple[str, int], _Span]:
    """Cut every span to the bucket that holds its rank: one pass over (span, v, n), small shuffle."""
    todo = sorted({(origin[k], s) for k, s in spans.items()}, key=lambda t: (t[0], t[1].low, t[1].high))
    cells = F.expr("inline(array_compact(array(" + ", ".join(
        f"CASE WHEN span = {i} AND v BETWEEN {_literal(s.low)} AND {_literal(s.high)} "
        f"THEN struct({k} AS part, width_bucket(v, {_literal(s.low)}, {_literal(s.high)}, {BUCKETS}) AS bucket, v, n) END"
        for k, (i, s) in enumerate(todo)
    ) + ")))")
    rows = held.select(cells).groupBy("part", "bucket").agg(
        F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("values"),
    )
    rows = rows.withColumn("upto", F.sum("n").over(Window.partitionBy("part").orderBy("bucket")))
    places = [s for _, s in todo]
    wanted = " OR ".join(
        f"(part = {places.index(s)} AND upto > {rank - s.before} AND upto - n <= {rank - s.before})" for (_, rank), s in spans.items()
    )
    found = rows.where(wanted).collect()  # one row per wanted rank
    out = {}
    for (column, rank), s in spans.items():
        for r in found:
            start = s.before + r["upto"] - r["n"]
            if r["part"] == places.index(s) and start <= rank < start + r["n"]:
                out[column, rank] = replace(s, low=r["low"], high=r["high"], before=start, inside=r["values"])
    return out


def _pick(held: DataFrame, spans: dict[tuple[str, int], _Span], origin: dict[tuple[str, int], int]) -> dict[tuple[str, int], float]:
    """Values at the wanted ranks of spans that hold few values."""
    todo = sorted({(origin[k], s) for k, s in spans.items()}, key=lambda t: (t[0], t[1].low, t[1].high))
    places = [s for _, s in todo]
    cells = F.expr("inline(array_compact(array(" + ", ".join(
        f"CASE WHEN span = {i} AND v BETWEEN {_literal(s.low)} AND {_literal(s.high)} THEN struct({k} AS part, v, n) END"
        for k, (i, s) in enumerate(todo)
    ) + ")))")
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    keys = list(spans)
    picks = [
        F.expr(f"min(CASE WHEN part = {places.index(spans[k])} AND upto > {k[1] - spans[k].before} THEN v END) AS k{i}")
        for i, k in enumerate(keys)
    ]
    row = held.select(cells).withColumn("upto", upto).agg(*picks).first()
    return {k: row[f"k{i}"] for i, k in enumerate(keys)}


def _gathered(df: DataFrame, spans: list[_Span], values: dict[str, str]) -> DataFrame:
    """(span, v, n): how often each value inside a span occurs; ``v`` is null for all values on the span's shorter side.

    A span over the upper ranks counts what lies above it, any other what lies below.
    """
    cells = []
    for i, s in enumerate(spans):
        v = values[s.column]
        beside = f"{v} > {_literal(s.high)} AND {v} < {INFINITE}" if s.before < 0 else f"{v} < {_literal(s.low)} AND {v} > {LEAST}"
        cells.append(
            f"CASE WHEN {v} BETWEEN {_literal(s.low)} AND {_literal(s.high)} THEN struct({i} AS span, {v} AS v) "
            f"WHEN {beside} AND NOT isnan({v}) THEN struct({i} AS span, CAST(NULL AS DOUBLE) AS v) END"
        )
    pairs = F.expr(f"inline(array_compact(array({', '.join(cells)})))")
    return df.select(pairs).groupBy("span", "v").agg(F.count(F.lit(1)).alias("n"))


LEAST, INFINITE = "CAST('-Infinity' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)"


def _sketched(df: DataFrame, values: dict[str, str], parts: dict[str, list[float]], accuracy: int):
    """One row: counts and ends of every column, and sketched values around the wanted parts."""
    aggs = []
    for i, (c, v) in enumerate(values.items()):
        finite = f"CASE WHEN {v} > {LEAST} AND {v} < {INFINITE} THEN {v} END"
        ends = sorted({e for p in parts[c] for e in (max(0.0, p - 2 / accuracy), min(1.0, p + 2 / accuracy))})
        listed = ", ".join(f"{e!r}D" for e in ends)
        aggs += [F.expr(f"{e} AS {n}_{i}") for n, e in (
            ("n", f"count_if({v} IS NOT NULL AND NOT isnan({v}))"), ("below", f"count_if({v} = {LEAST})"),
            ("above", f"count_if({v} = {INFINITE})"), ("lo", f"min({finite})"), ("hi", f"max({finite})"),
            ("near", f"map_from_arrays(array({listed}), percentile_approx({finite}, array({listed}), {accuracy}))"),
        )]
    return df.agg(*aggs).first()


def exact_quantiles(
    df: DataFrame, wanted: dict[str, tuple[str, float]], small: int = SMALL, accuracy: int = ACCURACY,
) -> dict[str, float | None]:
    """Linearly interpolated quantiles ``{name: (column, p)}`` of the known values.

    NULL and NaN are not known. Infinite values count at their end of the order; a
    quantile between a finite and an infinite value is infinite.

    Two scans of ``df``: the first sketches every column, the second counts the values beside
    each bracket and gathers those inside, about ``4 / accuracy`` of all, by value. If a bracket
    holds more than ``small`` different values, buckets narrow it on the gathered values
    until few are left; only those are ordered. Should a sketch miss a rank, its bracket is
    the whole column, gathered once more. A few numbers per quantile reach the driver.
    """
    columns = sorted({c for c, _ in wanted.values()})
    if not columns:
        return {}
    values = {c: f"CAST({quoted(c)} AS DOUBLE)" for c in columns}
    ends = _sketched(df, values, {c: [p for k, p in wanted.values() if k == c] for c in columns}, accuracy)
    size, below, above = ({c: ends[f"{n}_{i}"] for i, c in enumerate(columns)} for n in ("n", "below", "above"))
    number = {c: i for i, c in enumerate(columns)}
    at = {name: p * (size[c] - 1) for name, (c, p) in wanted.items()}
    value: dict[tuple[str, int], float] = {}
    ranks: dict[tuple[str, int], _Span] = {}
    for name, (c, p) in wanted.items():
        near = ends[f"near_{number[c]}"] or {}
        for rank in (math.floor(at[name]), math.ceil(at[name])) if size[c] else ():
            if rank < below[c]:
                value[c, rank] = -math.inf
            elif rank >= size[c] - above[c]:
                value[c, rank] = math.inf
            else:
                low, high = near[max(0.0, p - 2 / accuracy)], near[min(1.0, p + 2 / accuracy)]
                low = ends[f"lo_{number[c]}"] if p <= 2 / accuracy else low
                high = ends[f"hi_{number[c]}"] if p >= 1 - 2 / accuracy else high
                # ``before`` tells the side to count until the count is known.
                ranks[c, rank] = _Span(c, low, high, -1 if p > 0.5 else 0, 0)
    value |= _ranked(df, values, ranks, size, below, above, small)
    missed = {k: _Span(k[0], ends[f"lo_{number[k[0]]}"], ends[f"hi_{number[k[0]]}"], 0, 0) for k in ranks if k not in value}
    value |= _ranked(df, values, missed, size, below, above, small)
    out: dict[str, float | None] = {}
    for name, (c, _) in wanted.items():
        if not size[c]:
            out[name] = None
            continue
        low, high = value[c, math.floor(at[name])], value[c, math.ceil(at[name])]
        part = at[name] - math.floor(at[name])
        out[name] = low if low == high or part == 0 else low + (high - low) * part
    return out


def _ranked(
    df: DataFrame, values: dict[str, str], ranks: dict[tuple[str, int], _Span], size: dict[str, int], below: dict[str, int],
    above: dict[str, int], small: int,
) -> dict[tuple[str, int], float]:
    """Values at the ranks that lie inside their spans: one scan of ``df``."""
    if not ranks:
        return {}
    distinct = sorted(set(ranks.values()), key=lambda s: (s.column, s.low, s.high))
    held = materialize(_gathered(df, distinct, values), "quantiles")
    counts = {r["span"]: r for r in held.groupBy("span").agg(  # one row per span
        F.sum(F.expr("CASE WHEN v IS NULL THEN n ELSE 0 END")).alias("beside"), F.sum(F.expr("CASE WHEN v IS NULL THEN 0 ELSE n END")).alias("rows"),
        F.count("v").alias("values"),
    ).collect()}
    spans: dict[tuple[str, int], _Span] = {}
    known: list[_Span] = []
    for i, s in enumerate(distinct):
        r = counts.get(i)
        rows, beside = (r["rows"], r["beside"]) if r else (0, 0)
        before = size[s.column] - above[s.column] - beside - rows if s.before < 0 else below[s.column] + beside
        known.append(replace(s, before=before, inside=r["values"] if r else 0))
        for key, wants in ranks.items():
            if wants == s and before <= key[1] < before + rows:
                spans[key] = known[i]
    held = held.where("v IS NOT NULL")
    origin = {key: known.index(s) for key, s in spans.items()}
    value: dict[tuple[str, int], float] = {}
    while spans:
        value |= {k: s.low for k, s in spans.items() if s.low == s.high}
        spans = {k: s for k, s in spans.items() if k not in value}
        few = {k: s for k, s in spans.items() if s.inside <= small}
        if few:
            value |= _pick(held, few, origin)
        spans = {k: s for k, s in spans.items() if k not in few}
        if spans:
            spans = _narrow(held, spans, origin)
    return value


def _literal(x: float) -> str:
    return f"{float(x)!r}D" if math.isfinite(x) else f"CAST('{float(x)!r}' AS DOUBLE)"


def clip_bounds(
    df: DataFrame, columns: Sequence[str], percentile: float = 0.999, small: int = SMALL,
) -> dict[str, tuple[float | None, float | None]]:
    wanted = {}
    for c in columns:
        wanted[f"{c}.low"], wanted[f"{c}.high"] = (c, 1 - percentile), (c, percentile)
    found = exact_quantiles(df, wanted, small)
    return {c: (found[f"{c}.low"], found[f"{c}.high"]) for c in columns}


def clipped(c: str, low: float | None, high: float | None) -> Column:
    c = quoted(c)
    if low is None:
        return F.col(c)
    low, high = _literal(low), _literal(high)
    # NaN is above every number in Spark's order; here it is no number.
    return F.expr(f"CASE WHEN {c} < {low} THEN {low} WHEN {c} > {high} AND NOT isnan({c}) THEN {high} ELSE {c} END")


def clip_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, percentile: float = 0.999,
    fit_on: DataFrame | None = None, small: int = SMALL,
) -> DataFrame:
    """Clip columns to their outer quantiles, taken from ``fit_on`` or ``df`` itself."""
    columns = [c for c in (numeric_columns(df) if columns is None else columns) if c in df.columns]
    bounds = clip_bounds(df if fit_on is None else fit_on, columns, percentile, small)
    return df.withColumns({c: clipped(c, *bounds[c]) for c in columns})


def _top(df: DataFrame, columns: Sequence[str], percentile: float) -> dict[str, float | None]:
    return exact_quantiles(df, {c: (c, percentile) for c in columns})


def null_extremes(
    df: DataFrame, columns: Sequence[str], factor: float = 2.0, percentile: float = 0.999,
) -> DataFrame:
    """Values above ``factor`` times the top quantile become NULL."""
    top = _top(df, columns, percentile)
    return df.withColumns({
        c: F.expr(f"CASE WHEN {quoted(c)} <= {_literal(top[c] * factor)} AND NOT isnan({quoted(c)}) THEN {quoted(c)} END")
        for c in columns if top[c] is not None
    })


def cap_extremes(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, percentile: float = 0.999,
) -> DataFrame:
    """Values above ``factor`` times a positive top quantile become that limit."""
    top = _top(df, columns, percentile)
    return df.withColumns({
        c: clipped(c, -math.inf, top[c] * factor)
        for c in columns if top[c] is not None and top[c] > 0
    })


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return exact_quantiles(df, {c: (c, 0.5) for c in columns})


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Remaining NULLs become the median of their column."""
    middle = medians(df, columns)
    return df.withColumns({
        c: F.coalesce(F.expr(f"CASE WHEN NOT isnan({quoted(c)}) THEN {quoted(c)} END"), F.lit(middle[c])) for c in columns if middle[c] is not None
    })
