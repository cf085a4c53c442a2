"""Per-node row frames without putting a whole node into one task.

A window over ``partitionBy(node)`` sends every row of a node to one task, which
fails when one node holds a large share of the data. Here a node's history is
cut into chunks of consecutive positions and the windows run per (node, chunk):

* bounded frames get a *halo*: the rows a chunk's frames reach into are also
  sent to that chunk and dropped after evaluation;
* unbounded looks (last or next known value, running counts) work on one
  summary row per chunk, whose result is carried back into the chunk.

Both give exactly the rows of the plain per-node window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from airpanel.functions.clock import hour_index
from airpanel.operators.rows import quoted
from airpanel.session import checkpointed

NODE = "node_id"
TIME = "timestamp"
CHUNK = 4096


def chunk_of(position: str, size: int) -> Column:
    """Number of the chunk that holds a position (floor, also below zero).

    ``position`` is a column name or SQL expression.
    """
    return F.expr(f"(({position}) - pmod({position}, {size})) DIV {size}")


def with_positions(
    df: DataFrame,
    keys: Sequence[str] = (NODE,),
    order: Sequence[str] = (TIME,),
    size: int = CHUNK,
    name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Add each row's 0-based place within its node, in time order.

    Rows are numbered inside (node, time chunk); the count of earlier rows comes
    from one summary row per chunk. ``total`` adds the node's row count.
    """
    return placed(numbered(_time_chunked(df, order[0], size), "_tc", keys, order), "_tc", keys, name, total)


def numbered(
    df: DataFrame, chunk: str, keys: Sequence[str] = (NODE,), order: Sequence[str] = (TIME,),
) -> DataFrame:
    """Add ``_rn``, the 0-based place within (node, chunk)."""
    inside = Window.partitionBy(*keys, chunk).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(inside) - 1)


def placed(
    df: DataFrame, chunk: str, keys: Sequence[str] = (NODE,), name: str = "position",
    total: str | None = None,
) -> DataFrame:
    """Turn ``_rn`` and a chunk column that rises with time into the place within the node."""
    node = Window.partitionBy(*keys)
    earlier = node.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias("_n"))
    summary = [F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")]
    if total:
        summary.append(F.sum("_n").over(node).alias(total))
    offsets = counts.select(*keys, chunk, *summary)
    return (
        df.join(offsets, [*keys, chunk])
        .withColumn(name, F.expr("CAST(_before + _rn AS BIGINT)"))
        .drop(chunk, "_rn", "_before")
    )


def frame(w: WindowSpec, before: int, after: int = 0) -> WindowSpec:
    """Rows from ``before`` rows back to ``after`` rows ahead."""
    return w.rowsBetween(-before, after)


def windowed(
    df: DataFrame,
    columns: dict[str, Callable[[WindowSpec], Column]],
    lookback: int = 0,
    lookahead: int = 0,
    position: Column | None = None,
    keys: Sequence[str] = (NODE,),
    order: Sequence[str] = (TIME,),
    size: int = CHUNK,
    place: str | None = None,
) -> DataFrame:
    """Add per-node row-frame columns; no frame may reach past the given looks.

    The windows run inside (node, time chunk), which shuffles the rows once. Only
    the rows whose frames reach out of their chunk are evaluated again: with the
    rows that their frames need they are the edges of the chunks, at most
    ``2 * (lookback + lookahead)`` rows of each, which are numbered from one row
    per chunk and get a halo. Rows without a node or time are left out.

    ``position`` may be given when it is known without counting, such as the hour
    on a gap-free hourly grid; it must rise by one from row to row. Rows then go to
    their chunk and to those that look at them in one shuffle.

    ``place`` adds each row's 0-based place within its node, as :func:`with_positions`
    does, from the chunks' row counts; it needs no shuffle of the rows of its own.
    """
    keys = list(keys)
    if position is not None:
        if place is not None:
            raise ValueError("rows whose position is given are not counted")
        return _haloed(df.withColumn("_pos", position), columns, lookback, lookahead, keys, size)
    own = [F.col(quoted(c)) for c in df.columns]
    # As the joins below ask for it, so that all readers of the shuffle see one plan.
    df = _time_chunked(df, order[0], size).where(" AND ".join(f"{quoted(k)} IS NOT NULL" for k in [*keys, "_tc"]))
    chunk = Window.partitionBy(*keys, "_tc")
    inside = chunk.orderBy(*order)
    rows = df.withColumns({"_rn": F.row_number().over(inside), "_rows": F.count(F.lit(1)).over(chunk)})
    reach = lookback + lookahead
    beyond = F.expr(f"_rn <= {lookback} OR _rn > _rows - {lookahead}")
    # The edges need the columns as they came, also those that a window replaces.
    settled = rows.withColumns({name: make(inside) for name, make in columns.items()}).where(~beyond)
    # One row per chunk. It asks for all columns, so that its rows come from the one shuffle of all columns.
    first = rows.where("_rn = 1").where(F.length(F.to_json(F.struct(*own))) > 0)
    earlier = Window.partitionBy(*keys).orderBy("_tc").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"_n": "_before"} | ({"_rows": "_earlier"} if place else {})
    offsets = first.select(*keys, "_tc", "_rows", F.least("_rows", F.lit(2 * reach)).alias("_n")).select(
        *keys, "_tc", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(name) for n, name in sums.items()],
    )
    placed_at = [F.expr("CAST(_earlier + _rn - 1 AS BIGINT)").alias(place)] if place else []
    if place:
        settled = settled.join(offsets.select(*keys, "_tc", "_earlier"), [*keys, "_tc"]).select(*own, *[c for c in columns if c not in df.columns], *placed_at)
    settled = settled.drop("_tc", "_rn", "_rows")
    edges = rows.where(F.expr(f"_rn <= {reach} OR _rn > _rows - {reach}")).select(
        *own, "_tc", *(["_rn"] if place else []), beyond.alias("_beyond"), F.expr(f"least(_rn, greatest({reach}, 2 * {reach} + _rn - _rows)) - 1").alias("_place"),
    )
    edges = edges.join(offsets, [*keys, "_tc"]).select(*own, *placed_at, "_beyond", F.expr("CAST(_before + _place AS BIGINT)").alias("_pos"))
    # A frame of a row at an edge ends inside it, so the gap between two edges of a chunk is never crossed.
    edges = _haloed(edges, columns, lookback, lookahead, keys, size)
    return settled.unionByName(edges.where("_beyond").drop("_beyond"))


def _time_chunked(df: DataFrame, time: str, size: int) -> DataFrame:
    return df.withColumn("_h", hour_index(time)).withColumn("_tc", chunk_of("_h", size)).drop("_h")


def _haloed(
    df: DataFrame, columns: dict[str, Callable[[WindowSpec], Column]], lookback: int, lookahead: int, keys: Sequence[str], size: int,
) -> DataFrame:
    """Windows over chunks of positions ``_pos``; rows also go to the chunks that look at them."""
    first, last = chunk_of(f"_pos - {lookahead}", size), chunk_of(f"_pos + {lookback}", size)
    df = df.withColumn("_chunk", F.explode(F.sequence(first, last)))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    df = df.withColumns({name: make(w) for name, make in columns.items()})
    own = chunk_of("_pos", size) == F.col("_chunk")
    return df.where(own).drop("_pos", "_chunk")


def known_neighbours(
    df: DataFrame,
    columns: Sequence[str],
    position: str,
    chunk: str,
    keys: Sequence[str] = (NODE,),
    order: str | None = None,
    ahead: bool = True,
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """Add ``{c}_prev`` and ``{c}_next``: nearest known ``(at, value)`` of each column.

    ``_prev`` looks back including the row itself, ``_next`` (with ``ahead``)
    looks ahead without it, both without limit. Every chunk contributes its first
    and last known values; these few rows are carried along the node and come
    back as one row before and one row after each chunk, so the looks need one
    shuffle, one sort and no join. ``extra`` adds window functions over the rows
    of the chunk, as SQL; the row after the chunk has the next chunk's first
    position.
    """
    keys = list(keys)
    q = quoted
    names = [q(k) for k in keys]
    aggs = [F.expr(f"min({position}) AS _first")]
    for c in columns:
        at = f"CASE WHEN {q(c)} IS NOT NULL THEN {position} END"
        aggs += [
            F.expr(f"min({at}) AS {q(c + '_fa')}"), F.expr(f"min_by({q(c)}, {at}) AS {q(c + '_fv')}"),
            F.expr(f"max({at}) AS {q(c + '_la')}"), F.expr(f"max_by({q(c)}, {at}) AS {q(c + '_lv')}"),
        ]
    edges = df.groupBy(*names, chunk).agg(*aggs)

    def known(at: str, value: str) -> str:
        return f"CASE WHEN {value} IS NOT NULL THEN struct({at} AS at, {value} AS value) END"

    node = f"(PARTITION BY {', '.join(names)} ORDER BY {chunk})"
    before = f"(PARTITION BY {', '.join(names)} ORDER BY {chunk} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = [f"lead(_first) OVER {node} AS _next_first"]
    for c in columns:
        carried += [
            f"last({known(q(c + '_la'), q(c + '_lv'))}, true) OVER {before} AS {q(c + '_in')}",
            f"lead({known(q(c + '_fa'), q(c + '_fv'))}, 1) IGNORE NULLS OVER {node} AS {q(c + '_out')}",
        ]
    cells = {
        side: ", ".join(f"{q(f'{c}_{side}')}.value AS {q(c)}, {q(f'{c}_{side}')}.at AS {q(c + '_at')}" for c in columns)
        for side in ("in", "out")
    }
    ends = ", ".join(
        f"struct({where} AS _side, {at} AS {position}{', ' if columns else ''}{cells[side]})"
        for side, where, at in (("in", -1, "CAST(NULL AS BIGINT)"), ("out", 1, "_next_first"))
    )
    edges = edges.selectExpr(*names, chunk, *carried).selectExpr(*names, chunk, f"inline(array({ends}))")

    rows = df.withColumn("_side", F.lit(0)).unionByName(edges, allowMissingColumns=True)
    over = f"PARTITION BY {', '.join([*names, chunk])} ORDER BY _side, {order or position}"
    looks = [f"{e} OVER ({over}) AS {name}" for name, e in (extra or {}).items()]
    for c in columns:
        pair = known(f"coalesce({q(c + '_at')}, {position})", q(c))
        so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        looks.append(f"last({pair}, true) OVER ({over} {so_far}) AS {q(c + '_prev')}")
        if ahead:
            looks.append(f"lead({pair}, 1) IGNORE NULLS OVER ({over}) AS {q(c + '_next')}")
    return rows.selectExpr(*map(q, df.columns), "_side", *looks).where("_side = 0").drop("_side")


def global_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """0-based place of each row in a total order of the whole table.

    A distributed sort gives even partitions whatever the keys; the offset of a
    partition comes from one count per partition. The sorted rows are
    checkpointed because both uses must see the same partitions.
    """
    rows = checkpointed(df.sort(*order)).withColumn("_mid", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_mid", 33))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(offsets, "_part").withColumn(name, place).drop("_mid", "_part", "_before")
