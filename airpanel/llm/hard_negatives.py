"""Hard negatives for every anchor and positive, by slots of scores.

Scores are inner products of vectors of integers. An anchor's positives are its best other rows of the same
label; a negative of a positive with score ``p`` is a row of another label with a score from ``ratio * p`` to ``p``.

* The windows of an anchor's positives overlap. Their upper limits split the scores into disjoint slots, so that a
  row lies in one slot of an anchor, however many windows hold it.
* Anchors stand in blocks, and so do all rows; a pair of blocks is one matrix product. It yields the best ``top``
  rows of each slot, and combiners keep the best ``top`` per slot before and after the shuffle.
* Slots merge from the lowest limit upwards: the best of a slot and of all below it answer the window that ends at
  its limit, cut off at the window's lower end.

Anchors are a stated query set. Anchor blocks are copied to all row blocks and row blocks to all anchor blocks, so
that each pair meets in one task of bounded size. Nothing is broadcast, and the driver learns two counts.

Defined cases: rows with a null label, a null vector, or a null, NaN or infinite component take no part. Shorter
vectors count as padded with zeros. A null id is never an anchor; among equal scores it comes last. Rows that repeat an
id are rows of their own as positives and negatives, but are no "other rows" for an anchor of that id; anchors
that repeat id, label and vector are one. Components are exact as long as scores fit 64 bits. An empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from airpanel.llm.common import written

#: The largest blocks of anchors and of rows; what is multiplied at a time.
ANCHORS, ROWS, CELLS = 4096, 16_384, 1024


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(id, label, vec) of the rows that take part: each component becomes floor(scale * x)."""
    vector = F.col(vector_col).cast("array<double>")
    # A difference with itself is NaN for infinite components, and null for null ones.
    finite = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x - x)), F.lit(False))
    whole = F.transform(vector, lambda x: F.floor(scale * x).cast("double"))
    return df.filter(finite & label.isNotNull()).select(F.col(id_col).alias("id"), label.cast("long").alias("label"), whole.alias("vec"))


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """The vectors as rows, padded with zeros."""
    vectors = vectors.combine_chunks()
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers; doubles hold them exactly while they are small."""
    most = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if most * most * max(1, a.shape[1]) < 2.0 ** 52:
        return (a @ b.T).astype(np.int64)
    a, b = (np.array([int(x) for x in m.ravel()], object).reshape(m.shape) for m in (a, b))
    return (a @ b.T).astype(np.int64)


def _best(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, order: np.ndarray, top: int) -> np.ndarray:
    """Places of the best ``top`` per anchor and slot: higher scores, then smaller ids."""
    by = np.lexsort((order, -score, slot, anchor))
    a, s = anchor[by], slot[by]
    head = np.ones(len(by), bool)
    head[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
    place = np.arange(len(by)) - np.flatnonzero(head)[np.cumsum(head) - 1]
    return by[place < top]


def _same_label(scores: np.ndarray, same: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """(anchor, row, slot) of rows that may be among the best of the anchor's label; there is one slot."""
    if same.shape[1] > 2 * top:  # nothing below the ``top``-th best can stay
        least = np.partition(np.where(same, scores, np.iinfo(np.int64).min), -top, axis=1)[:, -top]
        same = same & (scores >= least[:, None])
    a, r = np.nonzero(same)
    return a, r, np.zeros(len(a), np.int64)


def _other_labels(scores: np.ndarray, same: np.ndarray, limits: list[list[int]], ratio: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """(anchor, row, slot) of rows inside any window; a slot is numbered by the limits below it."""
    most = max(map(len, limits))
    ends = np.array([[*x, *[np.iinfo(np.int64).max] * (most - len(x))] for x in limits])
    high = np.array([x[-1] for x in limits])
    low = np.array([min(-(-ratio[0] * p // ratio[1]) for p in x) for x in limits])
    a, r = np.nonzero(~same & (scores <= high[:, None]) & (scores >= low[:, None]))
    return a, r, (scores[a, r][:, None] > ends[a]).sum(axis=1)


def _product(top: int, ratio: tuple[int, int] | None):
    """The best rows of a block for each anchor of a block, and for each slot if the anchors have limits."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        ids = rows["id"].combine_chunks()
        order = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
        width = max([0, *(pc.max(pc.list_value_length(t["vec"])).as_py() or 0 for t in (anchors, rows))])
        places: dict = {}
        for i, x in enumerate(anchors["id"].to_pylist()):
            places.setdefault(x, []).append(i)
        twins = [(i, r) for r, x in enumerate(ids.to_pylist()) if x in places for i in places[x]]
        limits = anchors["limits"].to_pylist() if ratio else None
        a_vec, r_vec = _matrix(anchors["vec"], width), _matrix(rows["vec"], width)
        a_label, r_label = anchors["label"].to_numpy(), rows["label"].to_numpy()
        found = [np.zeros((4, 0), np.int64)]
        for i in range(0, len(a_vec) if len(r_vec) else 0, CELLS):
            for j in range(0, len(r_vec), CELLS):
                scores = _scores(a_vec[i:i + CELLS], r_vec[j:j + CELLS])
                same = a_label[i:i + CELLS, None] == r_label[None, j:j + CELLS]
                if ratio:
                    a, r, slot = _other_labels(scores, same, limits[i:i + CELLS], ratio)
                else:
                    for x, y in twins:
                        if i <= x < i + CELLS and j <= y < j + CELLS:
                            same[x - i, y - j] = False
                    a, r, slot = _same_label(scores, same, top)
                score = scores[a, r]
                best = _best(a, slot, score, order[r + j], top)
                found.append(np.stack([a[best] + i, r[best] + j, slot[best], score[best]]))
        a, r, slot, score = np.concatenate(found, axis=1)
        best = _best(a, slot, score, order[r], top)
        return pa.table({
            "anchor": anchors["anchor"].combine_chunks().take(pa.array(a[best])), "slot": pa.array(slot[best], pa.int32()),
            "score": pa.array(score[best]), "id": ids.take(pa.array(r[best])),
        })

    return run


def _met(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int, top: int, ratio: tuple[int, int] | None) -> DataFrame:
    """(anchor, slot, score, id): the best ``top`` of each slot over all blocks of rows."""
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")).withColumn("group", each(groups))
    # By the place of a row in the written table, so that copies of a row spread.
    right = rows.withColumn("group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int")).withColumn("block", each(blocks))
    keys = ["block", "group"]
    kind = rows.schema["id"].dataType.simpleString()
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _product(top, ratio), f"anchor struct<id:{kind},key:bigint>, slot int, score long, id {kind}",
    )
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top)


def hard_negatives(
    df: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label",
    scale: int = 256, positives: int = 5, negatives: int = 5, ratio: tuple[int, int] = (80, 100),
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    ``anchors`` is a condition on ``id``; ``label_col`` may be an expression. A negative's score is at least
    ``ratio`` of the positive's, and not above it.
    """
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    rows = written(integer_vectors(df, id_col, vector_col, label, scale), "negative-vectors")
    chosen = rows.filter(F.col("id").isNotNull() & anchors).distinct().withColumn("anchor", F.struct("id", F.xxhash64("id", "label", "vec").alias("key")))
    chosen = written(chosen, "negative-anchors")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    groups = max(1, -(-n // min(ROWS, max(CELLS, n // (2 * parts)))))
    blocks = max(1, -(-chosen.count() // ANCHORS))
    near = written(_met(chosen, rows, blocks, groups, positives, None), "negative-positives")
    limits = near.groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("limits"))  # at most ``positives``
    slots = _met(chosen.join(limits, "anchor"), rows, blocks, groups, negatives, ratio)
    # From the lowest slot upwards, each with the best of all below it.
    entry = F.struct((-F.col("score")).alias("down"), F.col("id").isNull().alias("none"), F.col("id").alias("negative_id"))
    slots = slots.groupBy("anchor", "slot").agg(F.array_sort(F.collect_list(entry)).alias("best"))
    slots = slots.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("slot", "best"))).alias("slots"))
    kind = slots.schema["slots"].dataType.valueType
    empty = F.array().cast(kind)
    merged = limits.join(slots, "anchor").select(
        "anchor", "limits", F.aggregate(
            F.sequence(F.lit(0), F.size("limits") - 1), F.struct(empty.alias("last"), F.array().cast(ArrayType(kind)).alias("all")),
            lambda acc, j: _merged(acc, F.coalesce(F.col("slots")[j], empty), negatives), lambda acc: acc["all"],
        ).alias("windows"),
    )
    asked = near.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("place").alias("place"))
    window = F.element_at("windows", F.array_position("limits", F.col("positive_score")).cast("int"))
    wide = lambda c: c.cast("decimal(19,0)")
    least = F.filter(window, lambda e: -wide(e["down"]) * ratio[1] >= wide(F.col("positive_score")) * ratio[0])
    return asked.join(merged, "anchor").select(
        F.col("anchor.id").alias("anchor_id"), "positive_id", F.posexplode(least).alias("at", "e"), "positive_score",
    ).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.negative_id").alias("negative_id"),
        "positive_score", (-F.col("e.down")).alias("negative_score"),
    )


def _merged(acc: Column, slot: Column, top: int) -> Column:
    """The next window: the best of a slot and of what lies below it."""
    best = F.slice(F.array_sort(F.concat(acc["last"], slot)), 1, top)
    return F.struct(best.alias("last"), F.concat(acc["all"], F.array(best)).alias("all"))
