"""What the operators on repeated passages share: packed texts, pieces of them by digest, claims that they repeat.

A document is known by a hash of id and text until its text is at hand. If two documents share that hash, pieces cut
for the wrong one are still true pieces of it, and claims carry the id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from airpanel.llm.common import slices, text_of

#: Pieces that a task remembers having sent.
KEPT = 200_000


def arrow_type(kind: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def union_of(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of sorted or unsorted half-open ranges."""
    runs: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (v, doc, at), sorted by ``v``, whose ``v`` is that of a neighbour or is known to repeat.

    The last two bits of ``at`` tell that: 0 if the task that made the row knows no other, 1 if it does.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[c].to_numpy() for c in ("v", "doc", "at")]
        joined = False
        if held is not None:
            joined = bool(held[1])
            columns = [np.concatenate([[h], c]) for h, c in zip(held[0], columns, strict=True)]
        v = columns[0]
        same = v[1:] == v[:-1]
        keep = (columns[2] & 3) > 0
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= joined
        last_joined = bool(keep[-1])
        held = ([c[-1] for c in columns], last_joined)
        keep[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=["v", "doc", "at"])
    if held is not None and held[1]:
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in held[0]], names=["v", "doc", "at"])


def flagged(v: np.ndarray, doc: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
    """A batch of keys for :func:`repeated`, with ``at`` moved up by two bits for the flag.

    Of keys met several times, one row (flag 1) tells the others; the rest (flag 2) are known to repeat and need
    not meet anybody.
    """
    order = np.argsort(v, kind="stable")
    v = v[order]
    head = np.ones(len(v), bool)
    head[1:] = v[1:] != v[:-1]
    flag = np.where(head & np.append(head[1:], True), 0, np.where(head, 1, 2))
    return pa.RecordBatch.from_arrays([pa.array(v), pa.array(doc[order]), pa.array(at[order] << 2 | flag)], names=["v", "doc", "at"])


def only_repeated(rows: DataFrame) -> DataFrame:
    """The rows of :func:`flagged` batches whose key occurs more than once; a frequent key meets once per batch."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    route = F.when(F.col("at").bitwiseAND(3) == 2, F.xxhash64("doc", "at")).otherwise(F.col("v"))
    return rows.repartition(parts, route).sortWithinPartitions("v").mapInArrow(repeated, "v long, doc long, at long")


class Sent:
    """Rows of one task: pieces by their digest, and claims for pieces that the task has seen before.

    A row is (d1, d2, ids, at): ``ids`` holds the document's id and that of the source, ``at`` the document's hash,
    start, end, the key of the piece, the start in the source, which is -1 for a piece, and a number of the
    operator's own. All readers of the rows need all four columns, so that they share one shuffle.
    """

    def __init__(self, id_type: pa.DataType, sources: bool):
        self.first: dict[bytes, tuple] = {}
        self.id_type, self.sources = id_type, sources
        self.digests: list[bytes] = []
        self.pieces: list[tuple] = []
        self.piece_ids: list = []
        self.claims: list[tuple] = []
        self.claim_ids: list = []

    def add(self, piece: bytes, doc_id, doc: int, start: int, end: int, v: int, own: int = 0) -> None:
        digest = hashlib.blake2b(piece, digest_size=16).digest()
        here = (doc_id is not None, doc_id, doc, start)
        sent = self.first.get(digest)
        if sent is None or here < sent:
            self.first[digest] = here
            self.digests.append(digest)
            self.pieces.append((doc, start, end, v, -1, own))
            self.piece_ids += (doc_id, None)
        elif here != sent:
            self.claim(doc_id, doc, start, end, sent)

    def claim(self, doc_id, doc: int, start: int, end: int, sent: tuple) -> None:
        if self.claims:
            last = self.claims[-1]
            goes_on = not self.sources or last[4] - last[1] == sent[3] - start and self.claim_ids[-1] == sent[1]
            if last[0] == doc and last[1] <= start <= last[2] and self.claim_ids[-2] == doc_id and goes_on:
                self.claims[-1] = (doc, last[1], max(end, last[2]), 0, last[4], 0)
                return
        self.claims.append((doc, start, end, 0, sent[3], 0))
        self.claim_ids += (doc_id, sent[1])

    def flush(self) -> Iterator[pa.RecordBatch]:
        if len(self.first) > KEPT:
            self.first = {}
        n = len(self.pieces) + len(self.claims)
        if n:
            claims = np.array(self.claims, np.int64).reshape(-1, 6)
            at = np.concatenate([np.array(self.pieces, np.int64).reshape(-1, 6), claims])
            digests = np.frombuffer(b"".join(self.digests), np.int64).reshape(-1, 2)
            keys = np.concatenate([digests, claims[:, :2]])  # a claim is dealt by its place
            ids = pa.array(self.piece_ids + self.claim_ids, self.id_type)
            yield pa.RecordBatch.from_arrays([
                pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * n + 1, 2, np.int32)), ids),
                pa.ListArray.from_arrays(pa.array(np.arange(0, 6 * n + 1, 6, np.int32)), pa.array(at.ravel())),
            ], names=["d1", "d2", "ids", "at"])
            self.digests, self.pieces, self.piece_ids, self.claims, self.claim_ids = [], [], [], [], []


def met(rows: DataFrame) -> DataFrame:
    """Rows of :class:`Sent` beside the first occurrence of their digest; a task sends a piece once, or a few times."""
    ids, at = F.col("ids"), F.col("at")
    piece, here = at[4] < 0, F.struct(ids[0].alias("id"), at[0].alias("doc"), at[1].alias("start"))
    least = F.min(F.when(piece, here)).over(Window.partitionBy("d1", "d2", at[4] >= 0))
    return rows.withColumn("first", least).select(
        ids[0].alias("id"), at[0].alias("doc"), at[1].alias("start"), at[2].alias("end"), at[3].alias("v"), at[5].alias("own"),
        F.when(piece, F.col("first.id")).otherwise(ids[1]).alias("from_id"), F.when(piece, F.col("first.start")).otherwise(at[4]).alias("from_start"),
        (piece & here.eqNullSafe(F.col("first"))).alias("stays"),
    )


def claims(rows: DataFrame) -> DataFrame:
    """(id, doc, start, end, from_id, from_start) of what repeats."""
    return rows.filter(~F.col("stays")).drop("stays", "v", "own")


def lists(column: pa.Array) -> Iterator[list[tuple]]:
    """The structs of each list; none for a null."""
    values = column.flatten()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
    rows = list(zip(*(values.field(i).to_pylist() for i in range(values.type.num_fields)), strict=True))
    start = 0
    for end in ends:
        yield rows[start:end]
        start = end


def marked(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[tuple | None]:
    """(id, doc, text, marks) of documents in the order of their ids, so that most often the first of equals is sent first.

    None ends a slice.
    """
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches, rows):
        found = zip(*(batch[c].to_pylist() for c in ("id", "doc", "z")), lists(batch["marks"]), strict=True)
        for doc_id, doc, packed, marks in sorted(found, key=lambda r: (r[0] is not None, r[0], r[1])):
            yield doc_id, doc, unpack(packed), sorted(set(marks))
        yield None


class Corpus:
    """Documents by a hash of id and text, with their texts packed after ``prepared``."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, prepared: Callable[[bytes], bytes]):
        text = text_of(text_col)
        self.docs = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("doc"), text.cast("binary").alias("text"))
        kind = self.docs.schema["id"].dataType
        self.id_name, self.id_type = kind.simpleString(), arrow_type(kind)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            squeeze = zstandard.ZstdCompressor(level=1).compress
            for batch in slices(batches):
                packed = pa.array([squeeze(prepared(t)) for t in batch["text"].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["id"], batch["doc"], packed], names=["id", "doc", "z"])

        # The condition is that of an inner join, so that all joins share one shuffle of the texts.
        self.packed = self.docs.mapInArrow(pack, f"id {self.id_name}, doc long, z binary").filter("doc IS NOT NULL")

    def with_marks(self, marks: DataFrame, mark: Column, how: str = "inner") -> DataFrame:
        """Texts joined with the list of their marks."""
        found = marks.groupBy("doc").agg(F.collect_list(mark).alias("marks"))
        return self.packed.join(found, "doc", how).select("id", "doc", "z", "marks")

    def pieces(self, marked_docs: DataFrame, cut: Callable) -> DataFrame:
        """What ``cut`` sends for documents with marks, beside the first occurrence of each digest."""
        return met(marked_docs.mapInArrow(cut, f"d1 long, d2 long, ids array<{self.id_name}>, at array<long>"))


def each(joined: DataFrame, schema: str, row: Callable, names: list[str], kinds: list[pa.DataType]) -> DataFrame:
    """``row(id, text, claims)`` gives the rows of a document; marks begin with the id that they are for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, 500):
            out = []
            for doc_id, packed, marks in zip(batch["id"].to_pylist(), batch["z"].to_pylist(), lists(batch["marks"]), strict=True):
                out += row(doc_id, unpack(packed), [m[1:] for m in marks if m[0] == doc_id])
            columns = zip(*out, strict=True) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return joined.mapInArrow(run, schema)
