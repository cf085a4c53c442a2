"""Repeated passages by suffix-array deduplication over the whole corpus.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller id,
or before it in the same document. Strings are judged on the input.

* Anchors deal the work out. The anchor of a window of ``length`` bytes is its 20-byte string of least hash,
  so equal windows have equal anchors at the same place. Neighbouring windows with one anchor form a segment.
  An anchor that occurs once in the corpus has no repeated window.
* Segments whose anchor repeats collapse by a digest of their bytes, in the task that cuts them and again where they
  meet; all but the first occurrence of a segment repeat throughout. An anchor that is left with one segment is done.
* Segments that differ but share an anchor are indexed together: suffix order, Burrows-Wheeler transform, and
  breadth-first backward extension that finds common prefixes by increasing value and stops at ``length``
  (``suffix_index``). Suffixes it leaves together share a window, of which all but the first are repeats.
* An anchor with more than ``most`` different segments, such as a line in a third of all documents, is known by its
  count before its segments are sent. They are cut into sets of ``WIDTH`` windows, each sent by the bytes that its
  windows share, so that many tasks index them. Only a set that is crowded even so is cut into single windows, which
  are marked by equality. Nothing is dropped.

The packed texts cross one shuffle, which all three joins read.

Defined cases: a null text is the empty text. Ids may be of any type with an order; a null id is smaller than any
other. Rows that repeat both id and text are one document, and each gets its result; of rows that share the id
only, the smaller hash of id and text comes first. Texts of any length are taken whole, in overlapping parts while they
are anchored. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.common import slices
from airpanel.llm.passages import Corpus, Sent, claims, each, flagged, marked, only_repeated, union_of
from airpanel.llm.suffix_index import prefix_groups

ANCHOR = 20
#: Windows of a crowded anchor that are sent together; they share all but so many bytes.
WIDTH = 9
#: Bytes indexed at a time, and anchored at a time (places fit 20 bits).
CHUNK, BLOCK = 64_000, 1 << 19
_B = np.uint64(0x9E3779B97F4A7C15)


def _hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` bytes, from hashes of powers of two."""
    power: dict[int, np.ndarray] = {1: (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)}
    size, factor = 1, int(_B)
    factors = {1: _B}
    while 2 * size <= k:
        part = power[size]
        power[2 * size] = part[:-size] * factors[size] + part[size:]
        size *= 2
        factor = factor * factor % (1 << 64)
        factors[size] = np.uint64(factor)
    value, have = None, 0
    for size in sorted(power, reverse=True):
        if have + size <= k:
            part = power[size][have:]
            n = len(data) - have - size + 1
            value = part if value is None else value[:n] * factors[size] + part
            have += size
    return _mixed(value)


def _hash_at(data: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The hashes of :func:`_hashes` at a few places."""
    factors = np.full(k, _B, np.uint64)
    factors[0] = 1
    factors = np.multiply.accumulate(factors)[::-1]
    found = (data[places[:, None] + np.arange(k)].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return _mixed((found * factors).sum(axis=1, dtype=np.uint64))


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(29))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[:len(keys) - rest], keys[rest:]) if rest else keys


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(document, hash, place, first window, last window) of every segment of the documents in ``data``.

    ``starts`` and ``ends`` bound the documents, in order; places count from a document's start.
    """
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 5
    hashes = _hashes(data, ANCHOR)
    keys = (hashes & ~np.uint64(0xFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    place = (_least(keys, length - ANCHOR + 1) & np.uint64(0xFFFFF)).astype(np.int64)
    windows = np.arange(len(place))
    document = np.searchsorted(starts, windows, side="right") - 1
    inside = windows + length <= ends[document]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (document[1:] != document[:-1])
    new &= inside
    first = windows[new]
    # A segment ends before the next one begins, or at the last window of its document.
    last = np.minimum(np.append(first[1:], len(place)) - 1, ends[document[first]] - length)
    document, at = document[first], place[first]
    return document, hashes[at].view(np.int64), at - starts[document], first - starts[document], last - starts[document]


def _blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, bytes, starts, ends) of documents in blocks; a longer document comes in overlapping parts."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, side="right")) - 1)
        rows = np.arange(row, stop)
        yield rows, data[offsets[row]:offsets[stop]], offsets[row:stop] - offsets[row], offsets[row + 1:stop + 1] - offsets[row]
        row = stop


def _segments(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, hash, place, first, last) of all documents of a batch."""
    for rows, data, starts, ends in _blocks(batch["text"]):
        if len(data) <= BLOCK:
            document, *rest = anchors(data, starts, ends, length)
            yield rows[document], *rest
            continue
        for at in range(0, len(data), BLOCK):  # one document; the windows of each part begin in it
            part = data[at:at + BLOCK + length - 1]
            document, hashed, place, first, last = anchors(part, np.zeros(1, np.int64), np.array([len(part)]), length)
            yield rows[document], hashed, place + at, first + at, last + at


def _anchor_rows(length: int):
    """Anchors as (v, doc, at): ``at`` packs the place, its distances to the first and last window, and a flag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            found = [x for x in _segments(batch, length) if len(x[0])]
            if found:
                row, v, place, first, last = (np.concatenate(c) for c in zip(*found, strict=True))
                yield flagged(v, batch["doc"].to_numpy()[row], place << 14 | (place - first) << 7 | (place - last))

    return run


def _cut_segments(length: int, id_type: pa.DataType):
    """From documents with their repeated anchors to segments, by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent(id_type, False)
        for found in marked(batches):
            if found is None:
                yield from sent.flush()
                continue
            doc_id, doc, text, marks = found
            at = np.array([m[0] for m in marks], np.int64) >> 2
            place = at >> 14
            start, end = place - (at >> 7 & 127), place - (at & 127) + length
            real = (start >= 0) & (end <= len(text))  # else the anchor of another document with the same hash
            place, start, end = place[real], start[real], end[real]
            v = _hash_at(np.frombuffer(text, np.uint8), place, ANCHOR).view(np.int64)
            for p, a, b, key in zip(place.tolist(), start.tolist(), end.tolist(), v.tolist(), strict=True):
                sent.add(text[a:b], doc_id, doc, a, b, key, p - a)

    return run


SEGMENTS = "v long, seg binary, id {0}, doc long, start long, end long, anchor int"


class _Out:
    """Rows of SEGMENTS: segments, and marks (``seg`` null) of byte ranges that go."""

    names = ("v", "seg", "id", "doc", "start", "end", "anchor")

    def __init__(self, id_type: pa.DataType):
        self.rows: list[tuple] = []
        self.kinds = (pa.int64(), pa.binary(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.int32())

    def segment(self, key: int, seg: bytes, doc_id, doc: int, start: int, anchor: int) -> None:
        self.rows.append((key, seg, doc_id, doc, start, start + len(seg), anchor))

    def narrowed(self, seg: bytes, doc_id, doc: int, start: int, anchor: int, length: int, width: int) -> None:
        """A segment cut into sets of ``width`` windows, keyed by the bytes that these share."""
        last = len(seg) - length  # the last window, counted from the segment's start
        for lo in range(0, length, width):
            # Windows that begin ``lo`` to ``lo + width - 1`` bytes before the anchor.
            a, b = max(0, anchor - lo - width + 1), min(last, anchor - lo)
            if a <= b:
                core = seg[anchor - lo:anchor - lo - width + 1 + length]
                self.segment(xxhash.xxh64_intdigest(core, lo) - (1 << 63), seg[a:b + length], doc_id, doc, start + a, anchor - a)

    def mark(self, doc_id: int, doc: int, start: int, end: int) -> None:
        if self.rows:
            last = self.rows[-1]
            if last[1] is None and last[2] == doc_id and last[3] == doc and last[4] <= start <= last[5] <= end:
                self.rows[-1] = (0, None, doc_id, doc, last[4], end, 0)
                return
        self.rows.append((0, None, doc_id, doc, start, end, 0))

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = zip(*self.rows, strict=True)
            arrays = [pa.array(c, k) for c, k in zip(columns, self.kinds, strict=True)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(arrays, names=self.names)


def _sent_segments(length: int, most: int, id_type: pa.DataType):
    """From documents with the segments (start, end, anchor, v, n) that are first of their kind to their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Out(id_type)
        for found in marked(batches):
            if found is None:
                yield from out.flush()
                continue
            doc_id, doc, text, marks = found
            for start, end, anchor, v, n in marks:
                if end > len(text):
                    continue  # a segment of another document with the same hash
                if n > most:
                    out.narrowed(text[start:end], doc_id, doc, start, anchor, length, WIDTH)
                else:
                    out.segment(v, text[start:end], doc_id, doc, start, anchor)

    return run


def _single(length: int, id_type: pa.DataType):
    """Segments cut into single windows; marks pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            out = _Out(id_type)
            for row in zip(*(batch[c].to_pylist() for c in _Out.names), strict=True):
                if row[1] is None:
                    out.rows.append(row)
                else:
                    out.narrowed(row[1], row[2], row[3], row[4], row[6], length, 1)
            yield from out.flush()

    return run


def _index(groups: list[list[tuple]], length: int, out: _Out) -> None:
    """Marks every window of the groups' segments that also starts earlier."""
    rows = [r for g in groups for r in g]
    text = np.frombuffer(b"\0".join(r[1] for r in rows) + b"\0", np.uint8)
    sizes = np.array([len(r[1]) for r in rows], np.int64) + 1
    starts = np.cumsum(sizes) - sizes
    segment = np.repeat(np.arange(len(rows)), sizes)
    offset = np.arange(len(text)) - starts[segment]
    # Bytes as small symbols above 0, which ends a segment.
    used, symbols = np.unique(text, return_inverse=True)
    symbols = (symbols + 1).astype(np.uint16)
    symbols[starts + sizes - 1] = 0
    order, group = prefix_groups(symbols, length)
    window = offset[order] + length < sizes[segment[order]]
    order, group = order[window], group[window]
    # Documents by their rank: smaller ids first, null before all.
    documents = sorted({(r[2] is not None, r[2], r[3]) for r in rows})
    rank = {d: i for i, d in enumerate(documents)}
    docs = np.array([rank[r[2] is not None, r[2], r[3]] for r in rows], np.int64)
    absolute = np.array([r[4] for r in rows], np.int64)
    seg = segment[order]
    place = absolute[seg] + offset[order]
    by = np.lexsort((place, docs[seg], group))
    first = np.ones(len(by), bool)
    first[1:] = group[by][1:] != group[by][:-1]
    gone = by[~first]
    gone = gone[np.lexsort((place[gone], seg[gone]))]
    if not len(gone):
        return
    s, p = seg[gone], place[gone]
    cut = np.flatnonzero((s[1:] != s[:-1]) | (p[1:] != p[:-1] + 1)) + 1
    for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(s)).tolist(), strict=True):
        r = rows[s[a]]
        out.mark(r[2], r[3], int(p[a]), int(p[b - 1]) + length)


def _meet(length: int, most: int | float, id_type: pa.DataType):
    """Rows sorted by key and segment: marks pass, keys with few segments are indexed, others pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, groups, size = _Out(id_type), [], 0
        key, group, many, previous = None, [], False, None

        def settled() -> None:
            nonlocal size
            if not many and len(group) > 1:
                groups.append(group)
                size += sum(len(r[1]) for r in group)

        for batch in slices(batches, 2000):
            for row in zip(*(batch[c].to_pylist() for c in _Out.names), strict=True):
                if row[1] is None:
                    out.rows.append(row)
                    continue
                if row[0] != key:
                    settled()
                    key, group, many, previous = row[0], [], False, None
                    if size > CHUNK:
                        _index(groups, length, out)
                        groups, size = [], 0
                if previous is not None and row[1] == previous[1]:
                    if row[2:5] != previous[2:5]:
                        out.mark(row[2], row[3], row[4], row[5])
                    continue
                previous = row
                if many:
                    out.rows.append(row)
                else:
                    group.append(row)
                    if len(group) > most:
                        out.rows.extend(group)
                        many, group = True, []
            yield from out.flush()
        settled()
        if groups:
            _index(groups, length, out)
        yield from out.flush()

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    """Segments by key and in order; marks go anywhere."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    route = F.when(F.col("seg").isNull(), F.xxhash64("doc", "start")).otherwise(F.col("v"))
    return rows.repartition(parts, route).sortWithinPartitions("v", "seg", "id", "doc", "start")


def repeated_ranges(corpus: Corpus, length: int = 100, most: int = 300) -> DataFrame:
    """(id, doc, start, end) of byte ranges that go. Ranges may touch or overlap."""
    kind = corpus.id_type
    found = corpus.docs.select("doc", "text").filter(F.octet_length("text") >= length).mapInArrow(_anchor_rows(length), "v long, doc long, at long")
    # Without the anchors' hashes, which the texts give again.
    anchored = corpus.with_marks(only_repeated(found).select("doc", "at"), F.struct("at"))
    segments = corpus.pieces(anchored, _cut_segments(length, kind))
    first = segments.filter("stays").select("v", "doc", "start", "end", F.col("own").alias("anchor"))
    several = first.groupBy("v").agg(F.count("*").alias("n")).filter("n > 1")
    shared = corpus.with_marks(first.join(several, "v"), F.struct("start", "end", "anchor", "v", "n"))
    schema = SEGMENTS.format(corpus.id_name)
    sent = shared.mapInArrow(_sent_segments(length, most, kind), schema)
    met = _dealt(sent).mapInArrow(_meet(length, most, kind), schema)
    left = _dealt(met.mapInArrow(_single(length, kind), schema)).mapInArrow(_meet(length, np.inf, kind), schema)
    return left.filter("seg IS NULL").select("id", "doc", "start", "end").unionAll(claims(segments).select("id", "doc", "start", "end"))


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, most: int = 300, with_text: bool = False,
) -> DataFrame:
    """One row per row of ``df``: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``; with ``kept`` bytes if asked."""
    if not ANCHOR < length <= 128:
        raise ValueError("length must be above the anchor's and at most 128")
    corpus = Corpus(df, id_col, text_col, bytes)
    joined = corpus.with_marks(repeated_ranges(corpus, length, most), F.struct("id", "start", "end"), "left")

    def row(doc_id, text: bytes, ranges: list[tuple]) -> list[tuple]:
        at, parts, runs = 0, [], union_of(ranges)
        for start, end in runs:
            parts.append(text[at:start])
            at = end
        kept = b"".join([*parts, text[at:]]) if runs else text
        return [(doc_id, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), *([kept] if with_text else []))]

    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    kinds = [corpus.id_type, pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_text
    schema = f"id {corpus.id_name}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return each(joined, schema, row, names, kinds).withColumnRenamed("id", id_col)
