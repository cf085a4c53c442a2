"""Repeated passages of words by a compacted De Bruijn graph over the whole corpus.

A word goes if a window of ``window`` words that covers it also starts earlier: in a document of smaller id, or
before it in the same document. Windows are judged on the input.

* Every window is an edge of the graph, from the node of its first to the node of its last ``window - 1`` words.
  The minimizer of a window is its string of ``minimizer`` words of least hash, so equal edges have equal
  minimizers. Neighbouring edges of a document with one minimizer form a run, a path of the graph. A minimizer
  that occurs once in the corpus has no repeated edge, and its run never enters the graph.
* Documents join their repeated minimizers and cut the runs out. Equal runs collapse to one path: inside a task
  at once, then where they meet. All occurrences but the first repeat throughout.
* Paths join the number of paths of their minimizer. A path that is alone does not branch and stays compact:
  none of its edges lies on another path. Paths that share a minimizer may branch; only their first occurrences
  are dissolved into edges, of which again all but the first occurrence repeat.
* Runs and edges are compared by a 128-bit digest of the words that stand at their source coordinates, and
  every claim carries its coordinates and those of the first occurrence. Claims that touch, or go on in the
  same source, glue into long spans.

The packed texts cross one shuffle, which all three joins read. A run in a third of all documents reaches the
others once per task; a minimizer in many different runs is a skewed join, which Spark splits.

Defined cases: a null text has no words. Ids may be of any type with an order; a null id is smaller than any
other. Rows that repeat both id and text are one document, and each gets its result; of rows that share the id
only, the smaller hash of id and text comes first. Texts of any length are taken whole, in parts while they are
hashed. An empty table gives an empty result; further columns are not read.
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
from airpanel.llm.suffix_dedup import _hashes, _least

#: Bytes of words hashed at a time; places within them fit 20 bits.
BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class _WordHashes:
    """Hashes of the words of a block of bytes, all at once."""

    def __init__(self):
        self.up, self.down = (_powers(b, 2 * BLOCK) for b in (_BASE, pow(_BASE, -1, 1 << 64)))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= 2 * BLOCK:  # a single word above the block
            return np.array([xxhash.xxh64_intdigest(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)], np.uint64)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=sums[1:])
        value = (sums[ends] - sums[starts]) * self.down[starts]
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return value ^ (value >> np.uint64(32))


def _blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, bytes]]:
    """(rows, bytes) of texts joined by newlines; a long text comes alone."""
    rows, size = [], 0
    for i, text in enumerate(texts):
        if rows and size + len(text) > BLOCK:
            yield np.array(rows), b"\n".join(texts[r] for r in rows)
            rows, size = [], 0
        rows.append(i)
        size += len(text) + 1
    if rows:
        yield np.array(rows), b"\n".join(texts[r] for r in rows)


def _words(data: bytes, hashes: _WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of every word; words are parted by one space or newline."""
    found, line = [], 0
    at = 0
    while at < len(data):
        # Cut behind a space, so that no word is split.
        stop = len(data) if len(data) - at <= BLOCK else data.rfind(b" ", at, at + BLOCK) + 1
        if stop <= at:
            stop = data.find(b" ", at) + 1 or len(data)
        part = np.frombuffer(data, np.uint8, stop - at, at)
        gaps = np.flatnonzero((part == 32) | (part == 10))
        starts, ends = np.append(0, gaps + 1), np.append(gaps, len(part))
        newline = np.append(part[gaps] == 10, False)
        lines = line + np.cumsum(newline) - newline
        line = int(lines[-1])
        real = ends > starts
        found.append((lines[real], hashes(part, starts[real], ends[real])))
        at = stop
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(lines: np.ndarray, words: np.ndarray, window: int, minimizer: int) -> tuple[np.ndarray, ...]:
    """(line, hash, place, first window, last window) of every run; places count from a line's first word.

    ``place`` is where the minimizer of the run's windows stands.
    """
    if len(words) < window:
        return (np.zeros(0, np.int64),) * 5
    parts = []
    step = 1 << 19
    for at in range(0, len(words) - window + 1, step):  # places fit 20 bits; the windows of a part begin in it
        part, of = words[at:at + step + window - 1], lines[at:at + step + window - 1]
        hashed = _hashes(part, minimizer)
        keys = (hashed & ~np.uint64(0xFFFFF)) | np.arange(len(hashed), dtype=np.uint64)
        place = (_least(keys, window - minimizer + 1) & np.uint64(0xFFFFF)).astype(np.int64)
        n = len(place)
        inside = of[:n] == of[window - 1:]
        new = np.ones(n, bool)
        new[1:] = (place[1:] != place[:-1]) | (of[1:n] != of[:n - 1])
        first = np.flatnonzero(new & inside)
        # A run ends where the next begins, or before the first window that leaves its line.
        stops = np.append(np.flatnonzero(new | ~inside), n)
        last = stops[np.searchsorted(stops, first, side="right")] - 1
        parts.append((of[first], hashed[place[first]].view(np.int64), at + place[first], at + first, at + last))
    line, hashed, place, first, last = (np.concatenate(c) for c in zip(*parts, strict=True))
    begin = np.searchsorted(lines, line)
    return line, hashed, place - begin, first - begin, last - begin


def _minimizer_rows(window: int, minimizer: int):
    """Runs as (v, doc, at): ``at`` packs the minimizer's place, its distances to the first and last window, a flag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in slices(batches, 1000):
            docs, found = batch["doc"].to_numpy(), []
            for rows, data in _blocks([normalised(t) for t in batch["text"].to_pylist()]):
                line, *rest = runs_of(*_words(data, hashes), window, minimizer)
                found.append((docs[rows[line]], *rest))
            doc, v, place, first, last = (np.concatenate(c) for c in zip(*found, strict=True))
            if len(doc):
                yield flagged(v, doc, place << 14 | (place - first) << 7 | (place - last))

    return run


def normalised(text: bytes) -> bytes:
    """The words of a text, one space between them."""
    return b" ".join(text.split())


def _bounds(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end, in bytes."""
    gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    return np.append(0, gaps + 1), np.append(gaps, len(text))


def _cut_runs(window: int, id_type: pa.DataType, sources: bool):
    """From documents with their repeated minimizers to runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent(id_type, sources)
        for found in marked(batches):
            if found is None:
                yield from sent.flush()
                continue
            doc_id, doc, text, marks = found
            starts, ends = (x.tolist() for x in _bounds(text))
            for at, v in marks:
                at >>= 2
                place = at >> 14
                first, last = place - (at >> 7 & 127), place - (at & 127)
                if first < 0 or last + window > len(starts):
                    continue  # a run of another document with the same hash
                sent.add(text[starts[first]:ends[last + window - 1]], doc_id, doc, first, last + window, v)

    return run


def _dissolve(window: int, id_type: pa.DataType, sources: bool):
    """From documents with their branching paths (start, end) to edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = Sent(id_type, sources)
        for found in marked(batches):
            if found is None:
                yield from sent.flush()
                continue
            doc_id, doc, text, marks = found
            starts, ends = (x.tolist() for x in _bounds(text))
            for start, end in marks:
                if end <= len(starts):
                    for at in range(start, end - window + 1):
                        sent.add(text[starts[at]:ends[at + window - 1]], doc_id, doc, at, at + window, 0)

    return run


def _found(corpus: Corpus, window: int, minimizer: int, sources: bool) -> DataFrame:
    """Claims of all repeated runs and edges; without ``sources`` those that a task knows merge whatever their source."""
    rows = corpus.docs.select("doc", "text").filter(F.octet_length("text") >= 2 * window - 1)
    rows = rows.mapInArrow(_minimizer_rows(window, minimizer), "v long, doc long, at long")
    held = corpus.with_marks(only_repeated(rows), F.struct("at", "v"))
    paths = corpus.pieces(held, _cut_runs(window, corpus.id_type, sources))
    distinct = paths.filter("stays").select("v", "doc", "start", "end")
    several = distinct.groupBy("v").agg(F.count("*").alias("paths")).filter("paths > 1").select("v")
    branching = corpus.with_marks(distinct.join(several, "v"), F.struct("start", "end"))
    edges = corpus.pieces(branching, _dissolve(window, corpus.id_type, sources))
    return claims(paths).unionAll(claims(edges))


def _glued(found: list[tuple]) -> list[tuple]:
    """Claims (start, end, from_id, from_start) as maximal spans that go on in one source."""
    along: dict[tuple, list[tuple[int, int]]] = {}
    for start, end, from_id, from_start in found:
        along.setdefault((from_id, from_start - start), []).append((start, end))
    spans = [(a, b, source, a + shift) for (source, shift), ranges in along.items() for a, b in union_of(ranges)]
    return sorted(spans, key=lambda s: s[:2])


_CLAIM = ("id", "start", "end", "from_id", "from_start")


def _check(window: int, minimizer: int) -> None:
    if not 0 < minimizer < window <= 128:
        raise ValueError("the minimizer must be shorter than the window, and the window at most 128 words")


def repeated_spans(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, minimizer: int = 8,
) -> DataFrame:
    """(id, ``start``, ``end``, ``source_id``, ``source_start``) of long repeated spans, in words, with the place they repeat.

    Every span equals the words at its source; spans may overlap where the source changes.
    """
    _check(window, minimizer)
    corpus = Corpus(df, id_col, text_col, normalised)
    joined = corpus.with_marks(_found(corpus, window, minimizer, True), F.struct(*_CLAIM))
    kinds = [corpus.id_type, pa.int64(), pa.int64(), corpus.id_type, pa.int64()]
    schema = f"id {corpus.id_name}, start long, end long, source_id {corpus.id_name}, source_start long"
    names = ["id", "start", "end", "source_id", "source_start"]
    return each(joined, schema, lambda i, _, found: [(i, *s) for s in _glued(found)], names, kinds).withColumnRenamed("id", id_col)


def remove_repeated_passages(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, minimizer: int = 8, with_text: bool = False,
) -> DataFrame:
    """One row per row of ``df``: id, ``n_words``, ``n_removed``, ``kept_sha256``; with the ``kept`` words if asked."""
    _check(window, minimizer)
    corpus = Corpus(df, id_col, text_col, normalised)
    joined = corpus.with_marks(_found(corpus, window, minimizer, False), F.struct("id", "start", "end"), "left")

    def row(doc_id, text: bytes, ranges: list[tuple]) -> list[tuple]:
        if not text:
            kept, n, gone = text, 0, 0
        elif not ranges:
            kept, n, gone = text, text.count(b" ") + 1, 0
        else:
            starts, ends = _bounds(text)
            n, at, gone, parts = len(starts), 0, 0, []
            for start, end in [*union_of(ranges), (n, n)]:
                if start > at:
                    parts.append(text[starts[at]:ends[start - 1]])
                gone += end - start
                at = end
            kept = b" ".join(parts)
        return [(doc_id, n, gone, hashlib.sha256(kept).hexdigest(), *([kept.decode()] if with_text else []))]

    names = ["id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text
    kinds = [corpus.id_type, pa.int64(), pa.int64(), pa.string()] + [pa.string()] * with_text
    schema = f"id {corpus.id_name}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return each(joined, schema, row, names, kinds).withColumnRenamed("id", id_col)
