"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents are tokenised and cut into pieces; only the histogram of piece lengths, at most ``capacity`` rows,
reaches the driver. There the configuration linear program (how often to use each combination of lengths) is
solved by multiplicative weights: the price of a length falls while the combinations chosen for others carry it
too far, and a knapsack dynamic program finds the combinations of best price. One program prices, for every
length, the best combination that holds it. The fractional solution is rounded up
combination by combination, never beyond the pieces there are, and what is left goes into the tightest space
that fits, longest first, in bulk per length. The plan names, for each length, ranges of ranks and the
sequences and offsets they fill. Its size follows the number of lengths and rounds, not of documents.

Pieces of a length are ranked in salted groups whose counts are summed, so that a length with a third of all
pieces is no hot group. The plan is broadcast: ``plan`` bounds its rows.

Defined cases: a null text is the empty text, whose only token is the end mark. Null ids and repeated rows
are pieces like others. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.common import Cache, slices, written

#: Letters that every edition of Unicode knows and that normal form C leaves alone, and a run of marks, a token's own.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
#: What the pre-tokenizer of a vocabulary must be for texts to be cut at spaces, and words to be taken singly.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class ChunkEncoder(Cache):
    """Chunk of text -> its ids as little-endian bytes, asked of the ``tokenizers`` library when first met."""

    def __init__(self, path: str, cache: int = 600_000):
        super().__init__(cache)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cuttable = self._cuttable(path)
        self.word = self.library.model.tokenize
        # The library writes a byte as one character: printable Latin-1 as itself, the rest from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in shown]
        self.chars = {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.bytes_of = [i.to_bytes(4, "little") for i in range(1 + max(self.library.get_vocab().values(), default=0))]

    @staticmethod
    def _cuttable(path: str) -> bool:
        """Whether the vocabulary file lower-cases words, drops white space, and has plain special tokens."""
        spec = json.load(open(path, encoding="utf-8"))
        steps = (spec["normalizer"] or {}).get("normalizers", [])
        cutters = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        return (
            [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"} and steps[1]["content"] == " "
            and [c["type"] for c in cutters] == ["Split", "ByteLevel"] and cutters[0]["behavior"] == "Removed"
            and cutters[0]["pattern"] == {"Regex": SPLIT} and not cutters[1]["add_prefix_space"]
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["content"][:1].isalpha() for t in spec["added_tokens"])
        )

    def _library(self, text: str) -> bytes:
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        shown = word.lower()
        if not shown.isascii():
            shown = shown.encode().decode("latin-1").translate(self.chars)
        return b"".join([self.bytes_of[t.id] for t in self.word(shown)])

    def __missing__(self, chunk: str) -> bytes:
        if not chunk:
            return self.put(chunk, b"")
        ids = self.recall(chunk)
        if ids is not None:
            return ids
        plain = PLAIN.fullmatch(chunk)
        if not plain:
            ids = self._library(chunk)
        elif plain[2]:
            ids = self[plain[1]] + self[plain[2]]
        else:
            ids = self._word(chunk)
        return self.put(chunk, ids) if len(chunk) < 200 else ids

    def encode(self, text: str) -> bytes:
        if not self.cuttable:
            return self._library(text)
        # Tokens never span a space or newline if white space is dropped.
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(2)
def encoder(path: str) -> ChunkEncoder:
    """One per worker and vocabulary."""
    return ChunkEncoder(path)


def token_pieces(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece, and its ``ids`` if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, width = encoder(path).encode, np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in slices(batches, 200):
            rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
            for row, text in enumerate(batch["text"].to_pylist()):
                coded = encode(text or "") + end
                for piece, at in enumerate(range(0, len(coded), width)):
                    part = coded[at:at + width]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [
                batch["id"].take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    more = ", ids array<int>" if with_ids else ""
    return picked.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long{more}")


class Knapsack:
    """Best total price for every capacity, items repeatable."""

    def __init__(self, sizes: np.ndarray, prices: np.ndarray, capacity: int):
        self.best = np.zeros(capacity + 1)
        self.item = np.full(capacity + 1, -1)
        self.sizes = sizes
        fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
        for c in range(1, capacity + 1):
            self.best[c], self.item[c] = self.best[c - 1], -1
            k = fitting[c]
            if k:
                values = self.best[c - sizes[:k]] + prices[:k]
                i = int(values.argmax())
                if values[i] > self.best[c]:
                    self.best[c], self.item[c] = values[i], i

    def items(self, capacity: int) -> list[int]:
        """The items of a best filling."""
        found, item, c = [], self.item, capacity
        while c > 0:
            i = int(item[c])
            if i < 0:
                c -= 1
            else:
                found.append(i)
                c -= int(self.sizes[i])
        return found


def fractional(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 16, warm: int = 8, rate: float = 0.1,
) -> tuple[dict, float]:
    """(combination -> how often, lower bound on the sequences) by multiplicative weights.

    A combination is a tuple of (index of a length, how many). Each round brings every length to its share of
    the way, the longest first: a length that lags gets the best combination, at the round's prices, that
    holds it. Lengths that others have carried too far become cheaper, those that had to be served dearer.
    The first ``warm`` rounds only find prices.
    """
    volume = float(counts @ sizes) / capacity
    prices, bound = sizes / capacity, volume
    used: dict[tuple, float] = defaultdict(float)
    covered = np.zeros(len(sizes))
    longest_first = np.argsort(-sizes, kind="stable")
    for round_ in range(-warm, rounds):
        if round_ == 0:
            used.clear()
            covered[:] = 0
        target = (round_ + 1 + (warm if round_ < 0 else 0)) / rounds
        program = Knapsack(sizes, prices, capacity)
        # Prices over the best value of a sequence are feasible for the dual program.
        bound = max(bound, float(counts @ prices) / program.best[capacity])
        for i in longest_first:
            lack = target - covered[i]
            if lack <= 1e-9:
                continue
            tally: dict[int, int] = defaultdict(int)
            for k in [int(i), *program.items(capacity - int(sizes[i]))]:
                tally[k] += 1
            often = lack * counts[i] / tally[int(i)]
            for k, n in tally.items():
                covered[k] += n * often / counts[k]
            used[tuple(sorted(tally.items()))] += often
        prices = prices * np.exp(rate * np.clip((target - covered) * rounds, -4, 4))
        prices *= volume / float(counts @ prices)
    return used, bound


class Bins:
    """Groups of alike sequences by free space: (how many, items as (length, how many))."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: dict[int, list[tuple[int, tuple]]] = defaultdict(list)
        self.free: list[int] = []

    def put(self, free: int, many: int, items: tuple) -> None:
        if not self.groups[free]:
            insort(self.free, free)
        self.groups[free].append((many, items))

    def take(self, length: int) -> tuple[int, int, tuple]:
        """A group of the least space that holds ``length``, or new sequences."""
        at = bisect_left(self.free, length)
        if at == len(self.free):
            return self.capacity, 0, ()
        free = self.free[at]
        many, items = self.groups[free].pop()
        if not self.groups[free]:
            self.free.pop(at)
        return free, many, items

    def place(self, length: int, count: int) -> None:
        """``count`` pieces of one length, each into the tightest space."""
        while count:
            free, many, items = self.take(length)
            each = free // length
            if not many:
                many = -(-count // each)
            full = min(many, count // each)
            if full:
                self.put(free - each * length, full, (*items, (length, each)))
                count -= full * each
            rest = many - full
            if rest and count:
                # Fewer pieces than one more sequence can take.
                self.put(free - count * length, 1, (*items, (length, count)))
                count, rest = 0, rest - 1
            if rest and items:
                self.put(free, rest, items)

    def all(self) -> Iterator[tuple[int, tuple]]:
        for free in self.free:
            yield from self.groups[free]


def packed(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, tuple]], float]:
    """Groups (how many sequences, items as (length, how many)) that hold every piece, and the lower bound."""
    bins = Bins(capacity)
    if not histogram:
        return [], 0.0
    sizes = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(s)] for s in sizes], np.int64)
    used, bound = fractional(sizes, counts, capacity)
    left = counts.tolist()
    for items, often in sorted(used.items(), key=lambda x: (-x[1], x[0])):
        many = min([int(np.ceil(often)), *(left[i] // n for i, n in items)])
        if many > 0:
            for i, n in items:
                left[i] -= n * many
            filled = tuple((int(sizes[i]), n) for i, n in items)
            bins.put(capacity - sum(s * n for s, n in filled), many, filled)
    for i in range(len(sizes) - 1, -1, -1):
        bins.place(int(sizes[i]), left[i])
    return list(bins.all()), bound


def plan(groups: list[tuple[int, tuple]]) -> dict[str, np.ndarray]:
    """Ranges of ranks per length: from which rank, first sequence, pieces per sequence, first offset."""
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for many, items in groups:
        offset = 0
        for length, each in items:
            rows.append((length, ranks[length], sequence, each, offset))
            ranks[length] += many * each
            offset += length * each
        sequence += many
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {n: np.ascontiguousarray(table[:, i]) for i, n in enumerate(("length", "rank", "sequence", "each", "offset"))}


def pack(pieces: DataFrame, capacity: int = 4096, salt_rows: int = 200_000) -> DataFrame:
    """``pieces`` (id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    pieces = written(pieces, "pack-pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    if any(n < 1 or n > capacity for n in histogram):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    groups, _ = packed(histogram, capacity)
    shared = spark.sparkContext.broadcast(plan(groups))
    salts = max(32, -(-max(histogram.values(), default=0) // salt_rows))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("place", place).join(starts, ["length", "salt"]).withColumn("rank", F.col("first") + F.col("place") - 1)
    columns = ["id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        bounds = np.searchsorted(table["length"], np.arange(capacity + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch["length"].to_numpy()
            rank = batch["rank"].to_numpy()
            at = np.empty(len(rank), np.int64)
            for n in np.unique(length):
                mine = length == n
                a, b = bounds[n], bounds[n + 1]
                at[mine] = a + np.searchsorted(table["rank"][a:b], rank[mine], side="right") - 1
            inside = rank - table["rank"][at]
            each = table["each"][at]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in columns]
                + [pa.array(table["sequence"][at] + inside // each), pa.array(table["offset"][at] + inside % each * length)],
                names=[*columns, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*columns, "rank").mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1,
) -> DataFrame:
    """Tokenises, cuts and packs every document: one row per piece."""
    found = pack(token_pieces(df, path, id_col, text_col, capacity, end_id), capacity)
    return found.withColumnRenamed("id", id_col)
