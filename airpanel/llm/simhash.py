"""Near duplicates by SimHash: fingerprints, links within a bit distance, components.

Fingerprints that differ in at most ``max_bits`` bits agree on all but ``max_bits`` of any number of bit
blocks. Each fingerprint is therefore filed under every choice of blocks that may agree; the number of blocks
follows the number of distinct fingerprints, so that buckets stay small, and every choice is exact. Inside a
bucket the fingerprints stand as bit planes, one integer per bit position. A fingerprint is compared with all
others at once: each plane is a vector of differing bits, added to bitwise carry-save counters, and the scan
of a block ends when every counter is beyond the radius. A bucket yields a spanning forest of its links, not
all pairs. Buckets above ``block`` fingerprints are cut into chunks, and each pair of chunks is a block.

Equal texts share a fingerprint and are collapsed before anything is filed.

Defined cases: a null text is the empty text; a text without words has fingerprint zero and links like any
other; a text of fewer words than a shingle is one shingle. Texts of any length are taken whole, their shingles
counted in parts. Null ids get a component like other rows but never name one; a component of null ids only has a
null id. Rows that repeat an id, or id and text, are repeated in the result; where one row stays for a component, it is
that of the smallest id, of rows with that id the one of the smallest hash of id and text, and one of equal rows. An
empty table gives an empty result; further columns are not read, and pass as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.common import slices, text_of, whole_rows, written
from airpanel.llm.components import components

BITS = 64
#: Fingerprints that share a bucket by chance, about; more of them means more blocks.
BUCKET = 256
#: Tasks that a component is dealt over when its fingerprints get its name.
SALTS = 16


def fingerprint(text: str, words: int = 4, seed: int = 42) -> int:
    """The bits set in over half of the shingles' XXH64 values, as an unsigned integer."""
    # On bytes, lower() changes A-Z only, and split() knows just the six ASCII spaces.
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    if len(parts) > words:
        pairs = zip(starts[: 1 - words].tolist() if words > 1 else starts.tolist(), ends[words - 1:].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in pairs), np.uint64, len(parts) - words + 1)
    else:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[i:i + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """(id, key, fp): ``fp`` is the fingerprint as a signed long, ``key`` a hash of id and text."""
    text = text_of(text_col)
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(t, words, seed) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["key"], pa.array(found.view(np.int64), pa.int64())], names=["id", "key", "fp"],
            )

    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, key long, fp long")


class Planes:
    """A block of fingerprints as bit planes."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.all = (1 << self.n) - 1
        bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        packed = np.packbits(bits, axis=0, bitorder="little")
        #: Of planes where not all agree: the shift to a value's bit, the plane, and its complement.
        self.planes = []
        for b in range(BITS):
            plane = int.from_bytes(packed[:, b].tobytes(), "little")
            if plane and plane != self.all:
                self.planes.append((BITS - 1 - b, plane, plane ^ self.all))

    def near(self, value: int, among: int, radius: int) -> int:
        """The members of ``among`` (a bit per fingerprint) within ``radius`` of ``value``."""
        digits = radius.bit_length()
        counter = [0] * (digits + 1)
        over = 0
        planes = self.planes
        for i in range(0, len(planes), 8):
            for shift, plane, complement in planes[i:i + 8]:
                carry = complement if value >> shift & 1 else plane
                for d in range(digits):
                    carry, counter[d] = counter[d] & carry, counter[d] ^ carry
                    if not carry:
                        break
                else:
                    over |= carry  # reached a power of two above the radius
            beyond, equal = over, self.all
            for d in range(digits - 1, -1, -1):
                if radius >> d & 1:
                    equal &= counter[d]
                else:
                    beyond |= equal & counter[d]
                    equal &= ~counter[d]
            over |= beyond
            among &= ~over
            if not among:
                return 0
        return among


def spanning_links(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (places in ``values``) that connect whatever links within ``radius`` connect."""
    planes, ints, links = Planes(values), values.tolist(), []
    left = planes.all
    while left:
        least = left & -left
        left ^= least
        todo = [least.bit_length() - 1]
        while todo and left:
            at = todo.pop()
            found = planes.near(ints[at], left, radius)
            left &= ~found
            while found:
                bit = found & -found
                found ^= bit
                todo.append(bit.bit_length() - 1)
                links.append((at, todo[-1]))
    return links


def masks(n: int, max_bits: int) -> list[int]:
    """Bit masks of the block choices, for ``n`` distinct fingerprints."""
    blocks = max_bits + 1
    while blocks < 16 and n >> min(62, BITS * (blocks - max_bits) // blocks) > BUCKET:
        blocks += 1
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(parts, blocks - max_bits)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def near_links(values: DataFrame, max_bits: int = 4, block: int = 4096) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp``: enough to connect all that are within ``max_bits``."""
    filed = values.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
        for i, m in enumerate(masks(values.count(), max_bits))
    ])).alias("k")).select("fp", "k.mask", "k.bits")
    sizes = filed.groupBy("mask", "bits").count().filter("count > 1")
    chunks = F.ceil(F.col("count") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("chunks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: (j != F.col("mine")) | (F.col("chunks") == 1))
    dealt = (
        filed.join(sizes.withColumn("chunks", chunks), ["mask", "bits"]).withColumn("mine", mine)
        .withColumn("other", F.explode(others))
        .select("mask", "bits", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "fp")
    )
    keys = ["mask", "bits", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _blocks(batches, keys):
            if len(group) > 1:
                links = spanning_links(group.view(np.uint64), max_bits)
                if links:
                    ends = group[np.array(links, np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    parts = values.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return dealt.repartition(int(parts), *keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def _blocks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[np.ndarray]:
    """The fingerprints of each run of equal keys, also where a run spans batches."""
    held: list[np.ndarray] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch[k].to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
        values = batch["fp"].to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        bounds = [0, *cuts.tolist(), len(values)]
        if held and (columns[:, 0] != last).any():
            yield np.concatenate(held)
            held = []
        for a, b in zip(bounds, bounds[1:-1], strict=False):
            yield np.concatenate([*held, values[a:b]]) if held else values[a:b]
            held = []
        held.append(values[bounds[-2]:])
        last = columns[:, -1]
    if held:
        yield np.concatenate(held)


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4, seed: int = 42,
) -> DataFrame:
    """One row per row of ``df``: id, ``fingerprint`` (hex), ``component_id``, and what picks one row of each.

    ``component_id`` is the smallest id of the component. ``stays`` marks the row that represents it;
    ``key`` is a hash of id and text, and ``copies`` counts the rows that share both.
    """
    rows = written(fingerprints(df, id_col, text_col, words, seed), "simhash-rows")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    values = written(rows.groupBy("fp").agg(F.min("id").alias("id"), F.min(first).alias("first")), "simhash-values")
    roots = components(near_links(values.select("fp"), max_bits), "simhash-links")
    placed = values.join(roots, F.col("fp") == F.col("node"), "left")
    linked = placed.filter("root IS NOT NULL")
    # A component of most fingerprints is named over several tasks.
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    named = linked.groupBy("root").agg(F.min("id").alias("component_id"), F.min("first").alias("first")).withColumn("salt", salts)
    linked = linked.select("fp", "root", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).alias("salt")).join(named, ["root", "salt"])
    alone = placed.filter("root IS NULL").select("fp", F.col("id").alias("component_id"), "first")
    named = linked.select("fp", "component_id", "first").unionAll(alone)
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))).alias("stays"), "key",
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that represent their component, with all their columns."""
    found = near_duplicates(df, id_col, text_col, **options).filter("stays")
    stay = found.groupBy("key").agg(F.count("*").alias("copies"))
    met = whole_rows(df, key=F.xxhash64(F.col(id_col), text_of(text_col))).join(stay, "key")
    several = met.filter("copies > 1").dropDuplicates(["key"])
    return met.filter("copies = 1").unionAll(several).select("row.*")
