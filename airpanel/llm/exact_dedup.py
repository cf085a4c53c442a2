"""Exact duplicates through an extendible-hash index on shared files.

The key of a text is the 64-bit hash of its normalised form (A-Z lower-cased). A directory over the leading
key bits names the bucket of every key: buckets that hold more keys than ``capacity`` are split, and the
directory doubles when a split needs one more bit. A bucket is a range of keys with one owner. Texts go to the
owners of their keys, where they stand sorted by key and text; the owner compares the bytes of neighbours with one
key, and where they differ a new entry begins, linked along the key's chain. An entry (bucket, key, chain, SHA-256
of the text, the row that stays, the size of the group) holds no text; the index is written sorted by key, and
rows look up their entry by bucket, key and digest.

Before they are sent, copies collapse inside their task and then among every ``SALTS``-th task, so that a text with a
third of all rows reaches its owner ``SALTS`` times at most.

Only DataFrame operations run; the directory, at most ``2 ** max_depth`` slots, is all that reaches the driver.

Defined cases: a null text is the empty text, so null and empty texts are copies of each other. Of equal
texts the row with the largest id stays; a null id is smaller than any other. Of rows that repeat both id and
text, one stays. Texts of any length are hashed and compared whole. An empty table gives an empty result; further
columns are neither read nor compared, and pass as they are, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.common import lower_az, text_of, whole_rows, written


#: Copies of a text that its owner may meet.
SALTS = 16


class Directory:
    """Slots over the leading key bits; each names a bucket of its own local depth."""

    def __init__(self):
        self.depth = 0
        self.slots = np.zeros(1, np.int64)
        self.local = [0]

    def double(self) -> None:
        self.slots = np.repeat(self.slots, 2)
        self.depth += 1

    def split(self, bucket: int) -> int:
        """Moves the upper half of a bucket's keys to a new bucket, and returns that."""
        if self.local[bucket] == self.depth:
            self.double()
        mine = np.flatnonzero(self.slots == bucket)
        new = len(self.local)
        self.slots[mine[len(mine) // 2:]] = new
        self.local[bucket] += 1
        self.local.append(self.local[bucket])
        return new

    @classmethod
    def built(cls, keys_by_prefix: np.ndarray, capacity: int) -> Directory:
        """Splits until no bucket holds more than ``capacity`` keys, or the prefixes tell no more apart."""
        directory, most = cls(), int(np.log2(len(keys_by_prefix)))
        todo = [0]
        while todo:
            bucket = todo.pop()
            width = len(keys_by_prefix) >> directory.depth
            held = keys_by_prefix.reshape(-1, width).sum(axis=1)[directory.slots == bucket].sum()
            if held > capacity and directory.local[bucket] < most:
                todo += [bucket, directory.split(bucket)]
        return directory


def key_of(text: Column) -> Column:
    return F.xxhash64(text)


def _slot(bits: int) -> Column:
    """The leading ``bits`` of the key as a number from 0."""
    return F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")


def _directory(keys: DataFrame, capacity: int, max_depth: int) -> Directory:
    """From the number of distinct keys under each prefix; the bits follow the number of keys."""
    total = keys.count()
    bits = min(max_depth, max(1, int(np.ceil(np.log2(max(2, total / capacity)))) + 4))
    counts = np.zeros(1 << bits, np.int64)
    for row in keys.groupBy(_slot(bits).alias("slot")).count().collect():  # at most 2 ** max_depth rows
        counts[row["slot"]] = row["count"]
    return Directory.built(counts, max(capacity, total >> (max_depth - 1)))


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1000, max_depth: int = 18,
) -> DataFrame:
    """One row per row of ``df``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``chain``.

    ``chain`` is the place of the text among those that share its key (0 unless keys collide). ``copies``
    counts the rows with this id and text.
    """
    spark = df.sparkSession
    text = df.select(F.col(id_col).alias("id"), lower_az(text_of(text_col)).alias("norm"))
    keyed = text.withColumn("key", key_of(F.col("norm")))
    rows = written(
        keyed.select("id", "key", F.unhex(F.sha2("norm", 256)).alias("sha"), F.monotonically_increasing_id().alias("row")),
        "dedup-rows",
    )
    directory = _directory(rows.select("key").distinct(), capacity, max_depth)
    slots = spark.createDataFrame(
        [(i, int(b)) for i, b in enumerate(directory.slots)], "slot long, bucket long",
    )

    def placed(frame: DataFrame) -> DataFrame:
        # At most 2 ** max_depth slots of 16 bytes: the bound that allows a broadcast.
        return frame.withColumn("slot", _slot(directory.depth)).join(F.broadcast(slots), "slot").drop("slot")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = keyed.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    held = salted.groupBy("key", "norm", "salt").agg(F.max("id").alias("most"), F.count("*").alias("n"))
    # To the owners, who compare neighbours along each key's chain.
    owned = placed(held.withColumn("sha", F.unhex(F.sha2("norm", 256)))).repartition(parts, "bucket")
    chain = Window.partitionBy("bucket", "key").orderBy("norm")
    before = F.lag("norm").over(chain)
    owned = owned.withColumn("new", F.when(before.isNull() | (before != F.col("norm")), 1).otherwise(0))
    owned = owned.withColumn("chain", F.sum("new").over(chain.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    entries = owned.groupBy("bucket", "key", "chain").agg(
        F.first("sha").alias("sha"), F.max("most").alias("keep_id"), F.sum("n").alias("group_size"),
    )
    index = written(entries.sortWithinPartitions("bucket", "key", "chain"), "dedup-index")
    repeats = (
        rows.groupBy("id", "key", "sha").agg(F.min("row").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
        .select(F.col("id").alias("r_id"), F.col("key").alias("r_key"), F.col("sha").alias("r_sha"), "first", "copies")
    )
    # The rows meet the index alone first: one index row each, so Spark can split a key with many rows.
    found = placed(rows).join(index, ["bucket", "key", "sha"])
    same = F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")) & (F.col("sha") == F.col("r_sha"))
    return found.join(repeats, same, "left").select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.coalesce("first", "row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), F.col("chain").cast("int").alias("chain"), F.coalesce("copies", F.lit(1)).alias("copies"),
    )


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    stay = exact_duplicates(df, id_col, text_col, **options).filter("kept")
    stay = stay.select(F.col(id_col).alias("stays"), F.unhex("text_sha256").alias("digest"), "copies")
    rows = whole_rows(df, id=F.col(id_col), sha=F.unhex(F.sha2(lower_az(text_of(text_col)), 256)))
    met = rows.join(stay, F.col("id").eqNullSafe(F.col("stays")) & (F.col("sha") == F.col("digest")))
    several = met.filter("copies > 1").dropDuplicates(["id", "sha"])
    return met.filter("copies = 1").unionAll(several).select("row.*")
