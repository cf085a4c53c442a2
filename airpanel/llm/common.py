"""What several text operators need: whole rows, the A-Z lower case, shared tables, chunk caches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airpanel.session import materialize, release_memory

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six characters that separate words, as a character class for Java, RE2 and Python.
SPACES = r"\x20\x09-\x0D"
#: Rows turned into Python objects at a time.
SLICE = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors.

    Operators plan many queries in a row; after each, the driver gives back the memory that planning left.
    """
    table = materialize(df, f"llm-{name}")
    release_memory(df.sparkSession)
    return table


def text_of(name: str = "text") -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_az(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else.

    ``lower`` treats ASCII bytes fast and alike; only other texts go character by character.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def quoted(name: str) -> str:
    """A column name that is read as one, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def whole_rows(df: DataFrame, **more: Column) -> DataFrame:
    """``df`` as one column ``row`` beside ``more``, so that no name of its columns meets another."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"), *[c.alias(name) for name, c in more.items()])


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, so that Python objects of few texts exist at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class Cache(dict):
    """A dictionary of what is in use: at ``limit`` keys it starts anew, and takes back what is asked for again."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.past = limit, {}

    def recall(self, key):
        """The value of a key that is not among the present ones, or None."""
        value = self.past.get(key)
        return value if value is None else self.put(key, value)

    def put(self, key, value):
        if len(self) >= self.limit:
            self.past = dict(self)
            self.clear()
        self[key] = value
        return value


def alternatives(words) -> re.Pattern:
    """A pattern that finds any of ``words``, the longest first."""
    return re.compile("|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)))
