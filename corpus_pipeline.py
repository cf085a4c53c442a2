"""The text pipeline: each stage works on all that the stage before kept, and its decisions take effect.

Toxic documents go; of equal texts the row with the largest id stays; one document of each near-duplicate
group stays (the one of smallest id); secrets that look live are replaced by a placeholder; what is left is
packed into sequences. All stages but the last return the columns of ``documents``.

Defined cases: a null text counts as the empty text in every decision and stays null where its row stays; a null id is an
id like others, smaller than any. Rows that repeat id and text are copies, of which one stays. Texts of any length pass
whole. Further columns pass as they are, whatever their names. Empty tables pass as empty tables; without labels no
document is toxic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airpanel.llm.common import read, written
from airpanel.llm.exact_dedup import without_copies
from airpanel.llm.packing import pack_documents
from airpanel.llm.queries import tokenizer_path
from airpanel.llm.secrets import redact_secrets
from airpanel.llm.simhash import one_of_each
from airpanel.llm.toxicity import without_toxic
from airpanel.session import release_memory

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_memory(spark)
    return without_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_memory(spark)
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_memory(spark)
    return one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_memory(spark)
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_memory(spark)
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("exact dedup", exact_dedup), ("simhash near-dedup", near_dedup),
    ("secret scan", secrets), ("packing", packing),
]
#: SQL can neither train the classifier nor pack; the tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every other stage is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
