import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans int, key int, norm string"


@pytest.fixture(scope="session")
def documents(spark):
    """Texts (or (id, text[, source]) rows) as a documents table, with columns whose names could clash."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, *source = row if isinstance(row, tuple) else (i, row)
            full.append((doc_id, text, "en", source[0] if source else "src0", len(text or ""), 7, 7, "x"))
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def prose(spark):
    """The documents of the smallest test tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("text", F.col("text"))
