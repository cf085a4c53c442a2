"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.common import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node that can be reached.

    Each round links all larger neighbours of a node to its smallest neighbour, then all smaller ones. The
    rounds follow the logarithm of the longest path; each is written, so lineage stays short. Minima are
    aggregated before they are shuffled, and a node with many links is a skewed join, which Spark splits.
    """
    links = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name,
    )
    before = _state(links)
    while True:
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        links = written(
            small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionAll(least.select("a", F.col("m").alias("b"))).distinct(), name,
        )
        after = _state(links)
        if after == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = after
