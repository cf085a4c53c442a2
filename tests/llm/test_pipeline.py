"""The pipeline and the registered queries."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
import corpus_pipeline
from airpanel.llm.queries import ORACLES, QUERIES
from airpanel.llm.secrets import scan_secrets

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and {*QUERIES, "pipeline"} <= set(entry.queries())


def test_queries_match_their_sql(spark):
    assert check.compare(spark, SF, sorted(ORACLES)) == []


def test_stages_by_hand(spark):
    """Each stage against plain Python on the rows that the stage before kept."""
    from llm.test_simhash import by_hand, classes, near

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "simhash near-dedup", "secret scan", "packing"]
    rows = docs.collect()

    calm = stages["toxicity"](spark, docs, SF)
    assert calm.columns == docs.columns
    kept = calm.collect()
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").collect()}
    gone = {r.doc_id for r in rows} - {r.doc_id for r in kept}
    assert len(toxic & gone) >= 0.8 * len(toxic) and set(kept) <= set(rows)

    single = stages["exact dedup"](spark, spark.createDataFrame(kept, docs.schema), SF).collect()
    last = {}
    for r in kept:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text)
        last[key] = max(last.get(key, r), r, key=lambda x: x.doc_id)
    assert sorted(single) == sorted(last.values())

    apart = stages["simhash near-dedup"](spark, spark.createDataFrame(single, docs.schema), SF).collect()
    values = [by_hand(r.text) for r in single]
    first = {}
    for r, c in zip(single, classes(len(single), near(values, 4))):
        first[c] = min(first.get(c, r), r, key=lambda x: x.doc_id)
    assert sorted(apart) == sorted(first.values())

    left = spark.createDataFrame(apart, docs.schema)
    clean = stages["secret scan"](spark, left, SF)
    assert clean.columns == docs.columns
    found = {r.doc_id: r for r in scan_secrets(left).collect()}
    for before, after in zip(sorted(apart), sorted(clean.collect())):
        assert before.doc_id == after.doc_id and (before.text == after.text) == (found[before.doc_id].n_live == 0)
        assert len(after.text) == after.n_chars

    places = defaultdict(int)
    for r in stages["packing"](spark, clean, SF).collect():
        places[r.sequence_id] += r.length
    assert max(places.values()) <= 4096


def test_run_gives_the_rows_of_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 100


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_an_empty_table(spark, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_pass_columns_of_any_name(spark, stage):
    """A column with a name that a stage uses itself comes out as it went in."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [
        "__key", "__id", "__row", "__score", "__spans", "__cut", "__copies", "__sha", "row", "key", "id", "sha", "stays", "digest",
        "copies", "score", "cuts", "new", "block", "first", "fp", "found", "text_sha256", "a.b", "label", "Norm",
    ]
    wide = docs.select("*", *[F.concat(F.lit(f"{n}="), F.col("doc_id")).alias(n) for n in names])
    plain = {r.doc_id: r.text for r in stage(spark, docs, SF).collect()}
    out = stage(spark, wide, SF)
    assert out.columns == wide.columns
    got = out.collect()
    assert {r.doc_id: r.text for r in got} == plain
    assert all(r[n] == f"{n}={r.doc_id}" for r in got for n in names)


def test_stages_take_nulls_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "", None, None, None), (10**9, None, "en", "s", 0), (10**9, None, "en", "s", 0),
         (10**9 + 1, "word " * 30_000, "en", None, 150_000)], docs.schema,
    )
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.unionAll(odd), SF)
        assert out.count() > 0, name
