"""What the driver's JVM has freed goes back to the system."""

import re

import pytest

import corpus_pipeline
from airpanel.llm import common
from airpanel.session import release_memory

SF = "/root/testdata/sf0.001"
SIZE = 120 * 1024  # below what the C library maps on its own


def resident(spark) -> float:
    """MB of the driver's JVM."""
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    return int(re.search(r"Anonymous:\s+(\d+)", open(f"/proc/{pid}/smaps_rollup").read())[1]) / 1024


@pytest.fixture
def freed(spark):
    """Leaves about 110 MB freed, between blocks that stay, so that the C library keeps them."""
    memory = spark._jvm.org.apache.spark.unsafe.Platform
    blocks = []

    def free():
        for _ in range(1000):
            blocks.append(memory.allocateMemory(SIZE))
            memory.setMemory(blocks[-1], 1, SIZE)
        for i in range(len(blocks) - 1, -1, -1):
            if i % 16:
                memory.freeMemory(blocks.pop(i))

    yield free
    for block in blocks:
        memory.freeMemory(block)


def test_written_tables_give_back_freed_memory(spark, freed, monkeypatch):
    if not release_memory(spark):
        pytest.skip("this JVM has no such command")
    monkeypatch.setattr(common, "materialize", lambda df, name: df)  # a job would touch memory of its own
    rows = spark.range(10)
    freed()
    before = resident(spark)
    assert common.written(rows, "trim") is rows
    assert resident(spark) < before - 60


def test_every_stage_starts_with_memory_given_back(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(corpus_pipeline, "release_memory", lambda s: calls.append(s))
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        stage(spark, docs, SF)
        assert len(calls) == n
