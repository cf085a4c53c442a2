import math
import random

import pytest
from pyspark.sql import functions as F

from airpanel.llm import hard_negatives as module
from airpanel.llm.hard_negatives import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id int, vec string, anchor int"


def brute(rows, positives=5, negatives=5, every=100):
    good = [
        (i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    result = []
    for a in {(i, label, tuple(v)) for i, label, v in good if i is not None and i % every == 0}:
        scored = [(sum(x * y for x, y in zip(a[2], v)), i, label) for i, label, v in good if i != a[0]]
        near = sorted((s for s in scored if s[2] == a[1]), key=order)[:positives]
        for p, pid, _ in near:
            inside = sorted((s for s in scored if s[2] != a[1] and 80 * p <= 100 * s[0] <= 100 * p), key=order)
            result += [(a[0], pid, k + 1, s[1], p, s[0]) for k, s in enumerate(inside[:negatives])]
    return sorted(result, key=str)


def found(spark, rows, every=100, **options):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in hard_negatives(df, F.col("id") % every == 0, **options).collect()), key=str)


def table(n, seed, dims=4, labels=3):
    rnd = random.Random(seed)
    half = lambda: rnd.randrange(-40, 41) / 64  # noqa: E731  exact as float, with many equal scores
    return [(i, [half() for _ in range(dims)], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("cells", [1024, 16])
def test_against_all_pairs(spark, monkeypatch, cells):
    monkeypatch.setattr(module, "CELLS", cells)
    monkeypatch.setattr(module, "ROWS", 8 * cells)
    monkeypatch.setattr(module, "ANCHORS", max(4, cells // 4))
    rows = table(400, cells)
    assert found(spark, rows, 10) == brute(rows, every=10)


def test_one_vector_in_a_third_of_all_rows(spark):
    rows = table(300, 5)
    rows = [(i, rows[0][1], label) if i % 3 == 0 else (i, v, label) for i, v, label in rows]
    assert found(spark, rows, 20, positives=3, negatives=4) == brute(rows, 3, 4, 20)


def test_nulls_odd_values_and_repeated_rows(spark):
    rows = table(60, 7)
    rows += [
        (200, None, 1), (300, [1.0, None, 0.0, 0.0], 1), (400, [float("nan"), 1.0, 0.0, 0.0], 1), (500, [0.5] * 4, None),
        (600, [float("inf"), 0.0, 0.0, 0.0], 1), (700, [float("-inf"), 0.0, 0.0, 0.0], 1), (None, [0.6, 0.6, 0.6, 0.6], 1),
        (None, [0.6, 0.6, 0.6, 0.6], 2), (800, [], 0), (900, [0.5, 0.5], 1), rows[0], rows[3], rows[3],
    ]
    assert found(spark, rows, 10) == brute(rows, every=10)
    assert found(spark, [], 10) == []
    assert found(spark, rows[1:2], 10) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [3e6, 1.0], 1), (1, [3e6, 1.0], 1), (2, [3e6, 0.5], 2), (3, [2.9e6, -1.0], 2), (100, [3e6, 0.25], 2)]
    assert found(spark, rows) == brute(rows)
    assert max(r[4] for r in found(spark, rows)) > 2 ** 53
