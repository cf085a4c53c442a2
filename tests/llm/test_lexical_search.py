import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from airpanel.llm import lexical_search
from airpanel.llm.lexical_search import Index, Query, rank_documents, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
AZ = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(AZ))


def brute(rows, items, top=20):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows if terms(t)]
    n_docs, total = len(docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    result = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 75 + (25 * n * n_docs) // total
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        result += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top])]
    return sorted(result, key=str)


def found(spark, documents, rows, items, **options):
    asked = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id long, text string, query int")
    return sorted((tuple(r) for r in rank_documents(documents(rows), asked, **options).collect()), key=str)


def corpus(n, seed):
    rnd = random.Random(seed)
    vocabulary = [w + s for w in ("Alpha", "beta", "γάμμα", "Ünï", "x9", "日本", "no") for s in "abcdefghij"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda k: "".join(w + rnd.choice([" ", "\n", ", ", "-", "\x7f"]) for w in rnd.choices(vocabulary, weights, k=k))
    rows = [(i, text(rnd.randint(0, 120))) for i in range(n)]
    rows += [(n + i, rows[7][1]) for i in range(n // 3)]
    return rows, [(i, text(rnd.randint(1, 30))) for i in range(12)]


@pytest.mark.parametrize("block", [1 << 14, 16])
def test_against_all_documents(spark, documents, monkeypatch, block):
    monkeypatch.setattr(lexical_search, "BLOCK", block)
    rows, items = corpus(200, block)
    assert found(spark, documents, rows, items) == brute(rows, items)


def test_blocks_of_queries(spark, documents):
    rows, items = corpus(80, 3)
    assert found(spark, documents, rows, items, max_terms=10, top=3) == brute(rows, items, 3)


def test_nulls_repeated_rows_and_empty_tables(spark, documents):
    rows, items = corpus(40, 4)
    rows += [(None, "alphaa betab"), (500, None), (501, ""), (502, " .,; "), (503, "zzz"), (None, "alphaa betab"), rows[5], rows[5]]
    items += [(None, "betab"), (98, None), (99, "!!"), (100, "unknownterm"), items[0], (101, "zzz ZZZ")]
    assert found(spark, documents, rows, items) == brute(rows, items)
    assert found(spark, documents, rows[:0], items) == []
    assert found(spark, documents, rows, items[:0]) == []
    clash = documents(rows).withColumn("id", F.lit("q")).withColumn("n", F.lit(1)).withColumn("terms", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((tuple(r) for r in rank_documents(clash, asked).collect()), key=str) == brute(rows, items)


def test_terms_of_long_texts(monkeypatch):
    text = ("Ab-c\x00dÉ9 " * 50 + "q" * 300 + " z") * 3
    whole = [t.decode() for part in terms_of(text.encode()) for t in part]
    monkeypatch.setattr(lexical_search, "PART", 64)
    assert [t.decode() for part in terms_of(text.encode()) for t in part] == whole == terms(text)


def test_bounds_and_pruning_keep_the_best():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        n_docs, n_terms = 200, 12
        held = rnd.random((n_terms, n_docs)) < rnd.random((n_terms, 1)) * 0.6
        held[1] &= ~held[0]  # a pair that never meets
        impacts = rnd.integers(0, 50, (n_terms, n_docs)) * rnd.integers(1, 20, (n_terms, 1))
        t, d = np.nonzero(held)
        query = Query({i: int(rnd.integers(1, 3)) for i in range(n_terms)}, np.arange(n_terms))
        index = Index(t, d, impacts[t, d], n_docs, query.pairs)
        times = dict(zip(query.terms, query.times))
        scores = sum(times[i] * np.where(held[i], impacts[i], 0) for i in range(n_terms))
        for a, b in query.pairs:
            if a in index.lists and b in index.lists:
                pair = times[a] * np.where(held[a], impacts[a], 0) + times[b] * np.where(held[b], impacts[b], 0)
                assert pair.max() <= index.bound(a, b, times[a], times[b]) <= times[a] * index.most[a] + times[b] * index.most[b]
        for threshold in (1, int(np.sort(scores)[-20]), int(scores.max()), int(scores.max()) + 1):
            docs, values = query.search(index, max(1, threshold))
            want = np.flatnonzero(scores >= max(1, threshold))
            assert set(want) == set(docs[values >= max(1, threshold)]) and (values == scores[docs]).all()
