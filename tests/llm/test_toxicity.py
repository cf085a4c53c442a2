import zlib

import numpy as np
import pytest

from airpanel.llm.toxicity import ORDERS, features, fitted, held_out, score_toxicity, train, without_toxic

SF = "/root/testdata/sf0.1"


def test_features_are_hashed_ngrams():
    assert len(features("")) == len(features("ab")) == 0
    assert len(features("abc", orders=(3,))) == 1 and (features("ABCabc", orders=(3,)) == features("abcABC", orders=(3,))).all()
    text = "abcdef" * 3000
    assert len(features(text)) == len({(n, text[i:i + n]) for n in ORDERS for i in range(len(text) - n + 1)})
    assert (np.diff(features("the cat sat on the mat")) > 0).all()
    many = "".join(chr(0x4E00 + i % 20_000) for i in range(60_000))
    assert (features(many, bits=10) == np.unique(np.concatenate([features(many, 10, (n,)) for n in ORDERS]))).all()


def test_one_label_or_none():
    assert fitted([], []).score("x") == 0.0 and fitted(["a", "b"], [0, 0]).score("x") == 0.0
    assert fitted(["abc"], [1]).score("") > 0.99


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    scores = score_toxicity(docs, labels)
    assert scores.count() == docs.count()
    return scores.join(labels, "doc_id").join(docs, "doc_id").collect()


def test_held_out_accuracy(scored):
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [r for r in scored if r.held_out]
    found = sum(r.predicted and r.toxic for r in held)
    # Some labelled rows hold nothing but junk, and the other languages have few examples at this size.
    assert found >= 0.55 * sum(r.toxic for r in held)
    assert found >= 0.9 * sum(r.predicted for r in held)
    english = [r for r in held if any(w in r.text.lower().split() for w in ("idiot", "stupid", "scum", "moron"))]
    assert sum(r.predicted for r in english) >= 0.97 * len(english) > 20


def test_wider_orders_find_other_languages(scored):
    held = [r for r in scored if r.held_out]
    assert sum(r.predicted and r.toxic for r in held) >= 0.68 * sum(r.toxic for r in held)
    assert sum(r.predicted and r.toxic for r in held) >= 0.93 * sum(r.predicted for r in held)


def test_labels_of_held_out_rows_are_not_used(documents, spark):
    words = [(i, f"vile scum number {i}" if i % 3 == 0 else f"pleasant weather number {i}") for i in range(60)]
    df = documents(words + [(None, None), (3, "vile scum number 3")])
    labels = [(i, int(i % 3 == 0)) for i, _ in words] + [(None, 1), (7, None), (999, 1)]
    right = spark.createDataFrame(labels, "doc_id long, toxic int")
    wrong = spark.createDataFrame([(i, t if i is None or zlib.crc32(str(i).encode()) % 4 != 2 else 1 - (t or 0)) for i, t in labels], right.schema)
    a, b = (sorted((str(r.doc_id), r.score) for r in score_toxicity(df, x).collect()) for x in (right, wrong))
    assert a == b and len(a) == 62
    left = without_toxic(df, right)
    low = sorted(str(r.doc_id) for r in score_toxicity(df, right).filter("predicted = 0").collect())
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == low
    assert {str(i) for i, _ in words if i % 3} <= set(low) and not {str(i) for i, _ in words if i % 3 == 0} & set(low)
    assert score_toxicity(df.limit(0), right).count() == 0 and {r.score for r in score_toxicity(df, right.limit(0)).collect()} == {0.0}


def test_sample_is_bounded(documents, spark):
    df = documents([(i, "x" * 100) for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    assert train(df, labels, sample_chars=150).bias in (30.0, -np.inf)  # room for one text only
    assert df.filter(held_out("doc_id")).count() == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50))


def test_sample_does_not_follow_the_order_of_rows(documents, spark):
    rows = [(i, f"word {i} " * (1 + i % 7)) for i in range(200)] + [(200, "long " * 1000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(201)], "doc_id long, toxic int")
    dealt = [rows, rows[::-1], sorted(rows, key=lambda r: len(r[1]))]
    models = [train(documents(r).coalesce(1), labels, sample_chars=2000) for r in dealt]
    assert np.isfinite(models[0].bias) and models[0].weights.any()
    for other in models[1:]:
        assert other.bias == models[0].bias and (other.weights == models[0].weights).all()
