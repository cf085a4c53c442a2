"""Toxicity scores from character n-grams, scaled by naive Bayes log-count ratios.

Each text is the set of its character n-grams, hashed. A bounded sample of labelled rows gives, per n-gram,
the log of how much more often toxic texts hold it than others; these ratios scale the features, rows are
brought to unit length, and a logistic model is fitted on them. Scoring is one pass over whole texts with the
model broadcast: one number per hash value, whose size ``bits`` fixes.

The sample is at most ``sample_rows`` labelled ids, picked by a hash of the id, and at most ``sample_chars``
characters of their texts: rows come in the order of that hash until the next one does not fit; a text longer
than ``sample_chars`` is not learned from. Hashes and lengths decide that before any text moves; one task then
fits, in an order that does not depend on how rows are dealt.

Defined cases: a null text is the empty text; a text without n-grams gets the score of the intercept. Labels
that are null, or have no document, are not used; of several labels for one id the larger counts. Without both
labels in the sample, every score is the share of toxic labels (0 without labels). Null ids hash like the
empty id. Repeated rows get the same score, and count once in the sample. Texts of any length are scored whole. An empty
table gives an empty result; further columns are not read, and pass as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.common import slices, text_of, whole_rows

ORDERS = (3, 4, 5, 7)
_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def features(text: str, bits: int = 20, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """The hashed character n-grams of a text, each once, in ascending order."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
    hashed, parts = np.zeros(len(codes), np.uint64), []
    for n in range(1, min(max(orders), len(codes)) + 1):
        size = len(codes) - n + 1
        hashed = hashed[:size] * _STEP + codes[n - 1:]
        if n in orders:
            parts.append((((hashed + np.uint64(n)) * _MIX) >> np.uint64(64 - bits)).astype(np.int32))
    if not parts:
        return np.zeros(0, np.int32)
    seen = np.concatenate(parts)
    if len(seen) * 4 > 1 << bits:
        marks = np.zeros(1 << bits, bool)
        marks[seen] = True
        return np.flatnonzero(marks).astype(np.int32)
    return np.unique(seen)


@dataclass
class Model:
    """``scale`` holds the ratios, ``weights`` the ratios times the fitted coefficients."""

    bits: int
    bias: float
    scale: np.ndarray
    weights: np.ndarray

    def score(self, text: str) -> float:
        found = features(text, self.bits)
        length = float(np.sqrt(np.square(self.scale[found], dtype=np.float64).sum()))
        margin = self.bias + (float(self.weights[found].sum(dtype=np.float64)) / length if length > 0 else 0.0)
        return float(1 / (1 + np.exp(-np.clip(margin, -30, 30)))) if np.isfinite(self.bias) else 0.0


def fitted(texts: list[str], labels: list[int], bits: int = 20, epochs: int = 3, rate: float = 0.5) -> Model:
    """Ratios with add-one counts, then logistic regression by adaptive gradient steps in a fixed random order."""
    y = np.array(labels, np.int64)
    toxic, size = int(y.sum()), 1 << bits
    zero = np.zeros(size, np.float32)
    if toxic in (0, len(y)):
        share = toxic / len(y) if len(y) else 0.0
        return Model(bits, 30.0 if share else -np.inf, zero, zero)
    rows = [features(t, bits) for t in texts]
    counts = np.ones((2, size), np.float64)
    for x, label in zip(rows, y, strict=True):
        counts[label][x] += 1
    ratio = np.log(counts[1] / (toxic + 2)) - np.log(counts[0] / (len(y) - toxic + 2))
    ratio = ratio.astype(np.float32)
    del counts
    lengths = [float(np.sqrt(np.square(ratio[x]).sum())) or 1.0 for x in rows]
    weights, squares = np.zeros(size, np.float32), np.full(size, 1e-6, np.float32)
    bias, order = float(np.log(toxic / (len(y) - toxic))), np.random.default_rng(0)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            x = rows[k]
            value = ratio[x] / lengths[k]
            margin = np.clip(float(weights[x] @ value) + bias, -30, 30)
            error = 1 / (1 + np.exp(-margin)) - y[k]
            step = (error * value).astype(np.float32)
            squares[x] += step * step
            weights[x] -= rate * step / np.sqrt(squares[x])
            bias -= 0.02 * float(error)
    return Model(bits, bias, ratio, ratio * weights)


def held_out(id_col: str, buckets: int = 4, bucket: int = 2) -> Column:
    """Rows whose label may not be learned from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % buckets == bucket


def _within(sample: DataFrame, rows: int, chars: int) -> DataFrame:
    """The first ``rows`` different rows (id, label, text) in the order of a hash of the id, up to ``chars`` characters.

    Only hashes and lengths are put in order, and copies of a row count once, so what moves is bounded by both
    limits whatever the table holds. Texts above ``chars`` are passed over.
    """
    hashed = sample.withColumn("digest", F.xxhash64("text"))
    light = hashed.select("id", "digest", F.length("text").alias("n")).filter(F.col("n") <= chars)
    first = light.groupBy("id", "digest").agg(F.max("n").alias("n")).orderBy(F.xxhash64("id"), "id", "digest").limit(rows)
    upto = F.sum("n").over(Window.orderBy(F.xxhash64("id"), "id", "digest"))  # over at most ``rows`` rows
    taken = first.withColumn("upto", upto).filter(F.col("upto") <= chars).select(F.col("id").alias("t_id"), F.col("digest").alias("t_digest"))
    met = hashed.join(F.broadcast(taken), (F.col("id") == F.col("t_id")) & (F.col("digest") == F.col("t_digest")))
    return met.groupBy("id", "digest").agg(F.max("label").alias("label"), F.max("text").alias("text")).select("id", "label", "text")


def train(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_rows: int = 4000, sample_chars: int = 40_000_000, bits: int = 20,
) -> Model:
    """A model from labelled rows outside the held-out part."""
    picked = (
        labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label")).dropna()
        .filter(~held_out("l_id")).groupBy("l_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("l_id"), "l_id").limit(sample_rows)
    )
    texts = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # At most ``sample_rows`` ids: the bound that allows a broadcast.
    sample = texts.join(F.broadcast(picked), F.col("id") == F.col("l_id")).select("id", "label", "text")
    sample = _within(sample, sample_rows, sample_chars)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(batch[c].to_pylist() for c in ("id", "label", "text")), strict=True)]
        rows.sort(key=lambda r: (str(r[0]), r[2]))
        model = fitted([r[2] for r in rows], [r[1] for r in rows], bits)
        yield pa.RecordBatch.from_pydict({
            "bias": [model.bias], "scale": [model.scale.tobytes()], "weights": [model.weights.tobytes()],
        })

    ordered = sample.repartition(1)
    row = ordered.mapInArrow(fit, "bias double, scale binary, weights binary").first()
    if row is None:
        return fitted([], [], bits)
    return Model(bits, row["bias"], np.frombuffer(row["scale"], np.float32), np.frombuffer(row["weights"], np.float32))


def scorer(spark, model: Model):
    """A column function from text to score."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.score(t or "") for t in texts], dtype="float64")

    return score


def score_toxicity(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options,
) -> DataFrame:
    """One row per row of ``df``: id, ``held_out``, ``score`` and ``predicted`` (1 from ``threshold`` on)."""
    score = scorer(df.sparkSession, train(df, labels, id_col, text_col, **options))
    rows = df.select(F.col(id_col), held_out(id_col).alias("held_out"), score(text_of(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(
    df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **options,
) -> DataFrame:
    """The rows of ``df`` below ``threshold``, with all their columns."""
    score = scorer(df.sparkSession, train(df, labels, id_col, text_col, **options))
    return whole_rows(df, score=score(text_of(text_col))).filter(F.col("score") < threshold).select("row.*")
