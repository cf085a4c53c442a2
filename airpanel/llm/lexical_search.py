"""Ranked lexical search of a query set over all documents, by MaxScore with pair bounds.

Scores are integers. A term of weight ``w`` adds ``w * (10**9 * tf div (1000 * tf + 12 * m))`` per occurrence in the
query, where ``m`` grows with the document's length; ``w`` is taken from the number of documents that hold the term.

* Queries come in blocks of at most ``max_terms`` distinct terms (one query's terms at least). A block's terms are a
  broadcast of that size; documents keep the counts of these terms and their length, and are written once.
  Statistics are counted over all documents.
* Every task indexes its documents in blocks: postings per term, the largest impact of each term, and for the term
  pairs that queries ask for the intersection of their postings with the largest joint impact.
* A query's terms are taken from the least bound upwards while the bound of all taken stays below the query's
  threshold, its ``top``-th best score so far: documents with such terms only cannot enter. Where a pair lies among
  them its joint bound replaces the sum of both: either the two meet, with at most the joint maximum, or one is
  missing. Documents of the other terms are scored, and dropped as soon as the rest cannot lift them.
* Each task yields its best ``top`` per query, and the best of these are the result.

Defined cases: a null text has no terms. Null ids come last among equal scores; rows that repeat an id are ranked as
rows of their own, and so is each row of the query table, also if it repeats. Queries without terms have no result.
Texts are taken whole, in parts of a few megabytes. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airpanel.llm.common import slices, text_of, written

#: Everything of ASCII but digits and letters parts terms; A-Z become a-z.
_TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Bytes split at a time, and documents indexed at a time.
PART, BLOCK = 1 << 22, 1 << 14


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a part at a time."""
    if len(text) <= PART:
        yield text.translate(_TERMS).split()
        return
    text = text.translate(_TERMS)
    at = 0
    while at < len(text):
        stop = len(text) if len(text) - at <= PART else text.find(b" ", at + PART)
        stop = stop if stop > 0 else len(text)
        yield text[at:stop].split()
        at = stop


def _counted(vocabulary, id_name: str):
    """Per document with terms: id, their number, and (term, count) for the terms of the vocabulary."""
    names = ["id", "n", "terms", "tfs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in slices(batches):
            rows, sizes, terms, tfs = [], [], [], []
            for i, text in enumerate(batch["text"].to_pylist()):
                n, counts = 0, Counter()
                for part in terms_of(text):
                    n += len(part)
                    counts.update(map(number.get, part))
                if n:
                    counts.pop(None, None)
                    rows.append(i)
                    sizes.append(n)
                    terms.append(list(counts))
                    tfs.append(list(counts.values()))
            columns = [batch["id"].take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run, f"id {id_name}, n long, terms array<int>, tfs array<long>"


class Index:
    """Postings of a block of documents."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int, pairs: list[tuple[int, int]]):
        order = np.argsort(terms, kind="stable")
        terms, docs, impacts = terms[order], docs[order], impacts[order]
        heads = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
        self.n_docs = n_docs
        self.lists = {
            t: (docs[a:b], impacts[a:b])
            for t, a, b in zip(terms[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(terms)], strict=True)
        }
        self.most = {t: int(x.max()) for t, (_, x) in self.lists.items()}
        #: (documents that hold both, their joint impacts' maximum) of the pairs.
        self.pairs: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
        self.scratch = np.zeros(n_docs, np.int64)
        for a, b in pairs:
            if a in self.lists and b in self.lists:
                self.pairs[a, b] = self._meet(a, b)

    def _meet(self, a: int, b: int) -> tuple[np.ndarray, int]:
        (docs, impacts), (others, more) = self.lists[a], self.lists[b]
        self.scratch[docs] = impacts + 1  # an impact may be 0
        joint = self.scratch[others]
        self.scratch[docs] = 0
        both = joint > 0
        return others[both], int((joint[both] - 1 + more[both]).max()) if both.any() else 0

    def bound(self, a: int, b: int, times_a: int, times_b: int) -> int:
        """The most that two terms add to a document together."""
        one, other = times_a * self.most[a], times_b * self.most[b]
        docs, joint = self.pairs.get((a, b)) or self.pairs[b, a]
        if not len(docs):
            return max(one, other)
        # Where both stand once more, each adds its own maximum at most.
        return max(one, other, min(one + other, joint + (times_a - 1) * self.most[a] + (times_b - 1) * self.most[b]))

    def add(self, scores: np.ndarray, term: int, times: int) -> None:
        docs, impacts = self.lists[term]
        scores[docs] += impacts if times == 1 else times * impacts


class Query:
    """Distinct terms with their number of times, paired neighbours in the order of their weight."""

    def __init__(self, counts: dict[int, int], weights: np.ndarray):
        self.terms = sorted(counts, key=lambda t: (weights[t], t))
        self.times = [counts[t] for t in self.terms]
        self.pairs = list(zip(self.terms[::2], self.terms[1::2], strict=False))

    def search(self, index: Index, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of all whose score may reach ``threshold``, which is above 0."""
        mate = dict(self.pairs) | {b: a for a, b in self.pairs}
        here = {t: n for t, n in zip(self.terms, self.times, strict=True) if t in index.lists}
        order = sorted(here, key=lambda t: (here[t] * index.most[t], t))
        # bounds[i]: the most that the first i terms add together.
        bounds, taken = [0], set()
        for t in order:
            alone, other = here[t] * index.most[t], mate.get(t)
            if other in taken:
                alone = index.bound(t, other, here[t], here[other]) - here[other] * index.most[other]
            taken.add(t)
            bounds.append(bounds[-1] + alone)
        first = 0  # terms before it cannot lift a document to the threshold by themselves
        while first < len(order) and bounds[first + 1] < threshold:
            first += 1
        if first == len(order):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        scores = np.zeros(index.n_docs, np.int64)
        for t in order[first:]:
            index.add(scores, t, here[t])
        docs = np.flatnonzero(scores + bounds[first] >= threshold)
        # A document without any essential term has score 0 here, and its bound is below the threshold.
        values = scores[docs]
        for i in range(first - 1, -1, -1):
            if not len(docs):
                break
            held, impacts = index.lists[order[i]]
            if 8 * len(docs) > len(held):
                index.scratch[held] = impacts
                values = values + here[order[i]] * index.scratch[docs]
                index.scratch[held] = 0
            else:
                at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
                values = values + np.where(held[at] == docs, here[order[i]] * impacts[at], 0)
            stay = values + bounds[i] >= threshold
            docs, values = docs[stay], values[stay]
        return docs, values


def impacts_of(weights: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term of these counts adds, in whole numbers of 64 bits."""
    m = 75 + (25 * n_docs * lengths) // n_terms
    return weights * ((1_000_000_000 * tfs) // (1000 * tfs + 12 * m))


def _searched(plan, top: int):
    """The best ``top`` documents of a task for each query of the plan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, queries, n_docs, n_terms = plan.value
        pairs = sorted({p for q in queries for p in q.pairs})
        best: list[tuple[np.ndarray, pa.Array] | None] = [None] * len(queries)
        id_type = None
        for block in _gathered(batches):
            ids, lists = block["id"], block["terms"]
            id_type = ids.type
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            docs = np.repeat(np.arange(len(sizes)), sizes)
            terms, tfs = (block[c].flatten().to_numpy(zero_copy_only=False) for c in ("terms", "tfs"))
            lengths = block["n"].to_numpy()
            index = Index(terms, docs, impacts_of(weights[terms], tfs, lengths[docs], n_docs, n_terms), len(sizes), pairs)
            for i, query in enumerate(queries):
                had = best[i]
                # Equal scores may still enter by a smaller id.
                threshold = int(had[0][-1]) if had is not None and len(had[0]) == top else 1
                found, scores = query.search(index, max(1, threshold))
                if not len(found):
                    continue
                names = ids.take(pa.array(found))
                if had is not None:
                    scores, names = np.append(had[0], scores), pa.concat_arrays([had[1], names])
                keep = pc.sort_indices(pa.table({"s": scores, "id": names}), [("s", "descending"), ("id", "ascending")], null_placement="at_end")[:top]
                best[i] = scores[keep.to_numpy()], names.take(keep)
        some = [(i, *b) for i, b in enumerate(best) if b is not None]
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.full(len(s), i, np.int32) for i, s, _ in some])), pa.array(np.concatenate([s for _, s, _ in some])), pa.concat_arrays([x for *_, x in some])],
                names=["query", "score", "id"],
            )

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _blocks(items: DataFrame, max_terms: int) -> Iterator[list[tuple]]:
    """(id, counts) of queries, in blocks of bounded vocabulary; items stream through the driver."""
    block, seen = [], set()
    for row in items.select("id", "text").toLocalIterator():
        counts = Counter(t for part in terms_of(bytes(row["text"])) for t in part)
        if block and len(seen | counts.keys()) > max_terms:
            yield block
            block, seen = [], set()
        if counts:
            block.append((row["id"], counts))
            seen |= counts.keys()
    if block:
        yield block


def rank_documents(
    documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", top: int = 20, max_terms: int = 200_000,
) -> DataFrame:
    """(item, ``rank``, document, ``score``) of the best ``top`` documents of every item, with scores above 0."""
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).alias("id"), text_of(text_col).cast("binary").alias("text"))
    asked = items.select(F.col(item_col).alias("id"), text_of(item_text_col).cast("binary").alias("text"))
    id_name, item_type = docs.schema["id"].dataType.simpleString(), asked.schema["id"].dataType
    result = spark.createDataFrame([], f"{item_col} {item_type.simpleString()}, rank int, {id_col} {id_name}, score long")
    for block in _blocks(asked, max_terms):
        number = {t: i for i, t in enumerate(sorted({t for _, counts in block for t in counts}))}
        counted, schema = _counted(spark.sparkContext.broadcast(number), id_name)
        held = written(docs.mapInArrow(counted, schema), "search-counts")
        n_docs, n_terms = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = np.zeros(len(number), np.int64)
        for row in held.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():  # at most ``max_terms``
            holding[row["t"]] = row["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in holding], np.int64)
        queries = [Query({number[t]: n for t, n in counts.items()}, weights) for _, counts in block]
        plan = spark.sparkContext.broadcast((weights, queries, int(n_docs), int(n_terms)))
        found = held.mapInArrow(_searched(plan, top), f"query int, score long, id {id_name}")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(block)], f"query int, item {item_type.simpleString()}")
        result = result.unionAll(ranked.join(names, "query").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    return result
