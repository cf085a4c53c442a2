import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airpanel.llm import suffix_dedup
from airpanel.llm.suffix_dedup import anchors, remove_repeats, union_of
from airpanel.llm.suffix_index import prefix_groups


def brute(rows, length=100):
    """(n_bytes, n_removed, n_spans, sha) per (id, text), by a dictionary of all windows."""
    seen, result = {}, {}
    for doc_id, text in sorted(set((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = text.encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if data[i:i + length] in seen:
                gone[i:i + length] = True
            else:
                seen[data[i:i + length]] = (doc_id, i)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        result[doc_id, text] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return result


def corpus(seed, docs=60, copies=8):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    texts = [prose(rnd.randint(1, 200)) for _ in range(docs)]
    passage, line = prose(60), prose(11)[:70]
    for _ in range(copies):
        texts += [rnd.choice(texts), rnd.choice(texts)[: rnd.randint(50, 400)], prose(30) + passage + prose(20)]
        cut = list(rnd.choice(texts))
        for _ in range(3):
            cut.insert(rnd.randrange(len(cut) + 1), "Z")
        texts.append("".join(cut))
    texts += [prose(20) + line + prose(20) for _ in range(25)]
    texts += ["Of " * 300, "a" * 350, "ab" * 200, "x" * 99, "y" * 100, "y" * 100, "y" * 101, "", "\0" * 130 + prose(30), None]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def found(df, **options):
    return [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in remove_repeats(df, **options).collect()]


def check(rows, got):
    want = brute(rows)
    assert len(got) == len(rows)
    per_id = {}
    for i, t in rows:
        per_id.setdefault(i, []).append(want[i, t or ""])
    for i, values in per_id.items():
        assert sorted(values) == sorted(v for j, v in got if j == i), (i, values)


@pytest.mark.parametrize("most", [300, 2])
def test_against_all_windows(documents, most):
    rows = corpus(most)
    check(rows, found(documents(rows), most=most))


def test_real_documents(documents, prose):
    rows = [(r.doc_id, r.text) for r in prose.select("doc_id", "text").collect()]
    check(rows, found(documents(rows)))


def test_nulls_repeated_rows_and_empty_table(documents):
    text = "".join(random.Random(5).choice("abcdefgh ") for _ in range(400))
    rows = [(1, text), (1, text), (2, text[50:300]), (None, text[100:]), (4, None), (5, "")]
    check(rows, found(documents(rows)))
    assert found(documents(rows).limit(0)) == []


def test_parts_of_a_long_document(monkeypatch):
    rnd = np.random.default_rng(2)
    data = rnd.integers(97, 101, 5000).astype(np.uint8)
    whole = anchors(data, np.zeros(1, np.int64), np.array([5000]), 100)
    for place, first, last in zip(*whole[2:]):
        assert first <= last <= 4900 and last <= place <= first + 80
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(whole[3], whole[4])])
    assert (windows == np.arange(4901)).all()
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 10)
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"text": pa.array([b"", data.tobytes(), b"short"], pa.binary())})
    parts = [np.concatenate(c) for c in zip(*suffix_dedup._segments(batch, 100))]
    assert set(parts[0]) == {1}
    assert (np.sort(np.concatenate([np.arange(a, b + 1) for a, b in zip(parts[3], parts[4])])) == np.arange(4901)).all()


def test_hashes_at_a_few_places():
    data = np.random.default_rng(3).integers(0, 256, 500).astype(np.uint8)
    places = np.array([0, 7, 7, 480])
    assert (suffix_dedup._hash_at(data, places, 20) == suffix_dedup._hashes(data, 20)[places]).all()
    assert len(suffix_dedup._hash_at(data, places[:0], 20)) == 0


def test_ids_of_text_and_columns_with_clashing_names(documents):
    rows = corpus(6, docs=20, copies=2)
    df = documents(rows)
    for name in ("id", "doc", "z", "marks", "v", "seg", "start", "n"):
        df = df.withColumn(name, F.lit(1))
    check(rows, found(df))
    texts = df.withColumn("doc_id", F.format_string("n%05d", "doc_id"))
    got = {(r.doc_id, r.n_removed, r.kept_sha256) for r in remove_repeats(texts).collect()}
    assert got == {(f"n{i:05d}", v[1], v[3]) for i, v in found(df)}


def test_a_crowded_anchor_is_dealt_anew(documents):
    rnd = random.Random(3)
    line = "one line that stands in very many of the documents here"
    filler = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = filler(60)
    rows = [(i, filler(90) + (shared if i % 9 == 0 else filler(60)) + line + (shared if i % 4 == 0 else filler(60)) + filler(90)) for i in range(120)]
    check(rows, found(documents(rows), most=5))


def test_prefix_groups_by_comparison():
    rnd = random.Random(4)
    for _ in range(30):
        strings = ["".join(rnd.choice("ab") for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(1, 12))]
        text = "\0".join(strings) + "\0"
        symbols = np.array([0 if c == "\0" else ord(c) - 96 for c in text], np.uint16)
        order, group = prefix_groups(symbols, 6)
        where = [(g, text[o:o + 6]) for o, g in zip(order, group) if "\0" not in text[o:o + 6]]
        assert len({g for g, _ in where}) == len({t for _, t in where}) == len(set(where))


def test_union_of():
    assert union_of([(5, 9), (0, 3), (3, 4), (8, 12)]) == [(0, 4), (5, 12)] and union_of([]) == []
