import hashlib
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from airpanel.llm import exact_dedup
from airpanel.llm.exact_dedup import Directory, exact_duplicates, without_copies


def norm(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def check(rows, got):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for r in got:
        ids = by_sha[r.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert r.keep_id == best and r.group_size == len(ids) and r.copies == ids.count(r.doc_id)
        assert not r.kept or r.doc_id == best
        kept[r.text_sha256] += r.kept
    assert set(kept.values()) <= {1}


ROWS = [
    (1, "Same Text"), (5, "same tEXT"), (3, "same text"), (4, "ÉCOLE"), (6, "école"), (7, None), (8, ""), (9, " "), (None, "alone"),
    (None, "Twice"), (None, "twice"), (2, "row"), (2, "row"), (2, "other text, same id"), (10, "x" * 200_000), (11, "X" * 200_000),
]


def test_groups_keepers_and_digests(documents):
    rnd = random.Random(1)
    rows = ROWS + [(100 + i, "hot") for i in range(300)] + [(500 + i, rnd.choice("abcAB") * rnd.randint(1, 9)) for i in range(200)]
    check(rows, exact_duplicates(documents(rows), capacity=5).collect())


def test_colliding_keys_are_told_apart_by_their_bytes(documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "key_of", lambda text: F.length(text).cast("long"))
    rows = [(1, "aa"), (2, "bb"), (3, "AA"), (4, "cc"), (5, "abc")]
    got = exact_duplicates(documents(rows), capacity=1).collect()
    check(rows, got)
    assert sorted({r.chain for r in got if r.doc_id != 5}) == [0, 1, 2]


def test_rows_that_stay(documents):
    df = documents(ROWS)
    got = without_copies(df)
    assert got.columns == df.columns
    left = sorted((str(r.doc_id), norm(r.text)[:20]) for r in got.collect())
    assert left == sorted((str(i), norm(t)[:20]) for i, t in [
        (5, "same text"), (4, "ÉCOLE"), (6, "école"), (8, ""), (9, " "), (None, "alone"), (None, "twice"), (2, "row"),
        (2, "other text, same id"), (11, "x" * 20)])


def test_empty_table(documents):
    df = documents(["x"]).limit(0)
    assert exact_duplicates(df).count() == 0 and without_copies(df).count() == 0


def test_directory_splits_overfull_buckets():
    counts = np.array([9, 0, 0, 0, 1, 1, 1, 1, 2, 2, 2, 2, 0, 0, 50, 0])
    directory = Directory.built(counts, 4)
    wide = np.repeat(directory.slots, len(counts) // len(directory.slots))
    held = {b: counts[wide == b].sum() for b in range(len(directory.local))}
    assert sum(held.values()) == counts.sum() and all(n <= 4 or n in (9, 50) for n in held.values())
    for b, depth in enumerate(directory.local):
        assert (directory.slots == b).sum() == 1 << (directory.depth - depth)
    assert Directory.built(np.zeros(4, int), 1).depth == 0
