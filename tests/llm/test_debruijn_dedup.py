import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airpanel.llm import debruijn_dedup
from airpanel.llm.debruijn_dedup import _WordHashes, _glued, _words, remove_repeated_passages, repeated_spans, runs_of


def brute(rows, window=20):
    """(n_words, n_removed, sha) per (id, text), by a dictionary of all windows."""
    seen, result = set(), {}
    for doc_id, text in sorted(set((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        words = text.encode().split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - window + 1):
            piece = tuple(words[i:i + window])
            if piece in seen:
                gone[i:i + window] = True
            seen.add(piece)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        result[doc_id, text] = (len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    return result


def corpus(seed, docs=50):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéñ") for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    prose = lambda n: [rnd.choice(words) for _ in range(n)]
    texts = [prose(rnd.randint(1, 200)) for _ in range(docs)]
    passage, line = prose(70), prose(12)
    for _ in range(8):
        other = rnd.choice(texts)
        texts += [list(other), other[: rnd.randint(10, 60)], prose(30) + passage + prose(20), prose(9) + passage[rnd.randint(0, 30):]]
        changed = list(rnd.choice(texts))
        changed.insert(rnd.randrange(len(changed) + 1), "Z")
        texts.append(changed)
    texts += [prose(20) + line + prose(20) for _ in range(25)]
    texts = [" ".join(t) for t in texts]
    texts += ["Of " * 300, "a b " * 100, "x " * 19, "y " * 20, "y " * 21, "", "\n\t ", None, "w" * 5000]
    texts += [texts[0].replace(" ", "\n \t"), "  " + texts[1], texts[2].replace(" ", " ")]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def check(rows, df, **options):
    got = [(r.doc_id, (r.n_words, r.n_removed, r.kept_sha256)) for r in remove_repeated_passages(df, **options).collect()]
    want = brute(rows, options.get("window", 20))
    assert len(got) == len(rows)
    per_id = {}
    for i, t in rows:
        per_id.setdefault(i, []).append(want[i, t or ""])
    for i, values in per_id.items():
        assert sorted(values) == sorted(v for j, v in got if j == i), (i, values)


@pytest.mark.parametrize("options", [{}, {"window": 7, "minimizer": 3}])
def test_against_all_windows(documents, options):
    rows = corpus(len(options))
    check(rows, documents(rows), **options)


def test_real_documents(documents, prose):
    rows = [(r.doc_id, r.text) for r in prose.select("doc_id", "text").collect()]
    check(rows, documents(rows))


def test_one_passage_in_a_third_of_all_documents(documents):
    rnd = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(24))
    filler = lambda: " ".join(f"f{rnd.randrange(10**6)}" for _ in range(12))
    rows = [(i, f"{filler()} {passage} {filler()}" if i % 3 == 0 else filler()) for i in range(300)]
    check(rows, documents(rows))


def test_nulls_repeated_rows_and_empty_table(documents):
    text = " ".join(random.Random(5).choice("abcdefgh") * 2 for _ in range(80))
    rows = [(1, text), (1, text), (2, text[30:200]), (None, text[60:]), (4, None), (5, ""), (2, "other " * 30)]
    check(rows, documents(rows))
    assert remove_repeated_passages(documents(rows).limit(0)).collect() == []


def test_ids_of_text_and_columns_with_clashing_names(documents):
    rows = [(i, t) for i, t in corpus(3, docs=20)]
    df = documents(rows)
    for name in ("id", "doc", "z", "marks", "v", "start", "first"):
        df = df.withColumn(name, F.lit(1))
    check(rows, df)
    texts = df.withColumn("doc_id", F.format_string("n%05d", "doc_id"))
    got = {(r.doc_id, r.n_removed, r.kept_sha256) for r in remove_repeated_passages(texts).collect()}
    want = brute(rows)
    assert got == {(f"n{i:05d}", *want[i, t or ""][1:]) for i, t in rows}


def test_spans_equal_their_source(documents):
    rows = corpus(4)
    spans = repeated_spans(documents(rows)).collect()
    removed = {}
    for s in spans:
        assert (s.source_id, s.source_start) < (s.doc_id, s.start)
        n = s.end - s.start
        words = [w.encode().split() for w in (rows_text(rows, s.doc_id), rows_text(rows, s.source_id))]
        assert words[0][s.start:s.end] == words[1][s.source_start:s.source_start + n]
        removed.setdefault(s.doc_id, set()).update(range(s.start, s.end))
    want = brute(rows)
    for i, t in rows:
        assert len(removed.get(i, ())) == want[i, t or ""][1]


def rows_text(rows, doc_id):
    return dict(rows)[doc_id] or ""


def test_kept_words(documents):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (2, f"before  {text}\nafter")]
    kept = {r.doc_id: r.kept for r in remove_repeated_passages(documents(rows), with_text=True).collect()}
    assert kept == {1: text, 2: "before after"}


def test_parts_of_a_long_text(monkeypatch):
    rnd = random.Random(2)
    lines = [" ".join(rnd.choice(["aa", "b", "c" * 40]) for _ in range(n)) for n in (0, 500, 3, 25)]
    data = "\n".join(lines).encode()
    whole = _words(data, _WordHashes())
    monkeypatch.setattr(debruijn_dedup, "BLOCK", 64)
    parts = _words(data, _WordHashes())
    assert all((a == b).all() for a, b in zip(whole, parts))
    assert [int((whole[0] == i).sum()) for i in range(4)] == [0, 500, 3, 25]
    line, _, place, first, last = runs_of(*whole, 20, 8)
    windows = sorted((i, w) for i, a, b in zip(line, first, last) for w in range(a, b + 1))
    assert windows == [(1, w) for w in range(481)] + [(3, w) for w in range(6)]
    assert ((first <= place) & (last <= place) & (place <= first + 12)).all()
    long_word = _words(b"a " + b"x" * 1000 + b" a", _WordHashes())
    assert long_word[1][0] == long_word[1][2] != long_word[1][1]


def test_glued():
    assert _glued([(0, 20, 1, 5), (4, 30, 1, 9), (30, 50, 2, 0), (31, 52, 2, 1)]) == [(0, 30, 1, 5), (30, 52, 2, 0)]
