import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from airpanel.llm.packing import Bins, ChunkEncoder, Knapsack, pack, pack_documents, packed, plan, token_pieces

P = pytest.importorskip("public_tokenizers")


def test_knapsack_against_all_fillings():
    rnd = random.Random(1)
    for _ in range(20):
        sizes = np.array(sorted(rnd.sample(range(1, 15), 4)))
        prices = np.array([rnd.random() for _ in sizes])
        program = Knapsack(sizes, prices, 30)
        best = [0.0] * 31
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(best[c - s] + p for s, p in zip(sizes.tolist(), prices) if s <= c)])
        assert np.allclose(program.best, best)
        items = program.items(30)
        assert sizes[items].sum() <= 30 and prices[items].sum() == pytest.approx(best[30])


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_every_piece_once(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 64, 256])
    lengths = rnd.sample(range(1, capacity + 1), rnd.randint(1, min(capacity, 60)))
    histogram = {n: rnd.choice([1, 2, 7, 1000, 10**9]) for n in lengths}
    groups, bound = packed(histogram, capacity)
    held = Counter()
    for many, items in groups:
        assert many > 0 and sum(n * k for n, k in items) <= capacity
        for n, k in items:
            held[n] += many * k
    assert held == histogram
    used = sum(many for many, _ in groups)
    plain = Bins(capacity)
    for n in sorted(histogram, reverse=True):
        plain.place(n, histogram[n])
    assert bound <= used + 1e-6 and used <= 1.0001 * sum(many for many, _ in plain.all()) + 30
    table = plan(groups)
    for n in histogram:  # the ranges of a length follow each other without a gap
        mine = table["length"] == n
        assert table["rank"][mine][0] == 0 and (np.diff(table["rank"][mine]) > 0).all()


def test_combinations_that_best_fit_alone_does_not_find():
    groups, bound = packed({4: 10**6, 3: 10**6}, 10)  # best fit alone: 833,334
    assert sum(m for m, _ in groups) <= 750_100 and bound <= 750_000
    groups, bound = packed({50: 100, 33: 300, 17: 100}, 100)
    assert sum(m for m, _ in groups) <= 170 and bound >= 165
    assert packed({}, 100) == ([], 0.0)


def test_bulk_best_fit_equals_one_by_one():
    rnd = random.Random(2)
    counts = {n: rnd.randint(1, 30) for n in rnd.sample(range(1, 100), 30)}
    bins, free = Bins(100), []
    for n in sorted(counts, reverse=True):
        bins.place(n, counts[n])
        for _ in range(counts[n]):
            tight = min((f for f in free if f >= n), default=None)
            if tight is not None:
                free.remove(tight)
            free.append((tight if tight is not None else 100) - n)
    assert sorted(f for f, g in bins.groups.items() for many, _ in g for _ in range(many)) == sorted(free)


def check(rows, got, ids_of, capacity):
    want = []
    for i, t in rows:
        ids = [*ids_of(t or ""), 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((str(i), piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(w[3] for w in want)


@pytest.mark.parametrize("capacity", [4096, 64])
def test_documents(documents, prose, capacity):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = [(None, "a"), (1, "Same row"), (1, "Same row"), (2, None), (3, ""), (4, "word " * 9000)]
    rows += [(10 + r.doc_id, r.text) for r in prose.collect()] + [(5000 + i, "a hot length") for i in range(300)]
    got = pack_documents(documents(rows), path, capacity=capacity).collect()
    used, tokens = check(rows, got, lambda t: library.encode(t, add_special_tokens=False).ids, capacity)
    assert used <= 1.03 * tokens / capacity + 2
    assert pack_documents(documents(rows).limit(0), path).count() == 0


def test_pieces_with_ids_and_bad_lengths(documents, spark):
    path = P.path("word_bpe_49k.json")
    rows = token_pieces(documents([(7, "one two three")]), path, capacity=3, with_ids=True).orderBy("piece").collect()
    assert [r.length for r in rows] == [3, 1] and rows[1].ids == [1] and all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 0, 0, 9, 0)], "id long, piece int, start long, length long, ids_crc32 long"), 8)


def test_marks_after_a_word_are_asked_once(monkeypatch):
    """The whole library is slow on short texts: a word with a run of marks is a word and a run met before."""
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    mine, library, asked = ChunkEncoder(path), Tokenizer.from_file(path), []
    ask = mine._library
    monkeypatch.setattr(mine, "_library", lambda text: asked.append(text) or ask(text))
    marks = ["***", "###", "&&&", ",%%%", "'", "_", "^^", "<|", "|>", "\"]", "~`", "\\\\"]
    texts = [f"{word}{mark}  Next\n\n{word} {mark}" for word in ["Tion", "élève", "ÑÖ", "x"] for mark in marks]
    texts += ["it's we'll", "a***b", "", " ", "\n ", "end<|endoftext|>***", "a'", "a's'", "ǆ***", "e\u0301***", "a\t***"]
    for text in texts:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert sorted(t for t in asked if t in marks) == sorted(marks)
    assert not [t for t in asked if t.startswith(("Tion", "élève", "ÑÖ"))]
