import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airpanel.llm import quality_rules
from airpanel.llm.quality_rules import cleaned, judge_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit), failed


GOOD = "The{0}a quick{0}b brown{0}c fox{0}d jumps{0}e over one lazy{0}f dog{0}g and then it{0}h sleeps{0}i.\n"
TEXTS = [
    None, "", " \t\n", "a", "a b", "a b c", "a b c a b c", "a a a", "a a a a", "x y z\x0bx y z\x85 q", "é\u2003è ô\r\nê",
    "a b c d a b c d " * 40, "#*$%&|<> " * 3, "l\nl\n\nl \nm", "".join(GOOD.format(i) for i in range(9)),
    "".join(GOOD.format(i) for i in range(9)) + "Home | About | Contact\nAll rights reserved.\n",
    "".join(f"Item {i} | Link {i} | Page {i}\n" for i in range(30)), " ".join(f"w{i}" for i in range(60)), "word " * 30_000,
]


@pytest.mark.parametrize("bits", [24, 2, 56])
def test_counts_against_plain_python(documents, prose, monkeypatch, bits):
    """Few place bits send long texts to the words; few hash bits make hashes collide."""
    monkeypatch.setattr(quality_rules, "PLACE_BITS", bits)
    rows = [(i, t) for i, t in enumerate(TEXTS if bits == 24 else TEXTS[:-1])]
    rows += [(1000 + r.doc_id, r.text) for r in prose.limit(200).collect()]
    got = judge_quality(documents(rows)).collect()
    assert len(got) == len(rows)
    want = {i: base(t) for i, t in rows}
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]


def test_lines_and_documents(documents):
    good = "".join(GOOD.format(i) for i in range(9))
    rows = {1: good, 2: good + "Home | About | Contact\nAll rights reserved.\n", 3: "".join(f"Item {i} | Link {i} | Page {i}\n" for i in range(30)),
            4: good + "no end mark " * 200, 5: good.replace("\n", " "), 6: None, 7: good.replace(".\n", '."  \n')}
    got = {r.doc_id: r for r in judge_quality(documents(list(rows.items()))).collect()}
    assert [i for i, r in got.items() if r.kept] == [i for i in got if i in (1, 2, 5, 7)]
    assert got[2].bad_lines == 2 and got[3].bad_lines == 30 and not got[3].base_failed
    one = documents([(2, rows[2])]).select(cleaned(F.col("text")).alias("t")).first()
    assert one.t == good


def test_repeated_rows_null_ids_and_empty_table(documents):
    df = documents([(None, "a b c"), (None, "a b c"), (1, None)])
    assert judge_quality(df).count() == 3 and judge_quality(df.limit(0)).count() == 0
