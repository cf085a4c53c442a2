"""Quality rules, lines first: bad lines go, then documents that lose too much text.

Each line with a word is held against three rules: it must end like a sentence, not be a navigation bar, and
not be boilerplate. Lines that fail are removed. A document whose removed lines hold more than ``max_lost`` of
its word characters is rejected, and so is one that fails the base rules (too few words, or too many words
in repeated three-word windows).

Everything is computed inside a row with array functions: no shuffle, and no Python. Hashes of the windows are
sorted with their places, so that a document of n words costs n log n; equal hashes are held against the words,
and texts in which they deceive are sorted by words instead.

Defined cases: a null text has no words and fails the base rules, like an empty one. Repeated rows, repeated ids
and null ids keep their row each. Texts of any length are judged whole. An empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airpanel.llm.common import SPACES, text_of

SYMBOLS = "#*$%&|<>"
#: Characters that end a sentence, or may stand after its end.
END_MARKS = r".!?:;…\"'”’»)\]。！？"
#: A line is a navigation bar if separators stand for at least a third of its words.
SEPARATORS = "|›»•·"
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies",
    "sign up for", "subscribe to", "click here", "read more", "enable javascript", "powered by", "back to top",
)
#: A line with more symbols than this share of its characters does not read as a sentence.
MAX_SYMBOL_SHARE = 0.1


#: A window's hash and its place share one long: the place has these low bits.
PLACE_BITS = 24


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def _count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in the class ``chars``."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def _covered(places: Column) -> Column:
    """Words in the windows that begin at ``places``."""
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))


def _by_words(w: Column) -> Column:
    """Repeated words by sorting the windows' texts."""

    def among(windows: Column) -> Column:
        text = lambda i: F.get(windows, i)["t"]
        again = F.filter(
            F.sequence(F.lit(0), F.size(windows) - 1), lambda i: (text(i) == text(i - 1)) | (text(i) == text(i + 1)),
        )
        return _covered(F.transform(again, lambda i: F.get(windows, i)["p"]))

    at = lambda i: F.get(w, i)
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.struct(F.concat_ws(" ", at(i), at(i + 1), at(i + 2)).alias("t"), i.alias("p")),
    )
    return let(F.sort_array(windows), among)


def _by_hashes(w: Column, hashes: Column) -> Column:
    """The same by sorting hashes with their places, if equal hashes prove to be equal words."""
    low = (1 << PLACE_BITS) - 1
    high = lambda x: x.bitwiseAND(F.lit(~low).cast("long"))
    place = lambda x: x.bitwiseAND(F.lit(low).cast("long")).cast("int")
    packed = F.sort_array(F.transform(hashes, lambda h, i: high(h).bitwiseOR(i.cast("long"))))

    def among(ordered: Column) -> Column:
        again = F.filter(
            ordered, lambda x, i: (high(x) == high(F.get(ordered, i - 1))) | (high(x) == high(F.get(ordered, i + 1))),
        )
        return let(again, settled)

    def settled(again: Column) -> Column:
        def differ(x: Column, i: Column) -> Column:
            last = F.get(again, i - 1)
            a, b = place(x), place(last)
            words = [F.get(w, a + k) != F.get(w, b + k) for k in range(3)]
            return (high(x) == high(last)) & (words[0] | words[1] | words[2])

        collide = F.size(F.filter(again, differ)) > 0
        return F.when(collide, _by_words(w)).otherwise(_covered(F.transform(again, place)))

    return let(packed, among)


def repeated_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""

    def found(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return let(hashes, lambda h: (
            F.when(F.size(F.array_distinct(h)) == F.size(h), 0)
            .when(F.size(h) < 1 << PLACE_BITS, _by_hashes(w, h)).otherwise(_by_words(w))
        ))

    return F.when(F.size(words) >= 4, let(words, found)).otherwise(0).cast("long")


def line_passes(line: Column) -> Column:
    """The rules for one line that has a word."""
    ends = line.rlike(f"[{END_MARKS}][{SPACES}]*\\z")
    separators = _count(line, SEPARATORS)
    navigation = F.when(separators == 0, False).otherwise(3 * separators >= F.size(words_of(line)))
    noisy = _count(line, SYMBOLS) > MAX_SYMBOL_SHARE * F.length(line)
    boilerplate = let(F.lower(line), lambda low: reduce(Column.__or__, [low.contains(p) for p in BOILERPLATE]))
    return ends & ~navigation & ~noisy & ~boilerplate


def _word_chars(text: Column) -> Column:
    return F.length(F.array_join(words_of(text), ""))


def _has_word(line: Column) -> Column:
    return line.rlike(f"[^{SPACES}]")


def cleaned(text: Column) -> Column:
    """The text without the lines that fail."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~_has_word(x) | line_passes(x)), "\n")


def judge_quality(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, max_repeat_pct: int = 50,
    max_lost: float = 0.5,
) -> DataFrame:
    """One row per row of ``df``: id, the counts, ``base_failed``, ``lost_chars``, ``bad_lines`` and ``kept``."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n"), _has_word)
    parts = df.select(
        F.col(id_col).alias("id"), words_of(text).alias("words"), _count(text, SYMBOLS).alias("n_symbols"), lines.alias("lines"),
    )
    failing = F.filter("lines", lambda x: ~line_passes(x))
    counts = parts.select(
        "id", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        let(failing, lambda bad: F.struct(
            F.size(bad).cast("long").alias("n"),
            F.aggregate(bad, F.lit(0), lambda n, x: n + _word_chars(x)).cast("long").alias("chars"),
        )).alias("bad"),
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    return counts.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), F.col("bad.n").alias("bad_lines"), F.col("bad.chars").alias("lost_chars"),
        (~failed & (F.col("bad.chars") <= max_lost * F.col("word_chars"))).alias("kept"),
    )
