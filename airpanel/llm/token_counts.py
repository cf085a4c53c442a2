"""Token counts of a byte-level BPE vocabulary, without making ids.

A text is cut where no token can span, each piece is turned into byte symbols, and a heap of adjacent pairs
over a linked list merges the pair of lowest rank, leftmost first, until none is left. The count of a piece
is its symbols less its merges. Pieces repeat, so each worker keeps a bounded cache of counts.

The vocabulary is a ``tokenizers`` JSON file. Its special tokens count as one token where they stand in a
text, which is that library's default. No limit cuts a text.

Defined cases: a null text counts as the empty text, with 0 bytes and 0 tokens. Repeated rows and null ids
keep their row each. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.common import Cache, alternatives, slices

#: A run of spaces and newlines with the run of other characters after it. No token spans the place between
#: another character and a space after it, as long as no other kind of white space is near.
CHUNKS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
OTHER_SPACE = re.compile(r"[^\S \n]")
#: A word of Latin letters and a mark after it: two pieces, whatever the splitter's edition of Unicode.
PLAIN = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")


class MergeCounter:
    """Counts the tokens that the vocabulary file's library would give."""

    def __init__(self, path: str, cache: int = 300_000):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("needs a byte-level BPE vocabulary without normalizer or prefix space")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.ids: dict[str, int] = model["vocab"]
        #: (left id, right id) in one integer -> rank; rank -> id of the merged symbol.
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(self.ids[left] << 32 | self.ids[right], rank)
            self.made.append(self.ids[left + right])
        self.specials = alternatives(t["content"] for t in spec["added_tokens"]) if spec["added_tokens"] else None
        self.first = {t["content"][:1] for t in spec["added_tokens"]}
        self.pieces = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        # The library writes each byte as one character: printable Latin-1 as itself, the rest from 256 on.
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in shown]
        self.byte_ids = {b: self.ids[chr(b)] for b in shown} | {b: self.ids[chr(256 + i)] for i, b in enumerate(hidden)}
        self.by_piece: Cache = Cache(cache)
        self.by_chunk: Cache = Cache(cache)

    def merged(self, symbols: list[int]) -> int:
        """Symbols left of one piece (a symbol per byte) after all merges."""
        n, rank_of, made = len(symbols), self.ranks.get, self.made
        # The rank of the pair that begins at each symbol; a heap entry of another rank is out of date.
        rank = [rank_of(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
        rank.append(-1)
        heap = [r << 32 | i for i, r in enumerate(rank) if r >= 0]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            least = heappop(heap)
            i, r = least & 0xFFFFFFFF, least >> 32
            if rank[i] != r:
                continue
            merges += 1
            j = after[i]
            k = after[i] = after[j]
            symbols[i] = merged = made[r]
            rank[j] = -1
            if k < n:
                before[k] = i
                rank[i] = r = rank_of(merged << 32 | symbols[k], -1)
                if r >= 0:
                    heappush(heap, r << 32 | i)
            else:
                rank[i] = -1
            h = before[i]
            if h >= 0:
                rank[h] = r = rank_of(symbols[h] << 32 | merged, -1)
                if r >= 0:
                    heappush(heap, r << 32 | h)
        return n - merges

    def word(self, word: str) -> int:
        known = self.by_piece.get(word)
        if known is None:
            known = self.by_piece.recall(word)
        if known is None:
            known = self.by_piece.put(word, self.merged([self.byte_ids[b] for b in word.encode()]))
        return known

    def chunk(self, chunk: str) -> int:
        plain = PLAIN.fullmatch(chunk)
        if plain:
            return self.word(plain[1]) + len(plain[2])
        ids = self.ids
        return sum(self.merged([ids[c] for c in p]) for p, _ in self.pieces(chunk))

    def ordinary(self, text: str) -> int:
        """Tokens of a text without special tokens."""
        if OTHER_SPACE.search(text):
            return self.chunk(text)
        known, total = self.by_chunk, 0
        for c in CHUNKS.findall(text):
            n = known.get(c)
            if n is None:
                n = known.recall(c)
            if n is None:
                n = known.put(c, self.chunk(c)) if len(c) < 200 else self.chunk(c)
            total += n
        return total

    def count(self, text: str) -> int:
        if self.specials and any(c in text for c in self.first):
            parts = self.specials.split(text)
            return sum(map(self.ordinary, parts)) + len(parts) - 1
        return self.ordinary(text)


@lru_cache(2)
def counter(path: str) -> MergeCounter:
    """One per worker and vocabulary."""
    return MergeCounter(path)


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in slices(batches):
            texts = [t or "" for t in batch["text"].to_pylist()]
            tokens = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([len(t.encode()) for t in texts], pa.int64()),
                 pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
