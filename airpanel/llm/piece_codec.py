"""SentencePiece encoding and decoding for merge-type (BPE) models, by a table over prefixes.

For every prefix of a text there is one last token of its encoding. The table stores it: an automaton over
the vocabulary gives the tokens that end at a place, and the one that is compatible with the last token of
the prefix before it is the entry. Two tokens are compatible if merging their joined text gives just these
two. The ids are read off the table from the end of the text backwards.

Characters outside the vocabulary become byte tokens. Texts are cut where no token can span (before a run of
space marks, around newlines), and a cut at every pair of neighbours that lies inside no token; each worker
keeps a bounded cache of short cuts and parts. A model whose tokens span spaces is used without the first.

Defined cases: a null text is the empty text, with no ids. Repeated rows, repeated ids and null ids keep their row
each. Texts of any length are encoded whole; unbroken runs are cut in a loop. An empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airpanel.llm.common import Cache, slices

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Only texts of fewer characters are kept in the cache.
SHORT = 200


class PieceCodec:
    def __init__(self, path: str, cache: int = 200_000):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        form, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("needs a merge-type model with byte fallback")
        if form.precompiled_charsmap or form.remove_extra_whitespaces or not form.escape_whitespaces or kinds - {1, 2, 3, 6}:
            raise ValueError("needs a model with identity normalization and no user-defined pieces")
        self.dummy = MARK if form.add_dummy_prefix else ""
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.alphabet: set[str] = set()
        self.byte_ids = [0] * 256
        self.words = ahocorasick.Automaton()
        self.texts: list[str] = [str(i) for i in range(len(model.pieces))]
        self.surface: list[bytes] = []
        self.lengths = [len(p.piece) for p in model.pieces]
        self.kinds = bytearray(p.type for p in model.pieces)
        for i, p in enumerate(model.pieces):
            if p.type == NORMAL:
                self.scores[p.piece], self.ids[p.piece] = p.score, i
                self.words.add_word(p.piece, i)
                self.alphabet.update(p.piece)
                self.surface.append(p.piece.replace(MARK, " ").encode())
            elif p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
                self.surface.append(bytes([int(p.piece[1:-1], 16)]))
            else:
                self.surface.append(model.trainer_spec.unk_surface.encode() if p.type == UNKNOWN else b"")
        self.words.make_automaton()
        self.piece_of = {i: p for p, i in self.ids.items()}
        #: Neighbours inside some piece; a text may be cut between any others.
        self.inside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        spans = any(a != MARK and b == MARK for p in self.ids for a, b in zip(p, p[1:]))
        newline = "" if "\n" in self.alphabet else r"\n"
        self.cuts = None if spans else re.compile(rf"{MARK}*[^{MARK}{newline}]+|{MARK}+" + (r"|\n+" if newline else ""))
        self.compatible: Cache = Cache(400_000)
        self.encoded: Cache = Cache(cache)

    def merged(self, text: str) -> list[str]:
        """The symbols left when the best-scored adjacent pair, leftmost first, is merged until none is left."""
        symbols: list[str | None] = list(text)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            joined = symbols[i] + symbols[j]
            if joined in self.scores:
                heapq.heappush(heap, (-self.scores[joined], i, joined))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if symbols[i] is None or j >= n or symbols[i] + symbols[j] != joined:
                continue
            symbols[i], symbols[j] = joined, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s in symbols if s is not None]

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of the joined texts is just these two tokens."""
        key = left << 32 | right
        known = self.compatible.recall(key)
        if known is None:
            a, b = self.piece_of[left], self.piece_of[right]
            apart = a[-1] + b[0] not in self.inside and self.merged(a) == [a] and self.merged(b) == [b]
            known = self.compatible.put(key, apart or self.merged(a + b) == [a, b])
        return known

    def _table(self, text: str) -> list[int]:
        """Ids of a text of known characters, from its prefix table."""
        n = len(text)
        last, fits, lengths = [-1] * (n + 1), self.compatible.get, self.lengths
        # The automaton gives the longest token that ends at a place first; the first that fits is the only one.
        for at, token in self.words.iter(text):
            if last[at + 1] >= 0:
                continue
            start = at + 1 - lengths[token]
            if start:
                before = last[start]
                if before < 0:
                    continue
                fit = fits(before << 32 | token)
                if fit is None:
                    fit = self.fits(before, token)
            else:
                fit = fits(token)
                if fit is None:
                    fit = self.fits_alone(token)
            if fit:
                last[at + 1] = token
        ids = []
        while n > 0:
            token = last[n]
            if token < 0:
                raise ValueError("no token ends here: the vocabulary lacks a character")
            ids.append(token)
            n -= lengths[token]
        ids.reverse()
        return ids

    def fits_alone(self, token: int) -> bool:
        known = self.compatible.recall(token)
        if known is None:
            piece = self.piece_of[token]
            known = self.compatible.put(token, self.merged(piece) == [piece])
        return known

    def _part(self, part: str) -> tuple[int, ...]:
        """Ids of characters that lie inside pieces two by two, or of a single one; outside the alphabet it is bytes."""
        if len(part) == 1 and part not in self.alphabet:
            return tuple(self.byte_ids[b] for b in part.encode())
        return tuple(self._table(part))

    def _cut(self, cut: str) -> tuple[int, ...]:
        """Ids of a cut, part by part: no token spans neighbours that lie inside no piece."""
        known, inside, ids, start = self.encoded, self.inside, [], 0
        for end in range(1, len(cut) + 1):
            if end < len(cut) and cut[end - 1:end + 1] in inside:
                continue
            part = cut[start:end]
            found = known.get(part)
            if found is None:
                found = known.recall(part)
            if found is None:
                found = known.put(part, self._part(part)) if len(part) < SHORT else self._part(part)
            ids += found
            start = end
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        marked = self.dummy + text.replace(" ", MARK)
        if self.cuts is None:
            return list(self._cut(marked))
        known, parts = self.encoded, []
        for cut in self.cuts.findall(marked):
            ids = known.get(cut)
            if ids is None:
                ids = known.recall(cut)
            if ids is None:
                ids = known.put(cut, self._cut(cut)) if len(cut) < SHORT else self._cut(cut)
            parts.append(ids)
        return list(chain.from_iterable(parts))

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``; bytes that are no UTF-8 become replacement characters."""
        surface, at = self.surface, 0
        while at < len(ids) and self.kinds[ids[at]] == CONTROL:
            at += 1
        raw = b"".join(map(surface.__getitem__, ids))
        if self.dummy and at < len(ids) and self.kinds[ids[at]] == NORMAL and raw[:1] == b" ":
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids, at)

    def _decode_runs(self, ids: list[int], first: int) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            i = 0
            while i < len(run):
                for k in (1, 2, 3, 4):
                    try:
                        out.append(run[i:i + k].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    k = 1
                i += k
            run.clear()

        for i, token in enumerate(ids):
            if self.kinds[token] == BYTE:
                run += self.surface[token]
                continue
            flush()
            text = self.surface[token].decode()
            out.append(text[1:] if self.dummy and i == first and self.kinds[token] == NORMAL and text[:1] == " " else text)
        flush()
        return "".join(out)

    def joined(self, ids: list[int]) -> str:
        """The ids in decimal, joined by commas."""
        return ",".join(map(self.texts.__getitem__, ids))


@lru_cache(2)
def codec(path: str) -> PieceCodec:
    """One per worker and model."""
    return PieceCodec(path)


def encode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in slices(batches):
            ids = pa.array((encode(t or "") for t in batch["text"].to_pylist()), pa.list_(pa.int32()), size=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch["id"], ids], names=[id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return _picked(df, id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode_pieces(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text`` of each row; null ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path).decode
        for batch in slices(batches):
            texts = pa.array([decode(i or []) for i in batch["ids"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["id"], texts], names=[id_col, "text"])

    kind = df.schema[id_col].dataType.simpleString()
    picked = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return picked.mapInArrow(run, f"`{id_col}` {kind}, text string")


def _picked(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes each row in one pass: ``n_tokens`` and digests of the ids and of the decoded text."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = codec(path)
        for batch in slices(batches, 100):
            counts, coded, decoded = [], [], []
            for text in batch["text"].to_pylist():
                ids = pieces.encode(text or "")
                counts.append(len(ids))
                coded.append(sha(pieces.joined(ids)))
                decoded.append(sha(pieces.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return _picked(df, id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
