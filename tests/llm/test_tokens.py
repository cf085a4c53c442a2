"""Token counts, the piece codec and the chunk encoder against their libraries."""

import hashlib
import random

import numpy as np
import pytest

from airpanel.llm.common import Cache
from airpanel.llm.packing import ChunkEncoder
from airpanel.llm.piece_codec import PieceCodec, decode_pieces, encode_pieces, round_trip
from airpanel.llm.token_counts import MergeCounter, count_tokens

P = pytest.importorskip("public_tokenizers")
ODD = [
    "", " ", "  ", "a", " a  b ", "\n\n", "a\n b", "▁x", "<s> </s> <0x41>", "日本語テキスト 漢字", "😀 x😀", "\x00a\x01", "é é", "\r\n\t x", "aaaa    aaaaa",
    "{}}}}((((", "\u3000x", "ſ", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", " it's don't  'LL\t x y.z,, z", "a \x1c b", "\u0085 x", "é .", "İ", "ΑΣ ΑΣ.",
    "x.\u0301", "ÀÉ. ÿß", "a\t b", "x " * 300, "w" * 500,
]


def texts(prose):
    rnd = random.Random(1)
    alphabet = "abcdeiou nthrs\n .,'<>é漢▁0123{}=\tÀé̀!?|"
    some = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    return ODD + some + [r.text for r in prose.limit(60).collect()]


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    return {
        "pieces": sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model")),
        "bytes": Tokenizer.from_file(P.path("byte_bpe_50k.json")), "words": Tokenizer.from_file(P.path("word_bpe_49k.json")),
    }


def test_counts_are_those_of_the_library(prose, library):
    mine = MergeCounter(P.path("byte_bpe_50k.json"), cache=50)
    for t in texts(prose):
        assert mine.count(t) == len(library["bytes"].encode(t, add_special_tokens=False).ids), t


def test_ids_of_pieces_and_their_decoding(prose, library):
    mine, model = PieceCodec(P.path("piece_bpe_32k.model"), cache=50), library["pieces"]
    for t in texts(prose):
        ids = model.encode(t)
        assert mine.encode(t) == ids, t
        assert mine.decode(ids) == model.decode(ids), t
    rnd = random.Random(2)
    some = [0, 1, 2, *range(3, 259), *range(259, 32_000, 97)]
    for _ in range(1500):
        ids = [rnd.choice(some) for _ in range(rnd.randint(0, 8))]
        assert mine.decode(ids) == model.decode(ids), ids


@pytest.mark.parametrize("run", [
    "0123456789", "\n", "春眠暁を覚えず処処啼鳥を聞く夜来風雨の声", "天地玄黄宇宙洪荒日月盈昃", "สวัสดีชาวโลก", "😀🎉", "7", "ab7", "\x00",
])
def test_long_runs_without_a_space(library, run):
    mine, model = PieceCodec(P.path("piece_bpe_32k.model"), cache=50_000), library["pieces"]
    for t in (run * (5000 // len(run)), "see " + run * (1500 // len(run)) + " x\n"):
        ids = model.encode(t)
        assert mine.encode(t) == ids and mine.decode(ids) == model.decode(ids) == t
        assert max(map(len, [k for k in mine.encoded if isinstance(k, str)])) < 200
    # The parts of a run are kept, not its prefixes.
    assert len(mine.encoded) < 100


def test_long_runs_in_a_table(documents, library):
    rows = [(1, "1" * 5000), (2, "\n" * 5000), (3, "春眠暁を覚えず" * 700), (4, "😀" * 5000)]
    got = {r.doc_id: (r.n_tokens, r.decoded_sha256) for r in round_trip(documents(rows), P.path("piece_bpe_32k.model")).collect()}
    assert got == {i: (len(library["pieces"].encode(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows}


def test_joined_pieces_merge_like_the_library(library):
    rnd, model = random.Random(3), library["pieces"]
    mine = PieceCodec(P.path("piece_bpe_32k.model"))
    for _ in range(1500):
        t = "".join(model.id_to_piece(rnd.randrange(300, 32_000)) for _ in range(rnd.randint(1, 6)))
        assert mine.encode(t) == model.encode(t), t


def test_chunk_ids(prose, library):
    mine = ChunkEncoder(P.path("word_bpe_49k.json"), cache=50)
    assert mine.cuttable
    for t in texts(prose):
        assert mine.encode(t) == np.array(library["words"].encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_cache_is_bounded_and_remembers():
    cache = Cache(2)
    for k in "abc":
        cache.put(k, k)
    assert list(cache) == ["c"] and cache.recall("a") == "a" and cache.recall("z") is None and len(cache) == 2


def test_tables(documents, library):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (None, "x"), (3, None), (4, ""), (5, "word " * 1025)]
    df = documents(rows)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, P.path("byte_bpe_50k.json")).collect())
    n = {t: len(library["bytes"].encode(t or "", add_special_tokens=False).ids) for _, t in rows}
    assert got == sorted((str(i), len(t or ""), n[t], n[t] > 1024) for i, t in rows) and got[3][3] is False and got[4][3] is True
    path = P.path("piece_bpe_32k.model")
    for r in round_trip(df, path).collect():
        text = next(t for i, t in rows if i == r.doc_id) or ""
        ids = library["pieces"].encode(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library["pieces"].decode(ids).encode()).hexdigest()
    back = decode_pieces(encode_pieces(df, path), path).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in rows)
    for empty in (count_tokens(df.limit(0), P.path("byte_bpe_50k.json")), round_trip(df.limit(0), path)):
        assert empty.count() == 0
