import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from satlink.llm import byte_bpe, queries

RANKS = P.path("byte_bpe_50k.tiktoken")
EDGES = [(-1, None), (-2, ""), (-3, "a\x1c b　　c  \n\n x'll  "), (-4, "é" * 700 + " " * 300 + "x"), (-5, "​\x85 1234५ 'S's'\n \t\n"), (-5, "a"), (-5, "a"), (None, "the end ")]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})


def digest(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library(spark, small_dir, docs, library):
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op1_byte_bpe(spark, small_dir).collect())
    assert got == sorted((d, *digest(library, t)) for d, t in docs)


def test_edges_and_clashing_columns(frame, library):
    df = byte_bpe.encode(frame(EDGES, ["ids", "decoded", "n_tokens"]), RANKS, P.PATTERN)
    assert df.columns == ["doc_id", "text", "n_tokens", "ids", "decoded"]
    for r in df.collect():
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == "own"
    assert byte_bpe.encode(frame([]), RANKS, P.PATTERN).collect() == []


def test_small_word_cache_gives_the_same(docs, library, monkeypatch):
    codec = byte_bpe.Codec(RANKS, P.PATTERN)
    codec.chunks.most = codec.words.most = 20
    texts = [t for _, t in docs[:40]]
    for at in range(0, 40, 8):
        for t, (ids, decoded) in zip(texts[at : at + 8], codec.texts(texts[at : at + 8])):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t) and decoded == t.encode()


def test_long_words_are_contracted_alike(library, monkeypatch):
    codec = byte_bpe.Codec(RANKS, P.PATTERN)
    rng = np.random.default_rng(1)
    words = ["a" * 1500, " " * 3000 + "x", "".join(rng.choice(list("abcé"), 4000)), "=-" * 2500, "x" * 200_000]
    for text, (ids, decoded) in zip(words, codec.texts(words)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text) and decoded == text.encode()
    monkeypatch.setattr(byte_bpe, "LONG_WORD", 3)
    other = byte_bpe.Codec(RANKS, P.PATTERN)
    texts = ["The quick brown foxes, naïvely jumping", "aaaaaa ababab"]
    assert [np.frombuffer(i, "<u4").tolist() for i, _ in other.texts(texts)] == [library.encode_ordinary(t) for t in texts]
