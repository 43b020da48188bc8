import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from satlink.llm import queries, wavelet
from satlink.llm.common import work_dir

WORDS = P.path("word_bpe_49k.json")


def expected(docs):
    tokenizer, start, out = Tokenizer.from_file(WORDS), 0, []
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0], r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def test_query_equals_the_library(spark, small_dir, docs):
    got = sorted((tuple(r) for r in queries.op10_wavelet_shards(spark, small_dir).collect()), key=repr)
    assert got == expected(docs)


def test_edges_many_small_shards(spark, frame):
    rows = [(5, None), (4, ""), (None, "no id"), (3, "ÀB  c\n\td's"), (3, "ÀB  c\n\td's"), (1, "x " * 500), (2, "<|endoftext|> é")]
    path = work_dir(spark, "test-wavelet")
    wavelet.write_shards(frame(rows, ["start"]), WORDS, 1, path, shard_tokens=7)
    assert sorted((tuple(r) for r in wavelet.read_documents(spark, path).collect()), key=repr) == expected(rows)
    path = work_dir(spark, "test-wavelet")
    wavelet.write_shards(frame([]), WORDS, 1, path)
    assert wavelet.read_documents(spark, path).collect() == []


@pytest.mark.parametrize("top", [1, 2, 300, 70_000])
def test_file_answers(top):
    ids = np.random.default_rng(top).integers(0, top, 3000).astype(np.uint32)
    s = wavelet.Shard(wavelet.pack(ids, np.array([9]), np.zeros(1, bool), np.array([3000])))
    assert (s.tokens() == ids).all() and s.doc_ids.tolist() == [9] and s.n_docs == 1
    assert [s[i] for i in range(0, 3000, 97)] == ids[::97].tolist()
    for token in {0, int(ids[5]), top - 1}:
        places = np.flatnonzero(ids == token)
        assert s.occurrences(token) == places.tolist() and s.rank(token, 1234) == (places < 1234).sum()
    assert s.rank(top + 5000) == 0
    with pytest.raises(IndexError):
        s.select(0, 10**6)


def test_directory_is_small_and_an_answer_opens_few_pieces():
    """A million ids: the directory takes a sixteenth of the planes, a rank unpacks two pieces a plane at most."""
    ids = np.random.default_rng(0).zipf(1.3, 1_000_000).clip(max=49_000).astype(np.uint32)
    image = wavelet.pack(ids, np.array([1, 2]), np.zeros(2, bool), np.array([400_000, 600_000]))
    s = wavelet.Shard(image)
    assert s.directory.nbytes < 0.07 * s.levels * len(ids) / 8 and not s._open
    for token in (1, 7, 49_000):
        s._open.clear()
        assert s.rank(token, 654_321) == int((ids[:654_321] == token).sum())
        assert len(s._open) <= 2 * s.levels < s.levels * s._pieces
        places = np.flatnonzero(ids == token)
        assert [s.select(token, k) for k in (0, len(places) // 2, len(places) - 1)] == places[[0, len(places) // 2, -1]].tolist()
    assert s.rank(7) == int((ids == 7).sum()) and [s[i] for i in (0, 511, 512, 999_999)] == ids[[0, 511, 512, 999_999]].tolist()
    assert (s.tokens() == ids).all() and s.lengths.tolist() == [400_000, 600_000]
    assert all(wavelet.Shard(wavelet.pack(ids[:k], np.array([1]), np.zeros(1, bool), np.array([k]))).rank(1) == int((ids[:k] == 1).sum()) for k in (1, 511, 512, 513, 262_144, 262_145))


def test_parts_are_encoded_as_the_library_does():
    """Words, marks, letters that change under normalization, special tokens, in any mixture."""
    rng = np.random.default_rng(5)
    letters = list("abXYZ .,!'sßäÖéİıΣς각\u1100\u1161一ﬁǅŉⅠª½5\n\t\u200b<|>\0\u0345ẞÅΩ")
    texts = ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(3000)] + [None, "", "<|endoftext|>x", "a" * 5000]
    e = wavelet.Encoder(WORDS)
    got = [np.frombuffer(x, "<u4").tolist() for x in e.texts(texts)]
    assert got == [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_marks_and_digits_make_no_new_parts():
    """A word with any marks or digits beside it, in capitals or not, is one part: few parts are kept and looked up."""
    marks = [m * k for m in "!?.,;:*#$%&(-" for k in (1, 2)]
    texts = [f"{word}{m}{word.upper()} {m}{word}{i} {word}'s\t{word}" for word in ("window", "fenêtre") for i, m in enumerate(marks)]
    e = wavelet.Encoder(WORDS)
    got = [np.frombuffer(x, "<u4").tolist() for x in e.texts(texts)]
    assert got == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(e.known) <= 2 + 10 + len(marks) + 1


def test_capitals_before_combining_marks_are_composed_as_they_are():
    """h, j, t, w and y with some marks have composed forms, their capitals have none."""
    texts = [f"x {c}{mark}a {c.lower()}{mark}, É{mark}É" for c in "HJTWYAÉ" for mark in "\u0331\u030c\u0308\u030a\u0338\u0323\u0301"]
    texts += ["<=\u0338 5\u0308 a\u0301'S 'tis' ''s !'s don't'RE 's5'5", "×÷²½ÀÿßÞ\r\nÉ", " ", "É"]
    e = wavelet.Encoder(WORDS)
    got = [np.frombuffer(x, "<u4").tolist() for x in e.texts(texts)]
    assert got == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_elements_are_parted_across_runs():
    now = np.random.default_rng(3).integers(0, 1 << 16, 3 * wavelet._RUN + 5).astype(np.uint16)
    bit = now & 8 != 0
    assert (wavelet._parted(now, bit, int((~bit).sum())) == np.concatenate([now[~bit], now[bit]])).all()
