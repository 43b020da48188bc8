import hashlib
import random

import brute
import numpy as np
import pytest

from satlink.llm import queries, suffix_dedup


def test_query(spark, small_dir, docs):
    want = [(d, n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in brute.repeats(docs)]
    assert brute.rows(queries.op5_lpf_dedup(spark, small_dir)) == sorted(want, key=repr)
    assert sum(x[2] for x in want) > 0


def planted():
    rng = random.Random(3)
    text = lambda n, letters="ab é": "".join(rng.choice(letters) for _ in range(n))
    p = text(400)
    rows = [(i, text(rng.randint(0, 80), "abcdefgh") + p[rng.randint(0, 200) : rng.randint(210, 400)] + text(rng.randint(0, 150), "xyz")) for i in range(60)]
    return rows + [(None, p), (None, p), (None, "q" + p), (500, "a" * 700), (501, "a" * 700), (502, "ab" * 300), (503, None), (504, ""), (505, p), (505, p), (505, p + "x"), (506, "é" * 200)]


@pytest.mark.parametrize("common, flush", [(32768, 24 << 20), (2, 3000), (2, 1)])
def test_planted_repeats(frame, monkeypatch, common, flush):
    monkeypatch.setattr(suffix_dedup, "COMMON", common)
    monkeypatch.setattr(suffix_dedup, "FLUSH_BYTES", flush)
    rows = planted()
    got = suffix_dedup.spans(frame(rows, ["id", "crc", "removed"]).repartition(3))
    flat = sorted(((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept)) for r in got.collect()), key=repr)
    assert flat == brute.repeats(rows)


def test_deduplicate_keeps_columns(frame):
    from pyspark.sql import functions as F

    rows = planted()
    df = frame(rows, ["id", "row", "starts"]).withColumn("n_chars", F.length("text").cast("long"))
    got = suffix_dedup.deduplicate(df)
    assert got.columns == df.columns and got.count() == len(rows)
    want = sorted(((d, k.decode(errors="ignore")) for d, _, _, _, k in brute.repeats(rows)), key=repr)
    found = got.collect()
    assert sorted(((r.doc_id, r.text or "") for r in found), key=repr) == want
    assert all((r.text is None) == (r.doc_id == 503) and r.row == "own" and r.n_chars == (len(r.text) if r.text is not None else None) for r in found)
    assert suffix_dedup.deduplicate(df.limit(0)).collect() == []


def factors(data, length, group=None):
    """(position, LPF) by the operator, for positions with ``length`` bytes before the end."""
    ends, group = np.full(len(data), len(data)), np.zeros(len(data), np.int64) if group is None else group
    sa, _, levels = suffix_dedup.suffix_order(data, ends, group, length)
    return sa, suffix_dedup.longest_previous_factors(sa, levels, ends - np.arange(len(data)))


def brute_factors(data: bytes):
    return [max((k for j in range(i) for k in range(len(data) - i + 1) if data[i : i + k] == data[j : j + k]), default=0) for i in range(len(data))]


def test_longest_previous_factors():
    for text in (b"banana", b"aaaa", b"abcabcab", b"mississippi", b"abcabcabcxabcabd" * 3, b"a" * 60):
        want, data = np.array(brute_factors(text)), np.frombuffer(text, np.uint8)
        for length in (1, 2, 3, 5, 16, 20, 33):
            sa, lpf = factors(data, length)
            assert sorted(sa.tolist()) == list(range(max(0, len(text) - length + 1)))
            assert (np.minimum(lpf, length) == np.minimum(want[sa], length)).all()
            got = np.sort(suffix_dedup.repeated(data, np.full(len(data), len(data)), np.zeros(len(data), np.int64), length))
            assert got.tolist() == [i for i in range(max(0, len(text) - length + 1)) if want[i] >= length]


def test_smaller_neighbours():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 400):
        for sa in (rng.permutation(n), np.arange(n), np.arange(n)[::-1]):
            before, after = suffix_dedup.smaller_neighbours(sa)
            for i in range(n):
                assert before[i] == max((j for j in range(i) if sa[j] < sa[i]), default=-1)
                assert after[i] == min((j for j in range(i + 1, n) if sa[j] < sa[i]), default=-1)


def test_groups_and_pieces_are_kept_apart():
    data, group = np.frombuffer(b"abcdabcdabcd", np.uint8), np.repeat([0, 1, 1], 4)
    ends = np.repeat([4, 8, 12], 4)
    assert suffix_dedup.repeated(data, ends, group, 3).tolist() == [8, 9]


@pytest.mark.parametrize("length, gram", [(400, 32), (60, 20)])
def test_other_lengths(frame, length, gram):
    rows = planted() + [(900 + i, "b" * 600 + str(i) * 30) for i in range(3)]
    got = suffix_dedup.spans(frame(rows), length, gram)
    flat = sorted(((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept)) for r in got.collect()), key=repr)
    assert flat == brute.repeats(rows, length)


def test_runs_keep_their_offsets():
    one, many = np.array([7]), np.array([1 << 63], np.uint64)
    for span, offset in ((0, 0), (255, 9), (300, 290), (70_000, 5)):
        packed = suffix_dedup.pack_runs(one, one, np.array([0]), many & suffix_dedup._48, many, one, one + span, one + offset)
        found = suffix_dedup.unpack_runs(packed)
        assert (found["start"][0], found["last"][0], found["place"][0], found["all"][0]) == (7, 7 + span, 7 + offset, 1 << 63)


def shared_passage(n=400):
    """Documents with one passage, each in other surroundings."""
    rng = random.Random(5)
    text = lambda k: "".join(rng.choice("abcdefghijklmnop ") for _ in range(k))
    passage = text(300)
    return [(i, text(rng.randint(60, 90)) + passage + text(rng.randint(60, 90))) for i in range(n)]


@pytest.mark.parametrize("sample, held", [(1 << 40, 100_000), (20_000, 100_000), (20_000, 500)])
def test_a_common_passage_is_spread(frame, monkeypatch, sample, held):
    """Not every document's copy of a string goes to the one task of its hash, nor every run of a hot gram to one bucket."""
    monkeypatch.setattr(suffix_dedup, "COMMON", 20)
    monkeypatch.setattr(suffix_dedup, "SAMPLE_BYTES", sample)
    monkeypatch.setattr(suffix_dedup, "HOT", 60)
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 5)
    monkeypatch.setattr(suffix_dedup, "HELD_STRINGS", held)
    groups = []
    real = suffix_dedup._factors

    def counted(pieces, buckets, length):
        dealt = pieces.where("part > 0").groupBy("key", "part").count().agg({"count": "max"}).first()[0]
        groups.append(dealt)
        return real(pieces, buckets, length)

    monkeypatch.setattr(suffix_dedup, "_factors", counted)
    rows = shared_passage()
    got = suffix_dedup.spans(frame(rows).coalesce(2))
    flat = sorted(((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept)) for r in got.collect()), key=repr)
    assert flat == brute.repeats(rows)
    assert held == 500 or 1 <= groups[0] <= 16


def test_runs_of_hot_grams_go_to_many_buckets(frame, monkeypatch):
    rows = shared_passage()
    base = suffix_dedup._base(frame(rows), [])
    assert not len(suffix_dedup.hot_keys(base, 100, 100, 32))
    monkeypatch.setattr(suffix_dedup, "SAMPLE_BYTES", 50)
    monkeypatch.setattr(suffix_dedup, "HOT", 200)
    hot = suffix_dedup.hot_keys(base, 100, 100, 32)
    assert 1 <= len(hot) <= 8  # the grams at the two edges of the passage
    key, whole = np.repeat(np.append(hot[:1], np.uint64(7)), 1000), np.tile(np.arange(500, dtype=np.uint64), 4)
    bucket = suffix_dedup.bucket_of(key, whole, hot, 64)
    assert len(set(bucket[:1000])) > 32 and len(set(bucket[1000:])) == 1
    assert (bucket[:500] == bucket[500:1000]).all()
