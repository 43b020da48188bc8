import brute
import pytest
from pyspark.sql import functions as F

from satlink.llm import fingerprint, queries


def check(found, docs, near=0.25):
    want = brute.edited(docs)
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=repr) == sorted((x[:3] for x in want), key=repr)
    by_text = {(x[0], x[2]): x for x in want}
    off = [abs(r.near_edited - by_text[r.doc_id, r.edited_sha256][3]) for r in found]
    assert max(off) < near and sum(off) / len(off) < 0.06


def test_query(spark, small_dir, docs):
    found = queries.op8_bottom_k_fingerprints(spark, small_dir).collect()
    check(found, docs)
    text, seen = dict(docs), {}
    for r in found:
        assert seen.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint and 0 <= r.near_next <= 1


@pytest.mark.parametrize("range_rows", [1, 7, 1000])
def test_ranges_and_edges(docs, frame, monkeypatch, range_rows):
    monkeypatch.setattr(fingerprint, "RANGE_ROWS", range_rows)
    rows = docs[:40] + [(None, "x y z"), (-1, None), (-2, ""), (-3, "𝒳 𝒳 a"), (-4, "one")]
    found = fingerprint.fingerprints(frame(rows, ["sketch", "next_text"])).select("*", F.sha2("edited", 256).alias("edited_sha256")).collect()
    check(found, rows, 0.5)


def test_single_repeated_and_empty(frame):
    one = fingerprint.fingerprints(frame([(1, "é a b c d e f g")])).first()
    assert one.near_next == 1.0 and one.n_chars == 15
    same = fingerprint.fingerprints(frame([(5, "a b"), (5, "a b"), (5, "a b")])).collect()
    assert len(same) == 3 and all(r.near_next == 1.0 for r in same)
    assert fingerprint.fingerprints(frame([])).collect() == []


def test_merge_containment_and_count(frame):
    k = 32
    text = " ".join(f"w{i}" for i in range(3000))
    whole = fingerprint.with_sketch(frame([(1, text)]), "text", "sketch", k)
    parts = fingerprint.with_sketch(frame([(1, " ".join(f"w{i}" for i in range(2000))), (2, " ".join(f"w{i}" for i in range(1900, 3000)))]), "text", "sketch", k)
    merged = parts.agg(fingerprint.merge(F.col("sketch"), k).alias("m")).first()["m"]
    # Only the first words of the second part have shingles of their own.
    assert len(set(merged) & set(whole.first()["sketch"])) >= k - 4
    both = whole.select(F.col("sketch").alias("a")).crossJoin(parts.where("doc_id = 1").select(F.col("sketch").alias("b")))
    r = both.select(fingerprint.resemblance(F.col("a"), F.col("b"), k).alias("j"), fingerprint.containment(F.col("b"), F.col("a"), k).alias("c"), fingerprint.distinct_shingles(F.col("a"), k).alias("n")).first()
    assert abs(r.j - 2 / 3) < 0.3 and r.c > 0.6 and 1500 < r.n < 6000
