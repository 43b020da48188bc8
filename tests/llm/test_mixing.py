import collections
import re

import pytest
from pyspark.sql import functions as F

from satlink.llm import mixing, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(size: dict, share=1.5, most=2, weights=(3, 1, 2)):
    """Shares by weight; what passes a source's bound is shared again among the others, until nothing does."""
    order = sorted(size, key=lambda s: (s is None, "" if s is None else s.encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), share * sum(size.values()), set(order)
    while open_:
        each = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if each[s] > most * size[s]}
        if not over:
            target.update(each)
            break
        for s in over:
            target[s] = float(most * size[s])
            left -= target[s]
        open_ -= over
    return target


def check(rows, got):
    """Rows (doc_id, source, text) and the query's result: sizes, targets, and what is taken of each source."""
    count = lambda t: len(WORD.findall(t or ""))
    size = collections.Counter()
    for _, s, t in rows:
        size[s] += count(t)
    target = brute_targets(dict(size))
    source = {d: s for d, s, _ in rows}
    assert sorted(((r.doc_id, r["size"]) for r in got), key=repr) == sorted(((d, count(t)) for d, _, t in rows), key=repr)
    taken = collections.Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in size)


def test_query(spark, small_dir):
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]
    got = queries.op12_source_schedule(spark, small_dir).collect()
    check(rows, got)
    again = queries.op12_source_schedule(spark, small_dir).repartition(3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_edges(spark):
    """Null source, text and doc_id, empty texts, repeated rows, one very long text, tiny sources, clashing columns."""
    rows = [(i, "big", "w " * 50) for i in range(200)] + [(1000, None, "a b c"), (1001, None, None), (1002, "tiny", "x"), (1003, "empty", ""), (1004, "empty", " \t\r\n\x0b\x0c")]
    rows += [(2000, "long", "word\u00a0y\u2003z " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "'own' as size", "'own' as target", "'own' as sid", "'own' as at")
    check(rows, mixing.taken(docs).collect())
    copies = [(7, "s", "a b c d")] * 300 + [(None, "s", "a b")] * 5 + [(None, None, None)] * 3 + [(8, "t", "q " * 40)]
    got = mixing.taken(spark.createDataFrame(copies, "doc_id long, source string, text string")).collect()
    assert len(got) == len(copies) and collections.Counter((r.doc_id, r["size"]) for r in got) == {(7, 4): 300, (None, 2): 5, (None, 0): 3, (8, 40): 1}
    want = brute_targets({"s": 1210, "t": 40, None: 0})
    assert abs(sum(r.taken for r in got if r.source_size == 1210) - want["s"]) <= 0.5 and all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.taken(docs.where("false")).collect() == []
    assert [r.taken for r in mixing.taken(docs.where("doc_id = 1003")).collect()] == [0]


def test_schedule_is_even_at_every_length(spark):
    """Every prefix of the mix holds each source in its share, to a few slots; ranks have no gaps."""
    sized = spark.createDataFrame([(1, "a", 30_000), (2, "b", 30_000), (3, "c", 3_000), (4, "d", 2)], "doc_id long, source string, size long")
    sources = mixing.written(mixing.targets(sized), "test-mix")
    slots, counts = mixing.schedule(sources, block_words=10)
    share = {r.sid: (r.hi - r.lo) / mixing.POINTS for r in sources.collect()}
    rows = sorted((r.slot, r.sid, r["rank"]) for r in slots.collect())
    number = collections.Counter()
    for i, (_, sid, rank) in enumerate(rows):
        assert rank == number[sid]
        number[sid] += 1
        assert all(abs(number[s] - share[s] * (i + 1)) < 6 for s in share)
    assert {r.sid: r.n_slots for r in counts.collect()} == dict(number) and set(number) == {0, 1, 2, 3}
    # The points are those of whole-number arithmetic, also where products pass 2^63.
    far = [0, 1, 65535, 65536, 2**32 - 1, 2**32 + 5, 2**40 + 12345]
    got = spark.createDataFrame([(x,) for x in far], "x long").select(mixing.point(F.col("x")).alias("u")).collect()
    assert [r.u for r in got] == [x * mixing.GOLDEN % mixing.POINTS for x in far]


def test_mix_holds_every_block_once(spark):
    """The pieces of a slot are whole words of one block; a source's blocks differ by a word at most."""
    rows = [(i, "ab"[i % 2], "w " * (i % 37)) for i in range(300)]
    mix, _ = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string, text string"), block_words=32)
    length, seen = collections.Counter(), collections.Counter()
    for r in mix.collect():
        length[(r.sid, r.slot)] += r.n_words
        for w in range(r.first_word, r.first_word + r.n_words):
            seen[(r.doc_id, r["pass"], w)] += 1
    assert set(seen.values()) == {1}
    for sid in (0, 1):
        sizes = {n for (s, _), n in length.items() if s == sid}
        assert max(sizes) - min(sizes) <= 1 and 30 <= min(sizes) <= 34
