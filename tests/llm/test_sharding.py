import collections
import itertools
import zlib

from satlink.llm import queries, sharding


def test_query(spark, small_dir, docs):
    got, text = queries.op3_kk_shards(spark, small_dir).collect(), dict(docs)
    of_text, size, slots = collections.defaultdict(set), collections.Counter(), collections.defaultdict(list)
    for r in got:
        assert r.size == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r.law == "bytes" and r.grown_shard is None
        of_text[text[r.doc_id]].add(r.shard)
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert sorted(r.doc_id for r in got) == sorted(text) and set(slots) <= set(range(24))
    assert all(len(s) == 1 for s in of_text.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = collections.Counter()
    for d, t in docs:
        groups[t] += len(t.encode()) + 8
    assert max(size.values()) <= max(1.02 * sum(size.values()) / 24, max(groups.values()))


def test_bundles_balance_and_hot_group(frame, spark):
    rows = [(i, "x" * 50) for i in range(600)] + [(1000 + i, f"text {i} " + "y" * (i % 40)) for i in range(900)]
    got = sharding.shard(frame(rows), 8, items_per_shard=10).collect()
    size = collections.Counter()
    for r in got:
        size[r.shard] += r["size"]
    hot = {r.shard for r in got if r.doc_id < 1000}
    assert len(got) == 1500 and len(hot) == 1
    rest = [v for s, v in size.items() if s not in hot]
    assert max(rest) - min(rest) < 0.2 * max(rest)


def test_edges(frame):
    got = sharding.shard(frame([(None, None), (1, None), (1, None), (2, ""), (3, "x"), (3, "x")], ["shard", "slot", "digest"]), 3).collect()
    assert len({r.shard for r in got if r["size"] == 8 and r.text_crc32 is None}) == 1 and len({r.shard for r in got if r.doc_id == 3}) == 1
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard(frame([]), 3).collect() == []


def test_differencing_against_all_partitions():
    for weights in ([8, 7, 6, 5, 4], [5, 5, 5, 5], [9], [], [100, 1, 1, 1], [3, 1, 4, 1, 5, 9, 2, 6]):
        for k in (2, 3):
            parts = sharding.differencing(weights, k)
            sums = lambda p: [sum(w for w, q in zip(weights, p) if q == i) for i in range(k)]
            best = min((max(sums(p)) for p in itertools.product(range(k), repeat=len(weights))), default=0)
            assert len(parts) == len(weights) and max(sums(parts)) <= 1.2 * best
