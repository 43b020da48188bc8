import math

import duckdb
import numpy as np
import pytest

from satlink.llm import hard_negatives as H
from satlink.llm import queries

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


EVERY_50 = "vec_id % 50 = 0"


def brute(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """(vec_id, vector, label) rows, all pairs, in Python integers."""
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    kept = list(dict.fromkeys((i, tuple(math.floor(256 * x) for x in v), y) for i, v, y in rows if i is not None and y is not None and ok(v)))
    out = []
    for a in kept:
        if a[0] % every:
            continue
        scored = [(-sum(p * q for p, q in zip(a[1], b[1])), b[0], b[2]) for b in kept if b is not a and len(a[1]) == len(b[1])]
        for s, i, _ in sorted(r for r in scored if r[2] == a[2])[:positives]:
            hits = sorted(r for r in scored if r[2] != a[2] and low * -s <= 100 * -r[0] <= high * -s)[:negatives]
            out += [(a[0], i, k + 1, r[1], -s, -r[0]) for k, r in enumerate(hits)]
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def test_query_and_its_sql(spark, small_dir):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    result = got(queries.op13_hard_negatives(spark, small_dir))
    assert result == brute(rows) and len(result) > 50
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{small_dir}/embeddings.parquet')")
    sql = con.execute(queries.ORACLE_SQL["op13_hard_negatives"])
    order = [[d[0] for d in sql.description].index(c) for c in COLUMNS]
    assert sorted(tuple(r[i] for i in order) for r in sql.fetchall()) == result


@pytest.mark.parametrize("spread", [0.05, 0.5])
def test_clusters_ties_and_hot_label(spark, spread):
    """Clustered vectors (where angles exclude most pairs), a hot label, a vector with many copies, small blocks."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] * (1 + i % 3) + rng.normal(size=12) * spread).tolist(), 0 if i % 3 else i % 5) for i in range(500)]
    rows += [(1000 + i, rows[3][1], 3 if i % 2 else 0) for i in range(120)]
    result = got(H.mine(frame(spark, rows), EVERY_50, block_rows=40, block_anchors=7))
    assert result == brute(rows) and len(result) > 30


def test_edges(spark):
    """Nulls, NaN, infinity, zero and empty vectors, other lengths, equal rows, huge and negative components, clashing columns."""
    base = [(0, [1.0, 2.0, 3.0], 1), (1, [1.0, 2.0, 3.0], 1), (2, [1.0, 2.0, 2.0], 1), (3, [1.0, 1.0, 2.0], 2), (4, [0.5, 1.0, 2.0], 2), (4, [0.5, 1.0, 2.0], 2), (5, [0.1, 1.0, 2.0], 3)]
    odd = [(None, [1.0, 1.0, 2.0], 2), (6, None, 2), (7, [1.0, None, 2.0], 2), (8, [1.0, float("nan"), 2.0], 2), (9, [float("inf"), 1.0, 1.0], 2), (10, [1.0, 1.0, 2.0], None),
           (11, [0.0, 0.0, 0.0], 2), (12, [], 2), (13, [], 1), (50, [], 1), (14, [1.0, 2.0], 2), (100, [1.0, 2.0], 1), (101, [1.0, 2.1], 1), (102, [-1.0, -2.0, -3.0], 1),
           (150, [3e5, 2e5, 1e5], 4), (151, [2e5, 3e5, 1e5], 4), (152, [1e5, 2e5, 1e5 + 0.37], 5), (200, [0.0, 0.0, 0.0], 7), (201, [1.0, 0.0, 0.0], 7)]
    for rows in (base, base + odd):
        df = frame(spark, rows).selectExpr("*", "'own' as block", "'own' as strip", "'own' as q", "'own' as a_block")
        assert got(H.mine(df, EVERY_50)) == brute(rows)
    assert got(H.mine(df.where("false"), EVERY_50)) == []
    assert got(H.mine(df, "vec_id = -1")) == []


def test_bounds_hold_true_scores():
    """The interval of every pair contains its score, also for equal and opposite vectors, where an arc cosine is least exact."""
    rng = np.random.default_rng(3)
    q = np.floor(rng.normal(size=(300, 64)) * 256)
    q[:50], q[50:100], q[100] = q[200:250], -q[200:250], 0
    norm = np.sqrt((q * q).sum(1))
    refs = np.concatenate([q[:4] / norm[:4, None], rng.normal(size=(4, 64)) / 8])
    refs /= np.linalg.norm(refs, axis=1)[:, None]
    turn = H.angles(q, norm, refs)
    block = H.Block(300, 64, False, np.arange(300).tobytes(), np.zeros(300, np.int64).tobytes(), norm.tobytes(), turn.tobytes(), q.astype("<i4").tobytes())
    scores, every = q @ q.T, slice(0, 300)
    for i in range(300):
        one = np.array([scores[j, i] for j in range(300)])
        assert H.overlap(block, every, block, slice(i, i + 1), one, one).all()
    other = H.Block(300, 64, False, np.arange(300).tobytes(), np.zeros(300, np.int64).tobytes(), norm.tobytes(), turn.tobytes(), q.astype("<i4").tobytes())
    other.sort()
    for i in range(300):
        least = np.sort(scores[i])[-5:-4]
        part = H.reach(block, slice(i, i + 1), other, least)
        assert set(np.flatnonzero(scores[i] >= least)) <= set(other.ids[part].tolist())
