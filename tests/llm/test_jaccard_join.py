import random

import brute
import numpy as np
import pytest

from satlink.llm import components, jaccard_join, queries


def test_query(spark, small_dir, docs):
    assert brute.rows(queries.op9_divideskip_join(spark, small_dir)) == brute.components(docs)


@pytest.mark.parametrize("broadcast_rows, long_lists, chunk", [(1_000_000, 32, 64), (0, 3, 5)])
def test_near_copies_salted_lists_and_edges(frame, monkeypatch, broadcast_rows, long_lists, chunk):
    rng = random.Random(1)
    rows = [(None, "a b c d"), (1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a b c d e"), (6, "a b c d e"), (7, "a b c d e"), (8, "b a")]
    for i in range(120):
        w = [f"w{j}" for j in range(60)]
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = f"z{rng.randrange(1000)}"
        rows.append((1000 + i, " ".join(w)))
    monkeypatch.setattr(jaccard_join, "COMMON_LEAST", 20)
    monkeypatch.setattr(jaccard_join, "COMMON_TIMES", 0)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", broadcast_rows)
    monkeypatch.setattr(jaccard_join, "LONG", long_lists)
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    assert brute.rows(jaccard_join.similarity_components(frame(rows, ["n", "k1", "rep"]))) == brute.components(rows)


def test_empty(frame):
    assert jaccard_join.similarity_components(frame([])).collect() == []


def test_t_occurrence_against_intersections():
    rng = np.random.default_rng(2)
    for _ in range(40):
        query = np.unique(rng.integers(0, 60, 40).astype(np.uint64))
        sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(9)]
        need = {i: int(rng.integers(1, 30)) for i in range(9) if rng.random() < 0.8}
        want = [i for i, s in enumerate(sets) if i in need and len(np.intersect1d(query, s)) >= need[i]]
        assert jaccard_join.Inverted(sets).search(query, need) == want


def test_spreads_leave_out_only_pairs_that_cannot_link(spark):
    """Candidates of unlike sets are not sent with their sets; what can link stays, in full classes and in one root's blocks, too."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 48, 600).astype(np.uint64)
    near = np.concatenate([base[:580], rng.integers(0, 1 << 48, 20).astype(np.uint64)])
    full = (rng.integers(0, 1 << 40, 600) * jaccard_join.CLASSES).astype(np.uint64)  # all in one class: no bound
    sets = {1: base, 2: near, 3: rng.integers(0, 1 << 48, 600).astype(np.uint64), 4: base[:400], 5: full, 6: base}
    known = spark.createDataFrame([(d, len(s), bytearray(jaccard_join.spread(s).tobytes())) for d, s in sets.items()], "doc_id long, n int, spread binary")
    rows = [(10, 0, 0, None, 1), (10, 0, 1, None, 2), (10, 0, 1, None, 3), (10, 0, 1, None, 4), (11, 0, 0, None, 3), (11, 0, 1, None, 1)]
    rows += [(12, 0, 0, None, 5), (12, 0, 1, None, 1), (12, 0, 1, None, 5), (13, 0, 2, 7, 1), (13, 0, 2, 7, 6), (13, 0, 2, 8, 2), (14, 0, 2, 7, 1), (14, 0, 2, 7, 6)]
    roles = spark.createDataFrame(rows, "x long, y long, role int, root long, doc_id long")
    got = {(r.x, r.role, r.doc_id) for r in jaccard_join._may_reach(known, roles, 85).collect()}
    assert got == {(10, 0, 1), (10, 1, 2), (13, 2, 1), (13, 2, 6), (13, 2, 2)}


def test_unlike_candidates_send_no_sets(frame, monkeypatch):
    """Documents that share one rare passage are candidates by hundreds; their texts are not read for it, nor shuffled."""
    rows = [(i, " ".join(f"{i}x{j}" for j in range(60)) + " the same rare passage") for i in range(40)] + [(98, " ".join(f"w{j}" for j in range(60))), (99, " ".join(f"w{j}" for j in range(59)))]
    sent = []
    old = jaccard_join._marked
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard_join, "_marked", lambda docs, ids: sent.append(ids.count()) or old(docs, ids))
    assert brute.rows(jaccard_join.similarity_components(frame(rows))) == brute.components(rows)
    assert sent == [2]


def test_marks_keep_all_named_documents(frame):
    docs = frame([(i, f"t{i}") for i in range(-50, 3000)] + [(None, "x")])
    ids = docs.where("doc_id % 3 = 0").select("doc_id")
    got = [r.doc_id for r in jaccard_join._marked(docs, ids).collect()]
    assert {i for i in range(-50, 3000) if i % 3 == 0} <= set(got) and len(got) == len(set(got)) < 1100


def test_components_of_long_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 400)] + [(7, x) for x in range(1000, 1200)] + [(1199, 399), (5, 5), (90, 91)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.a: r.b for r in components.stars(df).collect()}
    assert got == {x: 7 for x in [*range(100, 401), *range(1000, 1200)]} | {91: 90}
    assert components.stars(df.limit(0)).collect() == []


def test_query_equals_its_sql(spark, small_dir):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{small_dir}/{t}.parquet')")
    want = con.execute(f"select doc_id, n_shingles, component_id from ({queries.ORACLE_SQL['op9_divideskip_join']})").fetchall()
    got = queries.op9_divideskip_join(spark, small_dir).selectExpr('doc_id', 'n_shingles', 'component_id')
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 0
