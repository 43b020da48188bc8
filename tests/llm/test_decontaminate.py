import hashlib

import brute
import pytest

from satlink.llm import decontaminate, queries


def test_query(spark, small_dir, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").collect()]
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c) for d, n, h, i, c in brute.leaks(docs, items)]
    assert brute.rows(queries.op7_winnow_leaks(spark, small_dir)) == sorted(want, key=repr)
    assert any(x[-1] for x in want) and not all(x[-1] for x in want)


@pytest.mark.parametrize("block_bytes", [1 << 25, 300])
def test_short_items_ties_and_blocks(spark, small_dir, docs, frame, block_bytes):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").limit(12).collect()]
    items += [(100, "the of"), (101, "The"), (102, None), (103, "!!"), (104, "the the the the the"), (None, "is the of"), (0, items[3][1]), (0, items[3][1])]
    rows = docs[:60] + [(None, None), (-1, ""), (-2, "the"), (-2, "the"), (-3, "the " * 9), (-4, "  THE of é the of"), (-5, items[3][1] + " x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame(rows, ["n_hit", "item_ids", "row"]), bench, block_bytes=block_bytes)
    assert brute.rows(got) == brute.leaks(rows, items)


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(frame([]), none).collect() == []
    assert [tuple(r) for r in decontaminate.contamination(frame([(1, "a b")]), none).collect()] == [(1, 2, 0, [], False)]


def test_many_equal_words_on_both_sides_take_no_square(spark, frame):
    """5,000 equal words in the item and in the document: every window is looked up once."""
    import time

    import numpy as np

    from satlink.llm import bytewords as B

    text = "the " * 5000
    begin = time.process_time()
    index = decontaminate.Index([("1", text), ("2", text), ("3", "the the")])
    data = np.frombuffer(text.encode(), np.uint8)
    words, at, end, first = B.Words(B.alnum_bytes())(data, np.array([0, len(data)]))
    hit, pairs = decontaminate.hits(index, words, first, data, at, end)
    assert hit.all() and pairs.tolist() == [[0, 0], [0, 1], [0, 2]] and time.process_time() - begin < 2
    rows = [(1, text), (2, "the " * 9), (3, "x the the y")]
    items = [("a", text), ("b", "the the")]
    got = decontaminate.contamination(frame(rows), spark.createDataFrame(items, "item_id string, text string"))
    assert brute.rows(got) == brute.leaks(rows, items)


def test_several_blocks_collect_no_text(spark, small_dir, docs, frame, monkeypatch):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small_dir}/benchmark.parquet").limit(12).collect()]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.blocks_of(bench, 300) >= 3
    monkeypatch.setattr(decontaminate, "Index", None)  # nothing is indexed on the driver
    rows = docs[:40] + [(-9, items[2][1]), (-9, items[2][1]), (-8, None)]
    assert brute.rows(decontaminate.contamination(frame(rows), bench, block_bytes=300)) == brute.leaks(rows, items)


def test_words_of_equal_hash_are_told_apart(spark, frame, monkeypatch):
    """Thue-Morse words, which a polynomial hash modulo 2^64 cannot tell apart."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{word} x"), (2, f"{other} x"), (3, word.upper() + " x")]
    items = [("i", f"{word} x")]
    got = decontaminate.contamination(frame(rows), spark.createDataFrame(items, "item_id string, text string"))
    assert brute.rows(got) == brute.leaks(rows, items) and {r.doc_id for r in got.where("contaminated").collect()} == {1, 3}


def test_query_equals_its_sql(spark, small_dir):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{small_dir}/{t}.parquet')")
    want = con.execute(f"select doc_id, n_words, n_hit, n_items, items_sha256, contaminated from ({queries.ORACLE_SQL['op7_winnow_leaks']})").fetchall()
    got = queries.op7_winnow_leaks(spark, small_dir).selectExpr('doc_id', 'n_words', 'n_hit', 'n_items', 'items_sha256', 'contaminated')
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 0
