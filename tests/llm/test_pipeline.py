import brute
import public_tokenizers as P
import tiktoken

import corpus_pipeline
from satlink.llm import byte_bpe, decontaminate
from satlink.llm.common import table, work_dir


def test_stages_against_brute_force(spark):
    path = "/root/testdata/sf0.01"
    docs = table(spark, path, "documents").limit(400)
    before, texts, out = docs, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        to = work_dir(spark, f"test-{name}")
        stage(spark, before, path).write.parquet(to)
        before = spark.read.parquet(to)
        out[name] = before
        if name != "byte_bpe":
            assert before.columns == docs.columns
            texts[name] = [(r.doc_id, r.text) for r in before.collect()]
    given = texts["toxicity"]
    alone = {d for d, _, c in brute.components(given, 5, 80) if d == c}
    assert {d for d, _ in texts["near_duplicates"]} == alone and len(texts["near_duplicates"]) == len(alone)
    want = sorted(((d, k.decode(errors="ignore")) for d, _, _, _, k in brute.repeats(texts["near_duplicates"])), key=repr)
    assert sorted(texts["repeated_strings"], key=repr) == want
    items = [(r.item_id, r.text) for r in table(spark, path, "benchmark").collect()]
    clean = {x[0] for x in brute.leaks(texts["repeated_strings"], items) if not x[4]}
    assert {d for d, _ in texts["decontamination"]} == clean
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    final, last = out["byte_bpe"].collect(), dict(texts["decontamination"])
    assert {r.doc_id for r in final} == set(last) and all(r.ids == library.encode_ordinary(last[r.doc_id]) and r.n_tokens == len(r.ids) for r in final)


def test_edges_in_every_stage(spark, small_dir):
    """Nulls, repeated rows and clashing columns pass each stage; an empty table stays empty."""
    rows = [(1, "a b c d e f", "en"), (1, "a b c d e f", "en"), (2, None, None), (None, "x y", "de"), (3, "", "en"), (4, "a b c d e f", "en")]
    schema = "doc_id long, text string, lang string"
    names = ("score", "predicted", "row", "id", "crc", "n_hit", "ids", "number", "null_text")
    for given, left in ((rows, [1, 2, 3, None]), ([], [])):
        docs = spark.createDataFrame(given, schema).selectExpr("*", "null as source", "cast(length(text) as long) as n_chars", *[f"'own' as {c}" for c in names])
        for name, stage in corpus_pipeline.STAGES:
            before = docs.columns
            to = work_dir(spark, f"test-{name}")
            result = stage(spark, docs, small_dir)
            result.withColumns({c: result[c].cast("string") for c, kind in result.dtypes if kind == "void"}).write.parquet(to)
            docs = spark.read.parquet(to)
            assert name == "byte_bpe" or docs.columns == before
        assert sorted((r.doc_id for r in docs.collect()), key=repr) == sorted(left, key=repr)


def test_decontamination_over_several_blocks(spark, small_dir, monkeypatch):
    """The stage carries its struct of all columns through the path of a large benchmark, too."""
    items = [r.text for r in table(spark, small_dir, "benchmark").limit(3).collect()]
    rows = [(1, items[0]), (2, "a clean text"), (2, "a clean text"), (3, None), (None, "no id"), (4, f"x {items[2]} y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'own' as row", "null as source", "'k' as key", "timestamp_micros(1700000000000000 + monotonically_increasing_id()) as at", "array(doc_id, null) as ids"
    )
    to = work_dir(spark, "test-blocks")
    docs.write.parquet(to)
    docs = spark.read.parquet(to)
    given = {str(r): r for r in docs.collect() if r.doc_id not in (1, 4)}
    real = decontaminate.contamination
    calls = []

    def small_blocks(*args, **named):
        calls.append(decontaminate.blocks_of(args[1], 300))
        return real(*args, **named, block_bytes=300)

    monkeypatch.setattr(decontaminate, "contamination", small_blocks)
    result = corpus_pipeline.decontamination(spark, docs, small_dir)
    assert calls[0] > 1 and result.columns == docs.columns
    got = result.collect()
    assert len(got) == 4 and {str(r) for r in got} == set(given)


def test_near_copies_of_similarity_080_to_085_go(spark, small_dir):
    """Texts of 100 five-word shingles of which 90 (0.818) or 88 (0.786) are shared."""
    word = [f"w{i}" for i in range(104)]
    rows = [(1, " ".join(word)), (2, " ".join(word[:94] + [f"x{i}" for i in range(10)])), (3, " ".join([f"y{i}" for i in range(12)] + word[12:]))]
    sets = {d: {tuple(w[i : i + 5]) for w in [t.split()] for i in range(100)} for d, t in rows}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert 0.81 < alike(1, 2) < 0.82 and alike(1, 3) < 0.8 and alike(2, 3) < 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = corpus_pipeline.near_duplicates(spark, docs, small_dir)
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]
    assert {x[0] for x in brute.components(rows, 5, 80) if x[0] == x[2]} == {1, 3}


def test_texts_of_a_shared_doc_id_are_told_apart(spark, small_dir):
    text = lambda c: " ".join(f"{c}{i}" for i in range(40))
    rows = [(1, text("a")), (1, text("a")), (1, text("b")), (1, text("c")), (0, text("b")), (2, text("a")), (2, text("d")), (None, text("a")), (None, text("a")), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'own' as key", "'own' as id")
    left = corpus_pipeline.near_duplicates(spark, docs, small_dir)
    assert left.columns == docs.columns
    want = [(1, text("a")), (1, text("c")), (0, text("b")), (2, text("d")), (None, text("a")), (None, text("a")), (3, None), (3, "")]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(want, key=repr)


def test_more_copies_than_may_be_broadcast(spark, small_dir, monkeypatch):
    """Where most documents go, those that stay are told by their keys: no text is shuffled, and rows without doc_id stay."""
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, text) for i in range(9)] + [(20, "one two three four five six"), (None, text), (21, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (0, 3, 100):
        monkeypatch.setattr(corpus_pipeline, "BROADCAST_IDS", most)
        kept = corpus_pipeline.near_duplicates(spark, docs, small_dir)
        assert sorted((r.doc_id for r in kept.collect()), key=repr) == [0, 20, 21, None]
    known = docs.where("doc_id is not null").selectExpr("*", "doc_id as key")
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_IDS", 3)
    plan = corpus_pipeline._without(known, "key", known.where("doc_id between 1 and 8").select("key"))
    assert "SortMergeJoin" not in plan._jdf.queryExecution().executedPlan().toString()
