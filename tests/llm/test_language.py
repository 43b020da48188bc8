import numpy as np
from pyspark.sql import functions as F

from satlink.llm import language, queries


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    got = queries.op2_byte_cnn_language(spark, path).join(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert held.a >= 0.95 and held.lo >= 0 and held.hi <= 1


def test_edges(spark, frame, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text", "lang")
    net = language.fit(docs, F.lit(True))
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "é"), (4, "é"), (None, "the of and the"), (5, "the of and to in the " * 3000)]
    got = {(r.doc_id, r.text and r.text[:3]): r for r in language.predict(frame(rows, ["score", "lang_pred"]), net).collect()}
    assert [got[k].lang_pred for k in ((1, None), (2, ""), (3, "123"))] == ["und"] * 3 and got[(2, "")].score == 0
    assert got[(5, "the")].lang_pred == "en" and got[(None, "the")].lang_pred == "en" and 0 <= got[(4, "é")].score <= 1
    assert language.predict(frame([]), net).collect() == []
    assert language.fit(docs.limit(0), F.lit(True)) is None and language.predict(frame([(1, "a")]), None).first().lang_pred == "und"


def test_windows_cover_every_byte():
    data = np.random.default_rng(0).integers(1, 256, 1000).astype(np.uint8)
    offsets = np.array([0, 0, 5, 5 + language.WINDOW, 1000])
    windows, text = language.cut_windows(data, offsets)
    for i in range(4):
        joined = windows[text == i].reshape(-1)
        assert joined[: offsets[i + 1] - offsets[i]].tobytes() == data[offsets[i] : offsets[i + 1]].tobytes() and not joined[offsets[i + 1] - offsets[i] :].any()
