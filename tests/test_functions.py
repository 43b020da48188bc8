import random

from pyspark.sql import functions as F
from urllib.parse import quote

from satlink.functions import (double_text, hash_diff, hash_key, hash_key_composite, try_bigint,
                               try_double, try_int, try_unsigned_bigint, url_encode_segment, utc_stamp)


def test_double_text_matches_sql_cast(spark, duck):
    random.seed(7)
    vals = [58801927.0, 0.0001, 1e20, 1.5, -0.0, 0.0, 123456.78, 1e-5, 12345678.9, 1e16, 0.00012345,
            473274.17, 0.1, 1e7, 1e-3, float("nan"), float("inf"), float("-inf")]
    vals += [random.uniform(-1e9, 1e9) for _ in range(300)]
    vals += [random.uniform(-1, 1) * 10 ** random.randint(-4, 15) for _ in range(300)]
    vals += [round(random.uniform(0, 500000), 2) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.t for r in df.select("i", double_text("v").alias("t")).collect()}
    duck.execute("create or replace temp table dt_vals (i int, v double)")
    duck.executemany("insert into dt_vals values (?, ?)", list(enumerate(vals)))
    exp = dict(duck.execute("select i, cast(v as varchar) from dt_vals").fetchall())
    assert {i: got[i] for i in exp} == exp


def test_tolerant_casts_match_sql(spark, duck):
    texts = ["2020", "3.7", "1.9", "2.5", "-2.5", "0.5", "1e3", "abc", "", " 7 ", "2024M01",
             "99999999999", "1d", "2f", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", try_int("t").alias("i"), try_bigint("t").alias("b"),
                       try_double("t").alias("d")).collect():
        exp = duck.execute("select try_cast(?::varchar as int), try_cast(?::varchar as bigint), "
                           "try_cast(?::varchar as double)", [r.t] * 3).fetchone()
        assert (r.i, r.b, r.d) == exp, r.t


def test_unsigned_rejects_negative(spark):
    df = spark.createDataFrame([("1735689600123",), ("-5",), ("x",)], "t string")
    assert [r[0] for r in df.select(try_unsigned_bigint("t")).collect()] == [1735689600123, None, None]


def test_hash_key_semantics(spark):
    df = spark.createDataFrame([(" za ", "a"), ("ZA", None), (None, "b")], "k string, j string")
    out = df.select(hash_key("k").alias("h"), hash_key_composite(["k", "j"]).alias("c"),
                    hash_diff([F.col("k"), F.col("j")]).alias("d")).collect()
    assert out[0].h == out[1].h and len(out[0].h) == 64 and out[0].h == out[0].h.lower()
    assert out[2].h is None
    assert out[1].c is None and out[2].c is None  # any NULL part -> NULL key
    assert all(r.d is not None for r in out)  # diff never NULL


def test_url_encoding_equals_python_quote(spark):
    names = ["Nelson_Mandela", "A/B C*D~E", "O'Hara (film)", "Zürich+Köln", "a&b=c?d#e"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for r in df.select("n", url_encode_segment("n").alias("e")).collect():
        assert r.e == quote(r.n, safe="")


def test_utc_stamp(spark):
    df = spark.createDataFrame([("2025-01-02 03:04:05",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert df.select(utc_stamp("t")).first()[0] == "20250102T030405Z"


def test_ntz_text_ignores_session_zone(spark):
    from satlink.functions import ntz_text
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        assert df.select(ntz_text("t", "yyyyMMddHH"), utc_stamp("t")).first() == ("2024031002", "20240310T023000Z")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
