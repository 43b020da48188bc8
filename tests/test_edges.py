"""Edge values: empty key parts, unsigned epochs, spellings that differ in case, counted broadcast guard."""

from decimal import Decimal

from pyspark.sql import functions as F

from satlink.functions.text import try_unsigned_bigint
from satlink.operators import vault as V
from satlink.operators.joins import anti_join
from satlink.operators.load import fits_broadcast
from satlink.operators.pit import pit_article_day, pit_quake_day, quake_day
from satlink.sources.landing import landing_key


def test_landing_key_of_empty_dates(spark):
    df = spark.createDataFrame([("7", "measurements", "", None), ("7", "measurements", "2024-01-01", "")],
                               "sensor_id string, resource string, date_from string, date_to string")
    keys = [r[0] for r in df.select(landing_key("openaq", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))).collect()]
    assert [k.split("/")[4] for k in keys] == ["na_na", "2024-01-01_na"]


def test_unsigned_epoch(spark):
    texts = ["0", "18446744073709551615", "9223372036854775808", "18446744073709551616", "-1", "x", None, "1704067200000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(try_unsigned_bigint("t").alias("epoch_ms"), F.lit(1.0).alias("magnitude"))
    got = [r[0] for r in df.select("epoch_ms").collect()]
    assert got == [Decimal(0), Decimal(18446744073709551615), Decimal(9223372036854775808), None, None, None, None, Decimal(1704067200000)]
    days = [r[0] for r in df.select(quake_day("epoch_ms")).collect()]
    assert days == ["1970-01-01", None, None, None, None, None, None, "2024-01-01"]
    assert pit_quake_day(df).agg(F.sum("n_quakes")).first()[0] == 4


def test_spellings_that_differ_in_case_are_one_version(spark):
    rows = [("P", "Art", "2024010100", "all", 5), ("P", "Art", "2024010100", "ALL", 5), ("P", "Art", "2024010100", "all", 5)]
    df = spark.createDataFrame(rows, "project string, article string, ts string, access string, views int")
    nk = [F.col("project"), F.col("article"), F.col("ts")]
    build = lambda d, **o: V.build_satellite(d, {"hk_article": F.sha2("article", 256)}, nk, [F.col("access"), F.col("views").cast("string")],
                                             ["project", "ts", "access", "views"], "2025-01-01 00:00:00", **o)
    sat = build(df)
    assert sat.count() == 1 and sat.first()["access"] == "ALL" and sat.columns[-1] == "load_dt"
    named = sat.withColumnsRenamed({"project": "project_id", "ts": "ts_yyyymmddhh"})
    assert pit_article_day(named).first()["views_day"] == 5
    nulls = df.withColumn("project", F.lit(None).cast("string"))
    assert build(nulls, reject_null_keys=False).count() == 2  # without a key only equal rows collapse


def test_broadcast_is_decided_by_distinct_keys(spark):
    few = spark.range(20_000).select(F.sha2((F.col("id") % 5).cast("string"), 256).alias("k"))
    many = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
        assert fits_broadcast(few, ["k"]) and not fits_broadcast(many, ["k"])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert not fits_broadcast(few, ["k"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = anti_join(few, many, ["k"], small_left=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [k" in plan  # the broadcast side holds each key once
    assert anti_join(few, many, ["k"], small_left=True).count() == 0
