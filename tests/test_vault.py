from pyspark.sql import functions as F

from satlink.operators import vault as V
from satlink.operators.load import load_satellite
from satlink.plans.store import VaultStore
from satlink.session import run_dir

from core_helpers import rows

T1, T2, T3 = "2025-01-01 00:00:00", "2025-01-02 00:00:00", "2025-01-03 00:00:00"


def stg_wiki(spark, data):
    return spark.createDataFrame(data, "project string, article string, granularity string, access string, "
                                       "agent string, ts_yyyymmddhh string, views bigint")


def test_hub_dedupes_on_standardised_key(spark):
    stg = spark.createDataFrame([("za",), (" ZA ",), ("ZA",), (None,), ("US",)], "country_iso3 string")
    hub = V.hub_country(stg.withColumn("indicator_id", F.lit("x")), T1)
    assert hub.count() == 2
    assert sorted(r.country_bkey for r in hub.collect()) == [" ZA ", "US"]
    raw = V.hub_country(stg.withColumn("indicator_id", F.lit("x")), T1, dedupe_on="raw")
    assert raw.count() == 4 and raw.select("hk_country").distinct().count() == 2


def test_link_keys_and_project_id(spark):
    stg = stg_wiki(spark, [("en ", "A", "d", "a", "g", "2025010100", 1), ("EN", "a", "d", "a", "g", "2025010101", 2),
                           (None, "A", "d", "a", "g", "2025010100", 1)])
    link = V.link_project_article(stg, T1).collect()
    assert len(link) == 1 and link[0].project_id == "EN"
    hub = V.hub_article(stg, T1).collect()
    assert link[0].hk_article == hub[0].hk_article


def _sat(spark, rows_, **kw):
    return V.sat_article_views(stg_wiki(spark, rows_), T1, **kw)


def test_satellite_append_versions(spark):
    store = VaultStore(spark, run_dir(spark, "test-append"))
    a = ("en", "A", "d", "all", "all", "2025010100", 10)
    b = ("en", "A", "d", "all", "all", "2025010100", 11)
    new = ("en", "B", "d", "all", "all", "2025010100", 5)
    load_satellite(V.sat_article_views(stg_wiki(spark, [a, a]), T1), store, "sat", "append")
    assert store.read("sat").count() == 1  # two dumps with the same row: once after dedupe
    load_satellite(V.sat_article_views(stg_wiki(spark, [a]), T2), store, "sat", "append")
    assert store.read("sat").count() == 1  # same: nothing inserted
    load_satellite(V.sat_article_views(stg_wiki(spark, [b, new]), T2), store, "sat", "append")
    assert store.read("sat").count() == 3  # changed + new
    load_satellite(V.sat_article_views(stg_wiki(spark, [a]), T3), store, "sat", "append")
    assert store.read("sat").count() == 3  # back to an old value: append compares all versions


def test_satellite_no_dedupe_keeps_copies(spark):
    a = ("en", "A", "d", "all", "all", "2025010100", 10)
    assert V.sat_article_views(stg_wiki(spark, [a, a]), T1, dedupe=False).count() == 2


def test_null_natural_key_switch(spark):
    stg = spark.createDataFrame([("ZAF", "SP.POP.TOTL", "2024M01", 1.0, "", "", "0"),
                                 ("ZAF", "SP.POP.TOTL", "2020", 2.0, "", "", "0")],
                                "country_iso3 string, indicator_id string, year string, value double, unit string, "
                                "obs_status string, decimal_places string")
    assert V.sat_country_indicator_values(stg, T1).count() == 1
    kept = V.sat_country_indicator_values(stg, T1, reject_null_keys=False)
    assert kept.count() == 2 and kept.filter(F.col("hash_natural_key").isNull()).count() == 1
    # As coded, a NULL natural key never matches NOT EXISTS: inserted again on every run.
    store = VaultStore(spark, run_dir(spark, "test-nullkey"))
    load_satellite(kept, store, "sat", "append")
    load_satellite(V.sat_country_indicator_values(stg, T2, reject_null_keys=False), store, "sat", "append")
    assert store.read("sat").filter(F.col("hash_natural_key").isNull()).count() == 2


def _weather(spark, data):
    return spark.createDataFrame(data, "lat double, lon double, ts string, temperature_2m double, "
                                       "relativehumidity_2m double")


def test_satellite_upsert_replaces_key(spark):
    store = VaultStore(spark, run_dir(spark, "test-upsert"))
    a = (1.0, 2.0, "t0", 10.0, 50.0)
    b = (1.0, 2.0, "t0", 11.0, 50.0)
    other = (1.0, 2.0, "t1", 9.0, 40.0)
    load_satellite(V.sat_weather_hourly(_weather(spark, [a, other]), T1), store, "w", "upsert")
    load_satellite(V.sat_weather_hourly(_weather(spark, [b]), T2), store, "w", "upsert")
    got = sorted((r.ts, r.temperature_2m) for r in store.read("w").collect())
    assert got == [("t0", 11.0), ("t1", 9.0)]
    load_satellite(V.sat_weather_hourly(_weather(spark, [a]), T3), store, "w", "upsert")
    got = sorted((r.ts, r.temperature_2m) for r in store.read("w").collect())
    assert got == [("t0", 10.0), ("t1", 9.0)]  # A -> B -> A is stored after an upsert
    before = rows(store.read("w").drop("load_dt"))
    load_satellite(V.sat_weather_hourly(_weather(spark, [a]), T3), store, "w", "upsert")
    assert rows(store.read("w").drop("load_dt")) == before  # replay with unique keys: no change


def test_upsert_collision_as_coded(spark):
    """Two versions of one key in a batch, one unchanged: the delete drops the unchanged one."""
    store = VaultStore(spark, run_dir(spark, "test-collide"))
    a = (1.0, 2.0, "t0", 10.0, 50.0)
    b = (1.0, 2.0, "t0", 11.0, 50.0)
    load_satellite(V.sat_weather_hourly(_weather(spark, [a]), T1), store, "w", "upsert")
    load_satellite(V.sat_weather_hourly(_weather(spark, [a, b]), T2), store, "w", "upsert")
    assert sorted(r.temperature_2m for r in store.read("w").collect()) == [11.0]


def test_location_key_uses_sql_number_text(spark):
    hub = V.hub_location(_weather(spark, [(-26.2, 28.0, "t", 1.0, 1.0), (58801927.0, 0.0001, "t", 1.0, 1.0)]), T1)
    assert sorted(r.location_bkey for r in hub.collect()) == ["-26.2|28.0", "58801927.0|0.0001"]


def test_upsert_patches_touched_buckets_only(spark):
    store = VaultStore(spark, run_dir(spark, "test-upsert-patch"))
    rows_ = [(float(i), 0.0, "t0", 1.0, 1.0) for i in range(300)]
    load_satellite(V.sat_weather_hourly(_weather(spark, rows_), T1), store, "w", "upsert")
    n_buckets = len(store.buckets("w"))
    assert n_buckets == 16
    load_satellite(V.sat_weather_hourly(_weather(spark, [(5.0, 0.0, "t0", 2.0, 1.0)]), T2), store, "w", "upsert")
    kinds = [k for k, _ in store.segments("w")]
    assert kinds == ["base", "patch"]
    got = store.read("w")
    assert got.count() == 300
    assert got.filter("temperature_2m = 2.0").count() == 1


def test_append_compare_latest_stores_return_to_old_value(spark):
    store = VaultStore(spark, run_dir(spark, "test-latest"))
    a = ("en", "A", "d", "all", "all", "2025010100", 10)
    b = ("en", "A", "d", "all", "all", "2025010100", 11)
    for rows_, ts in (([a], T1), ([b], T2), ([a], T3)):
        load_satellite(V.sat_article_views(stg_wiki(spark, rows_), ts), store, "sat", "append", compare="latest")
    assert sorted(r.views for r in store.read("sat").collect()) == [10, 10, 11]


def test_upsert_keep_batch_makes_collision_replay_safe(spark):
    store = VaultStore(spark, run_dir(spark, "test-keep"))
    a = (1.0, 2.0, "t0", 10.0, 50.0)
    b = (1.0, 2.0, "t0", 11.0, 50.0)
    load_satellite(V.sat_weather_hourly(_weather(spark, [a]), T1), store, "w", "upsert", on_collision="keep_batch")
    load_satellite(V.sat_weather_hourly(_weather(spark, [a, b]), T2), store, "w", "upsert", on_collision="keep_batch")
    assert sorted(r.temperature_2m for r in store.read("w").collect()) == [10.0, 11.0]
    load_satellite(V.sat_weather_hourly(_weather(spark, [a, b]), T3), store, "w", "upsert", on_collision="keep_batch")
    assert sorted(r.temperature_2m for r in store.read("w").collect()) == [10.0, 11.0]


def test_bucket_width_from_size():
    from satlink.operators.load import choose_bucket_chars
    assert choose_bucket_chars(10 << 20) == 1
    assert choose_bucket_chars(100 << 30) == 3
    assert choose_bucket_chars(100 << 40) == 4


def test_empty_loads_and_new_buckets(spark):
    store = VaultStore(spark, run_dir(spark, "test-empty"))
    empty = _weather(spark, [])
    table, _, _ = __import__("satlink.operators.load", fromlist=["x"]).load_satellite_delta(
        V.sat_weather_hourly(empty, T1), store, "w", "upsert", bucket_chars=2)
    assert table is None and store.read("w") is None
    a = (1.0, 2.0, "t0", 10.0, 50.0)
    load_satellite(V.sat_weather_hourly(_weather(spark, [a]), T1), store, "w", "append", bucket_chars=2)
    load_satellite(V.sat_weather_hourly(_weather(spark, [a]), T2), store, "w", "append", bucket_chars=2)  # empty delta
    others = [(float(i), 9.0, "t1", 1.0, 1.0) for i in range(40)]
    load_satellite(V.sat_weather_hourly(_weather(spark, others), T3), store, "w", "append", bucket_chars=2)
    assert store.read("w").count() == 41
    load_satellite(V.sat_weather_hourly(_weather(spark, [(7.0, 7.0, "t9", 1.0, 1.0)]), T3), store, "w", "upsert",
                   bucket_chars=2)
    assert store.read("w").count() == 42
