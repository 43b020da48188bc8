from satlink.plans.store import VaultStore
from satlink.session import run_dir


def test_base_delta_and_incomplete_segments(spark):
    store = VaultStore(spark, run_dir(spark, "test-store"))
    assert store.read("t") is None
    store.write_base(spark.range(3), "t")
    store.write_delta(spark.range(3, 5), "t")
    assert sorted(r.id for r in store.read("t").collect()) == [0, 1, 2, 3, 4]
    # A segment without _SUCCESS (a crashed write) is invisible.
    spark.range(100, 101).write.parquet(f"{store.root}/t/00000099-delta")
    fs, p = store._fs_path(f"{store.root}/t/00000099-delta/_SUCCESS")
    fs.delete(p, False)
    assert store.read("t").count() == 5
    # A new base hides older segments; the next version number skips the broken one.
    store.write_base(spark.range(7, 8), "t")
    assert [r.id for r in store.read("t").collect()] == [7]
    assert store.segments("t")[-1][1].endswith("00000100-base")
    store.compact("t")
    assert [r.id for r in store.read("t").collect()] == [7]


def test_compact_keeps_buckets(spark):
    from pyspark.sql import functions as F
    store = VaultStore(spark, run_dir(spark, "test-compact"))
    df = spark.createDataFrame([("ab", 1), ("cd", 2)], "k string, v int").withColumn("b", F.substring("k", 1, 1))
    store.write_base(df, "t", "b")
    store.write_delta(spark.createDataFrame([("ax", 3)], "k string, v int").withColumn("b", F.substring("k", 1, 1)), "t", "b")
    store.compact("t", F.substring("k", 1, 1))
    assert [k for k, _ in store.segments("t")] == ["base"] and store.buckets("t") == {"a", "c"}
    assert sorted(r.v for r in store.read("t", {"a"}).collect()) == [1, 3]


def test_markers(spark):
    store = VaultStore(spark, run_dir(spark, "test-markers"))
    assert not store.marked("x/1")
    store.mark("x/1")
    assert store.marked("x/1")


def test_patch_replaces_only_its_buckets(spark):
    from pyspark.sql import functions as F
    store = VaultStore(spark, run_dir(spark, "test-patch"))
    base = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "b string, v int")
    store.write_base(base, "t", "b")
    store.write_delta(spark.createDataFrame([("b", 4)], "b string, v int"), "t", "b")
    store.write_patch(spark.createDataFrame([("a", 9)], "b string, v int"), "t", "b")
    assert sorted(r.v for r in store.read("t").collect()) == [3, 4, 9]
    assert sorted(r.v for r in store.read("t", {"b"}).collect()) == [3, 4]
    assert store.buckets("t") == {"a", "b"}
    assert "b" not in store.read("t").columns and F is not None


def test_vacuum_drops_only_superseded_segments(spark):
    store = VaultStore(spark, run_dir(spark, "test-vacuum"))
    store.write_base(spark.range(1), "t")
    store.write_delta(spark.range(1, 2), "t")
    store.write_base(spark.range(5, 6), "t")
    store.write_delta(spark.range(6, 7), "t")
    assert store.vacuum("t", keep_bases=2) == []
    gone = store.vacuum("t", keep_bases=1)
    assert len(gone) == 2 and all(g.endswith(("00000001-base", "00000002-delta")) for g in gone)
    assert sorted(r.id for r in store.read("t").collect()) == [5, 6]
