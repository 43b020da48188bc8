"""What keeps loads and PITs in proportion to their input: payloads written and parsed once, few
distinct keys before their texts, narrow shuffles, no join for rows that nothing can replace."""

from pyspark.sql import functions as F

from core_helpers import SMALL, rows
from satlink.operators import vault as V
from satlink.operators.load import Layout, Period, fits_broadcast, load_satellite, new_rows, packed, unpacked
from satlink.plans import catalog
from satlink.plans.store import VaultStore
from satlink.plans.warehouse import Warehouse
from satlink.sources import shapers as S


def plan(df, executed=True):
    q = df._jdf.queryExecution()
    return (q.executedPlan() if executed else q.optimizedPlan()).toString()


def test_hub_location_writes_and_parses_a_payload_once(spark):
    text = plan(catalog.queries()["hub_location"](spark, SMALL), executed=False)
    assert text.count("StructsToJsonEvaluator") == 1 and text.count("from_json") == 1


def test_hubs_of_few_keys_hash_aggregate_them_first(spark):
    for name in ("hub_location", "hub_sensor"):
        assert "HashAggregate" in plan(catalog.queries()[name](spark, SMALL)).replace("ObjectHashAggregate", "")


def test_pages_collect_columns_not_records(spark):
    t = catalog.Tables(spark, SMALL)
    for df in (S.openaq_payloads(t["lineitem"]), S.github_payloads(t["orders"]), S.wikimedia_payloads(t["events"])):
        collected = [line for line in plan(df).split("\n") if "partial_collect_list" in line]
        assert collected and not any(c in line for line in collected for c in ("sha2", "latitude", "granularity"))


def test_satellite_shuffles_texts_and_keeps_the_smallest_row(spark):
    df = spark.createDataFrame([("A|B", "C", 1), ("A", "B|C", 2), ("a", "b|c", 3)], "p string, q string, x int")
    build = lambda **kw: V.build_satellite(
        df, kw.pop("parents", {}), [F.col("p"), F.col("q")], [F.lit("same")], ["x"], "2025-01-01 00:00:00", **kw)
    new, plain = build(parent_keys={"hk_p": F.col("p")}), build(parents={"hk_p": F.sha2(F.upper(F.trim("p")), 256)})
    assert new.columns == plain.columns and rows(new) == rows(plain) and new.count() == 1
    below = plan(V.sat_sensor_measurements(catalog.staged(catalog.Tables(spark, SMALL), "openaq"), "2025-01-01 00:00:00")).split("Exchange")[1:]
    assert not any("sha2(" in part for part in below)


def test_rows_of_the_newest_merge_enter_no_join(spark, tmp_path):
    store = VaultStore(spark, str(tmp_path))
    frame = lambda *r: spark.createDataFrame(r, "k string, v int, b string")
    store.write_base(frame(("k1", 1, "x")), "t", "b")
    store.write_merge(frame(("k2", 2, "y")), "t", ["k"], "b")
    assert "Join" not in plan(store.read("t"))
    store.write_merge(frame(("k1", 3, "x"), ("k2", 4, "y")), "t", ["k"], "b")
    assert rows(store.read("t").select("k", "v")) == [("k1", 3), ("k2", 4)]


def test_hashes_are_packed_and_other_texts_kept(spark):
    h = "0123456789abcdef" * 4
    df = spark.createDataFrame([(h, h, None, "x"), ("k1", h.upper(), h + "\n", h), ("", "é" * 16, "x" * 32, "")],
                               "hash_natural_key string, hd_attributes string, hk_a string, nk_bucket string")
    assert rows(unpacked(packed(df), df)) == rows(df)
    assert sorted(len(r[0]) for r in packed(df).collect()) == [32, 33, 35]


def test_upsert_without_null_keys_is_one_join(spark, tmp_path):
    df = spark.createDataFrame([("k1", "a"), ("k2", "b")], "hash_natural_key string, hd_attributes string")
    fresh = new_rows(df, df.filter("hash_natural_key = 'k1'"), "upsert", null_keys=False)
    assert plan(fresh, executed=False).count("Join") == 1 and rows(fresh) == [("k2", "b")]
    store = VaultStore(spark, str(tmp_path))
    with_null = df.unionByName(df.limit(1).withColumn("hash_natural_key", F.lit(None).cast("string")))
    load_satellite(with_null, store, "s", "upsert")
    got = load_satellite(df.withColumn("hd_attributes", F.lit("c")), store, "s", "upsert", on_write="merge")
    assert rows(got.select("hash_natural_key", "hd_attributes")) == [("k1", "c"), ("k2", "c"), (None, "a")]


def test_far_too_many_keys_are_not_shuffled_to_be_counted(spark):
    assert not fits_broadcast(spark.range(1_000_000).withColumnRenamed("id", "k"), ["k"])
    assert fits_broadcast(spark.range(1_000_000).select((F.col("id") % 3).alias("k")), ["k"])


def test_pit_refresh_gives_the_same_with_and_without_broadcast(spark, tmp_path):
    t = catalog.Tables(spark, SMALL)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    got = []
    try:
        for n, threshold in enumerate((limit, "-1")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            wh = Warehouse(spark, VaultStore(spark, str(tmp_path / str(n))))
            for batch, load_dt in ((1, "2025-01-01 00:00:00"), (2, "2025-01-02 00:00:00")):
                wh.build({"openaq": S.SHAPERS["openaq"](catalog.source_batch(t, "openaq", batch))}, load_dt)
            got.append(rows(wh.table("pit_sensor_day")))
            sat = wh.table("sat_sensor_measurements")
            from satlink.operators.pit import pit_sensor
            assert rows(pit_sensor(sat, "day").select(*wh.table("pit_sensor_day").columns)) == got[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got[0] == got[1]


def test_hashes_are_made_when_rows_enter_the_table(spark, tmp_path):
    """Batches of texts give the tables that batches of hashes give, by broadcast and by shuffles, new, altered and replayed."""
    schema = "sensor_id long, parameter string, unit string, date_utc string, value double, lat double, lon double"
    at = lambda n, value: [(i % 7, f"p{i % 3}", "u", f"2026-01-{1 + i % 28:02d}T00:00:00Z", value + i, 1.0, None) for i in range(n)]
    batches = [at(100, 0.0), at(60, 0.0)[:50] + at(90, 5.0)[50:], at(100, 0.0)[:60], at(30, 9.0) + [(1, None, "u", "2026-01-02T00:00:00Z", 1.0, 1.0, 1.0)]]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (limit, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            for mode, reject in (("upsert", True), ("append", True), ("upsert", False), ("append", False)):
                got = []
                for hashed in (True, False):
                    store = VaultStore(spark, str(tmp_path / f"{threshold}-{mode}-{reject}-{hashed}"))
                    for n, data in enumerate(batches if reject else batches[::3]):
                        batch = V.sat_sensor_measurements(spark.createDataFrame(data, schema), f"2026-02-0{n + 1} 00:00:00", hashed=hashed, reject_null_keys=reject)
                        out = load_satellite(batch, store, "s", mode, period=Period("date_utc", (4, 7, 10, 13)), on_write="merge")
                    got.append((out.columns, rows(out), store.buckets("s")))
                assert got[0] == got[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    batch = V.sat_sensor_measurements(spark.createDataFrame(batches[0], schema), "2026-02-01 00:00:00", hashed=False)
    kept = VaultStore(spark, str(tmp_path / "x")).write_scratch(batch, "s", "batch")
    assert kept.select("hash_natural_key").first()[0].count("|") == 2
    above, below = plan(Layout(column="date_utc", width=4, chars=0).deal(kept), executed=False).split("RebalancePartitions")
    assert "sha2(" in above and "sha2(" not in below


def test_one_merge_is_read_by_one_join(spark, tmp_path):
    store = VaultStore(spark, str(tmp_path))
    frame = lambda *r: spark.createDataFrame(r, "hash_natural_key string, v int, b string")
    h = ["%064x" % i for i in range(4)]
    store.write_base(frame((h[0], 1, "x"), (h[1], 2, "x"), (None, 3, "x"), ("no hash", 4, "x"), ("other", 5, "x")), "t", "b")
    store.write_merge(frame((h[1], 20, "x"), (h[2], 30, "x"), (h[2], 31, "x"), (None, 33, "x"), ("no hash", 40, "x")), "t", ["hash_natural_key"], "b")
    read = store.read("t").select("hash_natural_key", "v")
    assert "Aggregate" not in plan(read) and "sha2" not in plan(read)
    assert sorted(rows(read), key=repr) == sorted([(h[0], 1), (h[1], 20), (h[2], 30), (h[2], 31), (None, 3), (None, 33), ("no hash", 40), ("other", 5)], key=repr)


def test_times_in_payloads_are_made_once(spark):
    t = catalog.Tables(spark, SMALL)
    for shaped in (S.openmeteo_payloads(t["lineitem"]), S.openaq_payloads(t["lineitem"])):
        text = plan(shaped)
        assert text.count("l_shipdate as string)") + text.count("l_shipdate as timestamp_ntz) as string)") <= 1
