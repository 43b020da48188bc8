import pytest
from pyspark.sql import functions as F

from satlink.operators import checks as C
from satlink.operators import vault as V
from satlink.plans.catalog import Tables, source_batch
from satlink.plans.store import VaultStore
from satlink.plans.warehouse import Warehouse
from satlink.session import run_dir
from satlink.sources import shapers as S

from core_helpers import SMALL


def test_two_batch_build_checks_and_marts(spark):
    t = Tables(spark, SMALL)
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-wh")))
    for b, ts in ((1, "2025-01-01 00:00:00"), (2, "2025-01-02 00:00:00")):
        pay = {s: fn(source_batch(t, s, b)) for s, fn in S.SHAPERS.items()}
        wh.build(pay, ts)
    checks = wh.run_checks()
    assert checks.count() > 20
    assert checks.filter(F.col("failures") > 0).count() == 0  # every hk of links/sats is in its hub
    # A day after the second load every table is fresh; ten days later none is, and the failing rows are kept.
    names = {r.test for r in checks.collect()}
    assert {"daily_views_add_up", "one_row_per_quake", "quakes_of_days_add_up", "views_are_not_negative"} <= names
    late = wh.run_checks(now="2025-01-12 00:00:00", accepted={("sat_commit_meta", "verified"): [True]}, keep_failures=True,
                         singular=[C.Singular("no_hub", ("hub_sensor",), lambda t: t["hub_sensor"].limit(3))])
    bad = {(r.model, r.test): r.failures for r in late.filter("failures > 0").collect()}
    assert bad[("hub_sensor", "no_hub")] == 3 and bad[("sat_commit_meta", "accepted_values")] == 1
    assert {m for m, test in bad if test == "freshness"} == {*V.HUBS, *V.LINKS, *V.SATELLITES}
    kept = wh.table("check_failures")
    assert kept.filter("test = 'no_hub'").count() == 3 and kept.filter("test = 'freshness' and row like '%\"status\":\"error\"%'").count() == 13
    marts = wh.marts()
    assert marts["article_traffic_daily"].count() > 0
    assert marts["population_by_country_year"].count() > 0
    for name in ("weather_daily", "air_quality_hourly", "air_quality_daily", "quakes_daily", "commits_daily"):
        assert marts[name].count() > 0, name
    # Overlapping feeds count each earthquake once.
    ids = [S.SHAPERS["usgs"](source_batch(t, "usgs", b)).select(
        F.explode(F.from_json("value", "struct<features:array<struct<id:string>>>")["features"]["id"]).alias("id")) for b in (1, 2)]
    n_quakes = ids[0].unionByName(ids[1]).distinct().count()
    assert marts["quakes_daily"].agg(F.sum("n_quakes")).first()[0] == n_quakes
    hub = wh.table("hub_article")
    assert hub.count() == hub.select(F.upper(F.trim("article_bkey"))).distinct().count()


def test_incremental_pit_equals_rebuild(spark):
    from satlink.operators import pit as PIT
    from core_helpers import rows
    t = Tables(spark, SMALL)
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-pit-merge")))
    for b, ts in ((1, "2025-01-01 00:00:00"), (2, "2025-01-02 00:00:00")):
        wh.build({s: S.SHAPERS[s](source_batch(t, s, b)) for s in ("wikimedia", "worldbank")}, ts)
    assert rows(wh.table("pit_article_day")) == rows(PIT.pit_article_day(wh.table("sat_article_views")))
    assert rows(wh.table("pit_country_indicator_year")) == rows(
        PIT.pit_country_indicator_year(wh.table("sat_country_indicator_values")))


def test_build_that_died_before_its_pits_is_made_good(spark, monkeypatch):
    from satlink.operators import pit as PIT
    from core_helpers import rows
    t = Tables(spark, SMALL)
    pay = {b: {"wikimedia": S.SHAPERS["wikimedia"](source_batch(t, "wikimedia", b))} for b in (1, 2)}
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-pit-crash")))
    wh.build(pay[1], "2025-01-01 00:00:00")
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "refresh_pits", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            wh.build(pay[2], "2025-01-02 00:00:00")
    wh.build(pay[2], "2025-01-02 00:00:00")  # the retry finds nothing new in the satellite
    want = rows(PIT.pit_article_day(wh.table("sat_article_views")))
    assert rows(wh.table("pit_article_day")) == want
    # A PIT segment without its record of what it covers is rebuilt, not merged again.
    wh.store.write_base(wh.table("pit_article_day"), "pit_article_day")
    assert wh.store.covers("pit_article_day", "sat_article_views") is None
    assert rows(wh.refresh_pits()["pit_article_day"]) == want
    before = wh.store.version("pit_article_day")
    wh.build(pay[2], "2025-01-03 00:00:00")
    assert rows(wh.table("pit_article_day")) == want and wh.store.version("pit_article_day") >= before


def test_replayed_quake_feed_counts_once_and_scratch_is_cleared(spark):
    import os
    t = Tables(spark, SMALL)
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-quakes")))
    pay = {"usgs": S.SHAPERS["usgs"](source_batch(t, "usgs", None))}
    sums = []
    for day in ("01", "02"):
        wh.build(pay, f"2025-01-{day} 00:00:00")
        sums.append(wh.table("pit_quake_day").agg(F.sum("n_quakes")).first()[0])
    assert sums[0] == sums[1] == t["events"].count()
    assert not os.path.exists(wh.store.scratch.removeprefix("file:"))


def test_marts_and_pits_are_checked_and_not_null_checks_share_a_scan(spark):
    from satlink.operators import checks as C
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {(r.model, r.column): r.failures for r in C.run_checks([
        C.Check("m", "a", "not_null", table=df), C.Check("m", "b", "not_null", table=df),
        C.Check("m", "a", "unique", C.unique(df, "a"))]).collect() if r.test == "not_null"}
    assert got == {("m", "a"): 1, ("m", "b"): 2}
    hub = df.select(F.col("b").alias("hk_article"), F.col("b").alias("article_bkey"))
    checks = C.vault_checks({"pit_article_day": hub, "weather_daily": df, "hub_article": hub})
    assert {(c.model, c.test) for c in checks} >= {("pit_article_day", "not_null"), ("weather_daily", "not_null"), ("hub_article", "unique")}
