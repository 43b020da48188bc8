"""Satellites by period, merge-on-read, PITs of touched groups, earthquakes that move."""

import datetime as dt
import random

import pytest

from core_helpers import rows
from satlink.operators import pit as PIT
from satlink.operators import vault as V
from satlink.operators.load import NULL_BUCKET, Layout, Period, layout_of, load_satellite, load_satellite_delta
from satlink.plans.store import GONE, VaultStore
from satlink.plans.warehouse import GROUPED_PITS, Warehouse
from satlink.session import run_dir

DAYS = Period("ts", (10,))


def weather(spark, data, load_dt="2025-02-01 00:00:00", **kw):
    stg = spark.createDataFrame(data, "lat double, lon double, ts string, temperature_2m double, relativehumidity_2m double")
    return V.sat_weather_hourly(stg, load_dt, **kw)


def hours(day: str, value: float, places=range(4)):
    return [(float(p), 0.0, f"2025-01-{day}T{h:02d}:00", value + h, 50.0) for p in places for h in range(0, 24, 6)]


def commits(spark, data, load_dt):
    stg = spark.createDataFrame(data, "commit_sha string, author_name string, author_date string, committer_name string, message string, verified boolean")
    return V.sat_commit_meta(stg, load_dt)


def part_counts(store, table):
    """(kind, rows) of every segment: what each load wrote."""
    return [(k, store.spark.read.parquet(p).count() if store._leaves(p) else 0) for k, p in store.segments(table)]


@pytest.mark.parametrize("mode,kind", [("append", "delta"), ("upsert", "merge")])
def test_recent_hours_touch_only_their_period(spark, monkeypatch, mode, kind):
    store = VaultStore(spark, run_dir(spark, "test-period"))
    old = [r for d in ("01", "02", "03", "04") for r in hours(d, 1.0)]
    load_satellite(weather(spark, old), store, "w", mode, period=DAYS, on_write="merge")
    assert store.buckets("w") == {f"2025-01-0{d}." for d in (1, 2, 3, 4)}
    read, seen = VaultStore.read, []
    monkeypatch.setattr(VaultStore, "read", lambda self, table, buckets=None, as_of=None: seen.append(buckets) or read(self, table, buckets, as_of))
    new = hours("04", 2.0, range(2)) + hours("05", 3.0)
    load_satellite(weather(spark, new), store, "w", mode, period=DAYS, on_write="merge")
    assert seen[0] == {"2025-01-04.", "2025-01-05.", NULL_BUCKET}  # what the anti-join read
    assert part_counts(store, "w") == [("base", 64), (kind, len(new))]
    assert set(store._leaves(store.segments("w")[-1][1])) == {"2025-01-04.", "2025-01-05."}
    got = {(r.ts, r.temperature_2m) for r in store.read("w", {"2025-01-04."}).collect()}
    late = {(r[2], r[3]) for r in hours("04", 2.0)}
    assert late <= got and store.read("w").count() == 64 + 16 + (8 if mode == "append" else 0)


def test_spellings_of_a_key_share_a_bucket_and_odd_times_have_their_own(spark):
    layout = Layout(column="ts", width=7, chars=2, own={"2025-02": 0})
    df = spark.createDataFrame([("2025-01-03t00", "ab12"), (" 2025-01-03T00 ", "ab12"), ("2025-02-01", "cd34"), ("yesterday", "ef56"), ("2025", "0123"), ("2025-01-01", None)],
                               f"ts string, {V.HASH_NK} string")
    got = [r[0] for r in df.select(layout.bucket()).collect()]
    assert got == ["2025-01.ab", "2025-01.ab", "2025-02.", "other.ef", "other.01", None]


def test_layout_is_read_back_and_larger_periods_are_cut_finer(spark):
    store = VaultStore(spark, run_dir(spark, "test-layout"))
    small = store.write_scratch(weather(spark, hours("01", 1.0)), "w", "b")
    layout = layout_of(small, store, "w", period=Period("ts", (4, 7, 10)), target=1 << 30)
    assert (layout.width, layout.chars) == (4, 0)  # little data: years, not cut
    fine = layout_of(small, store, "w", period=Period("ts", (4, 7, 10)), target=4096)
    assert fine.width == 10  # much data for its target: days
    store.write_base(layout.deal(small), "w", "nk_bucket")
    later = store.write_scratch(weather(spark, [(float(p), 1.0, f"2026-01-01T{h:02d}", 1.0 * p, 2.0) for p in range(300) for h in range(24)]), "w", "b")
    grown = layout_of(later, store, "w", period=Period("ts", (4, 7, 10)), target=16 << 10)
    assert grown.width == 4 and grown.chars == 0 and grown.own["2026"] >= 1
    store.write_delta(grown.deal(later), "w", "nk_bucket")
    assert "2025." in store.buckets("w") and {len(b) for b in store.buckets("w") if b.startswith("2026")} == {5 + grown.own["2026"]}
    again = layout_of(later, store, "w", period=Period("ts", (4, 7, 10)), target=1 << 30)
    assert {b for b in again.touched(later)} <= store.buckets("w")
    # The same rows again: nothing is new, in whichever digits their bucket is.
    load_satellite(weather(spark, hours("01", 1.0)), store, "w", "append", period=Period("ts", (4, 7, 10)))
    assert store.read("w").count() == 16 + 7200


def test_five_upserts_write_their_rows_and_compact_to_the_same(spark):
    store, rng = VaultStore(spark, run_dir(spark, "test-five")), random.Random(4)
    truth = {}
    for n in range(6):
        batch = {f"c{i}": (f"c{i}", f"author {rng.randrange(3)}", f"2025-01-0{rng.randrange(1, 9)}", "x", "m", bool(rng.randrange(2))) for i in rng.sample(range(200), 200 if n == 0 else 25)}
        changed = {k: v for k, v in batch.items() if truth.get(k) != v}
        truth |= changed
        _, fresh, _ = load_satellite_delta(commits(spark, list(batch.values()), f"2025-02-0{n + 1} 00:00:00"), store, "c", "upsert", on_write="merge", bucket_chars=1, fold_after=99)
        if n:
            assert part_counts(store, "c")[-1] == ("merge", len(changed)) and fresh.count() == len(changed)
    columns = ["author_name", "author_date", "committer_name", "message", "verified"]
    want = sorted(v[1:] for v in truth.values())
    assert rows(store.read("c").select(*columns)) == sorted(want, key=repr)
    before = rows(store.read("c"))
    one = sorted(store.buckets("c"))[0]
    part = rows(store.read("c", {one}))
    assert store.fold("c", 2, Layout().bucket()) <= store.buckets("c") and rows(store.read("c")) == before
    store.compact("c", Layout().bucket())
    assert [k for k, _ in store.segments("c")] == ["base"]
    assert rows(store.read("c")) == before and rows(store.read("c", {one})) == part
    assert rows(store.read("c", as_of=store.version("c") - 2)) == before  # older versions stay readable


@pytest.mark.parametrize("mode,period", [("append", None), ("upsert", Period("ts", (4,)))])
def test_buckets_split_as_loads_grow(spark, mode, period):
    """Loads from tiny to large: every bucket stays under twice its size without a full compact, and keys are found again."""
    store, target, truth = VaultStore(spark, run_dir(spark, "test-split")), 24 << 10, {}
    how = {"period": period, "on_write": "merge", "bucket_bytes": target, "bucket_chars": 1 if period is None else 0}
    for n, size in enumerate((5, 400, 5000)):
        data = [(float(i), 0.0, f"2025-0{1 + i % 9}-01T00", float(n), 50.0) for i in range(size)]
        load_satellite(weather(spark, data, f"2025-02-0{n + 1} 00:00:00"), store, "w", mode, **how)
        truth |= {r[0]: r[3] for r in data}
        assert all(b < 2 * target for b in store.bucket_bytes("w").values())
        assert not any(a != b and b.startswith(a) for a in store.buckets("w") for b in store.buckets("w"))
    assert [k for k, _ in store.segments("w")].count("base") == 1 and "fold" in {k for k, _ in store.segments("w")}
    kept = store.read("w")
    assert kept.count() == (5000 if mode == "upsert" else 5 + 400 + 5000)
    if mode == "upsert":
        assert {r.temperature_2m for r in kept.select("temperature_2m").distinct().collect()} == set(truth.values())
    before = store.version("w")
    load_satellite(weather(spark, data, "2025-03-01 00:00:00"), store, "w", mode, **how)  # a replay adds nothing
    assert store.read("w").count() == kept.count() and store.buckets_since("w", before) == set()
    if mode == "upsert":  # the old state, asked for by the names of today
        assert store.read("w", store.buckets("w"), as_of=1).count() == 5


def test_loads_fold_buckets_with_many_merges(spark):
    store = VaultStore(spark, run_dir(spark, "test-fold"))
    load_satellite(weather(spark, hours("01", 0.0) + hours("02", 0.0)), store, "w", "upsert", period=DAYS, on_write="merge")
    for n in range(1, 5):
        load_satellite(weather(spark, hours("02", float(n))), store, "w", "upsert", period=DAYS, on_write="merge", fold_after=2)
        assert max(store.merges("w").values(), default=0) <= 2
    kinds = [k for k, _ in store.segments("w")]
    assert kinds == ["base", "merge", "merge", "merge", "fold", "merge"]
    assert set(store._leaves(store.segments("w")[4][1])) == {"2025-01-02."}
    assert sorted(r.temperature_2m for r in store.read("w", {"2025-01-02."}).collect()) == sorted(r[3] for r in hours("02", 4.0))
    assert store.changes_since("w", 1, ("merge",)).count() == 4 * 16  # the fold changes nothing


def test_null_keys_replace_nothing_and_deletions_of_derived_tables(spark):
    store = VaultStore(spark, run_dir(spark, "test-null-merge"))
    store.write_base(spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int"), "t")
    store.write_merge(spark.createDataFrame([(None, 9), ("a", 8)], "k string, v int"), "t", ["k"])
    assert rows(store.read("t")) == rows(spark.createDataFrame([(None, 1), (None, 9), ("a", 8), ("b", 3)], "k string, v int"))
    store.write_base(spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int"), "d")
    store.write_merge(spark.createDataFrame([(None, 9, False), ("a", None, True)], f"k string, v int, {GONE} boolean"), "d", ["k"], null_safe=True)
    assert rows(store.read("d")) == rows(spark.createDataFrame([(None, 9), ("b", 3)], "k string, v int"))
    store.write_merge(spark.createDataFrame([("a", 5, False)], f"k string, v int, {GONE} boolean"), "d", ["k"], null_safe=True)
    assert store.read("d").columns == ["k", "v"] and store.read("d").count() == 3


def check_pits(wh, names):
    for name in names:
        pit = GROUPED_PITS[name]
        assert rows(wh.table(name)) == rows(pit.build(wh.table(pit.source)).select(*wh.table(name).columns)), name


def test_weather_pit_follows_touched_days_only(spark, monkeypatch):
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-touched")))

    def load(data, load_dt):
        load_satellite(weather(spark, data, load_dt), wh.store, "sat_weather_hourly", "upsert", period=DAYS, on_write="merge")

    load([r for d in ("01", "02", "03") for r in hours(d, 1.0)], "2025-02-01 00:00:00")
    wh.refresh_pits()
    load(hours("03", 5.0, [1]) + hours("04", 1.0, [2]), "2025-02-02 00:00:00")
    seen = []
    real = Warehouse._buckets_of
    monkeypatch.setattr(Warehouse, "_buckets_of", lambda self, pit, touched: seen.append(real(self, pit, touched)) or seen[-1])
    wh.refresh_pits()
    assert seen == [{"2025-01-03.", "2025-01-04."}]
    assert part_counts(wh.store, "pit_weather_day") == [("base", 12), ("merge", 2)]
    check_pits(wh, ["pit_weather_day"])
    # A build that dies between the PIT's segment and its record: the next one is right again.
    load(hours("02", 7.0, [0]), "2025-02-03 00:00:00")
    with monkeypatch.context() as m:
        m.setattr(VaultStore, "note_covers", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            wh.refresh_pits()
    wh.refresh_pits()
    check_pits(wh, ["pit_weather_day"])
    version = wh.store.version("pit_weather_day")
    load(hours("02", 7.0, [0]), "2025-02-04 00:00:00")  # a replay
    wh.refresh_pits()
    assert wh.store.version("pit_weather_day") == version


def test_commit_that_changes_its_day_leaves_the_old_one(spark):
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-commits")))

    def load(data, load_dt):
        load_satellite(commits(spark, data, load_dt), wh.store, "sat_commit_meta", "upsert", on_write="merge")
        wh.refresh_pits()

    row = lambda sha, day, ok=True: (sha, "a", day, "c", "m", ok)
    load([row("s1", "2025-01-01T01"), row("s2", "2025-01-02T01"), row("s3", "2025-01-02T02"), row("s4", None)], "2025-02-01 00:00:00")
    load([row("s1", "2025-01-03T01"), row("s3", "2025-01-02T02", False), row("s4", "2025-01-04")], "2025-02-02 00:00:00")
    check_pits(wh, ["pit_commit_day"])
    assert {r.day: (r.n_commits, r.n_verified) for r in wh.table("pit_commit_day").collect()} == {"2025-01-02": (2, 1), "2025-01-03": (1, 1), "2025-01-04": (1, 1)}


def quakes(spark, data):
    return spark.createDataFrame(data, "feature_id string, epoch_ms long, magnitude double").selectExpr("feature_id", "cast(epoch_ms as decimal(20,0)) as epoch_ms", "magnitude")


def test_moved_quake_corrects_both_days_and_replay_changes_nothing(spark):
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-moved")))
    day = lambda d: int(dt.datetime(2025, 1, d, tzinfo=dt.timezone.utc).timestamp() * 1000)

    def load(data, load_dt):
        wh._load_quakes(quakes(spark, data), load_dt)
        wh.refresh_pits()
        return {r.day: (r.n_quakes, r.max_magnitude) for r in wh.table("pit_quake_day").collect()}

    first = [(f"q{i}", day(1 + i % 4), float(i)) for i in range(12)] + [(None, day(1), 0.5), (None, day(1), 0.5)]
    load(first, "2025-02-01 00:00:00")
    got = load([("q8", day(2), 9.5)], "2025-02-02 00:00:00")  # the greatest of day 1 moves to day 2
    assert got == {"2025-01-01": (3, 4.0), "2025-01-02": (4, 9.5), "2025-01-03": (3, 10.0), "2025-01-04": (3, 11.0)}
    assert part_counts(wh.store, "pit_quake_day") == [("base", 4), ("merge", 2)] and part_counts(wh.store, "quakes")[-1] == ("merge", 1)
    version = wh.store.version("pit_quake_day")
    assert load([("q8", day(2), 9.5)], "2025-02-02 00:00:00") == got and part_counts(wh.store, "quakes")[-1] == ("merge", 0)
    assert load(first, "2025-02-01 00:00:00") == got  # an older feed that comes late
    assert wh.store.version("pit_quake_day") == version
    assert load([("q3", day(1), 3.0)], "2025-02-03 00:00:00")["2025-01-04"] == (2, 11.0)
    check_pits(wh, ["pit_quake_day"])
    only = load([("q3", day(9), 3.0)], "2025-02-04 00:00:00")
    assert only["2025-01-09"] == (1, 3.0) and only["2025-01-01"] == (3, 4.0)


def test_merged_pits_write_the_groups_of_the_batch(spark):
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "test-merged-pit")))
    stg = lambda data: spark.createDataFrame(data, "project string, article string, granularity string, access string, agent string, ts_yyyymmddhh string, views bigint")
    row = lambda a, h, v: ("en", a, "d", "all", "all", f"20250101{h:02d}", v)
    for n, data in enumerate(([row(a, h, 1) for a in "abcdef" for h in range(3)], [row("a", 5, 7), row("g", 0, 1)], [row("a", 5, 7)])):
        load_satellite(V.sat_article_views(stg(data), f"2025-02-0{n + 1} 00:00:00"), wh.store, "sat_article_views", "append", period=Period("ts_yyyymmddhh", (8,)))
        wh.refresh_pits()
    assert part_counts(wh.store, "pit_article_day") == [("base", 6), ("merge", 2)]
    assert rows(wh.table("pit_article_day")) == rows(PIT.pit_article_day(wh.table("sat_article_views")))
    wh.store.compact("sat_article_views", Layout(column="ts_yyyymmddhh", width=8, chars=0).bucket())
    wh.refresh_pits()  # compaction changes no rows
    assert [k for k, _ in wh.store.segments("pit_article_day")] == ["base", "merge"]
