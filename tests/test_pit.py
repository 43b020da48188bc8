from datetime import datetime

from satlink.operators import pit as PIT


def test_pit_as_of_equals_brute_force(spark):
    data = [("a", datetime(2020, 1, 5), 1), ("a", datetime(2020, 3, 1), 2), ("a", datetime(2020, 3, 1), 3),
            ("b", datetime(2020, 2, 10), 4), ("c", datetime(2021, 1, 1), 5), ("a", datetime(2019, 12, 31), 0)]
    dates = ["2020-01-01", "2020-02-01", "2020-03-01", "2020-04-01"]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v int")
    got = sorted((r.k, str(r.snapshot_date)[:10], r.v)
                 for r in PIT.pit_as_of(df, ["k"], "ts", ["v"], dates, order=["ts", "v"]).collect())
    exp = []
    for d in dates:
        dd = datetime.fromisoformat(d)
        for k in {x[0] for x in data}:
            cand = [x for x in data if x[0] == k and x[1] <= dd]
            if cand:
                exp.append((k, d, max(cand, key=lambda x: (x[1], x[2]))[2]))
    assert got == sorted(exp)


def test_pit_latest_picks_newest_load(spark):
    df = spark.createDataFrame([("k", "2025-01-01", "h1", 1.0), ("k", "2025-01-02", "h0", 5.0),
                                ("j", "2025-01-01", "h9", 2.0)], "key string, load_dt string, hd_attributes string, value double")
    got = sorted(tuple(r) for r in PIT.pit_latest(df, ["key"], ["value"]).collect())
    assert got == [("j", 2.0), ("k", 5.0)]


def test_quake_day_is_utc(spark):
    df = spark.createDataFrame([(0,), (86_399_999,), (86_400_000,), (1735689600123,)], "e long")
    assert [r[0] for r in df.select(PIT.quake_day("e")).collect()] == ["1970-01-01", "1970-01-01", "1970-01-02", "2025-01-01"]
