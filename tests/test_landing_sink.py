import pytest
from pyspark.sql import functions as F

from core_helpers import rows
from satlink.operators import pit as PIT
from satlink.session import run_dir
from satlink.sources.landing_sink import LandingSink

AT = "2025-01-05 06:07:08"


def payloads(spark, values):
    return spark.createDataFrame([(f"feed{i}", v) for i, v in enumerate(values)], "feed string, value string")


def test_a_batch_counts_once(spark):
    sink = LandingSink(spark, run_dir(spark, "test-sink"))
    assert sink.read("usgs").collect() == [] and sink.batches("usgs") == {}
    one = payloads(spark, ['{"a": 1}', "not json\nsecond line", None])
    assert sink.land(one, "usgs", AT, "run-1".replace("-", "_"), metadata={"by": F.lit("test")})
    assert not sink.land(payloads(spark, ["other"]), "usgs", AT, "run_1")
    assert sink.land(payloads(spark, ["x"]), "usgs", "2025-01-06 00:00:00", "run_2")
    got = sorted((r.landing_key, r.value, r.metadata, str(r.load_date)) for r in sink.read("usgs").collect())
    tag = {"source": "usgs"}
    assert got == [("usgs/earthquakes/feed0/20250105T060708Z.geojson.gz", '{"a": 1}', tag | {"by": "test"}, "2025-01-05"),
                   ("usgs/earthquakes/feed0/20250106T000000Z.geojson.gz", "x", tag, "2025-01-06"),
                   ("usgs/earthquakes/feed1/20250105T060708Z.geojson.gz", "not json\nsecond line", tag | {"by": "test"}, "2025-01-05"),
                   ("usgs/earthquakes/feed2/20250105T060708Z.geojson.gz", None, tag | {"by": "test"}, "2025-01-05")]
    assert sink.read("usgs", dates={"2025-01-06"}).count() == 1 and sink.read("usgs", batches={"run_1"}).count() == 3
    with pytest.raises(ValueError):
        sink.land(one, "usgs", AT, "a/b")


def test_a_lost_attempt_is_invisible_and_two_commits_count_once(spark, monkeypatch):
    sink = LandingSink(spark, run_dir(spark, "test-sink"))
    with monkeypatch.context() as m:
        m.setattr(LandingSink, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            sink.land(payloads(spark, ["a", "b"]), "usgs", AT, "b1")
    assert sink.read("usgs").count() == 0
    assert sink.land(payloads(spark, ["a", "b"]), "usgs", AT, "b1")  # the retry
    assert sorted(r.value for r in sink.read("usgs").collect()) == ["a", "b"]
    # A second writer that had not seen the marker: one of the two attempts counts, for every reader the same.
    with monkeypatch.context() as m:
        m.setattr(LandingSink, "_committed", lambda *a: None)
        assert sink.land(payloads(spark, ["a", "b"]), "usgs", AT, "b1")
    assert sorted(r.value for r in sink.read("usgs").collect()) == ["a", "b"]
    gone = sink.sweep("usgs")
    assert len(gone) == 2 and sorted(r.value for r in sink.read("usgs").collect()) == ["a", "b"]


def test_as_of_by_steps_equals_the_whole(spark):
    """Ties by order, keys that start late, a date without versions, a snapshot that is made twice."""
    data = [(k, f"2025-01-{d:02d}", d * 10 + k) for k in range(4) for d in range(1 + 3 * k, 20, 2)] + [(0, "2025-01-05", 999), (9, "2025-02-20", 1)]
    v = spark.createDataFrame(data, "k int, day string, x int").withColumn("day", F.to_date("day"))
    dates = ["2025-01-04", "2025-01-05", "2025-01-06", "2025-01-31", "2025-02-10"]
    want = PIT.pit_as_of(v, ["k"], "day", ["x"], dates, order=["day", "x"])
    have = None
    for d in dates:
        step = PIT.pit_as_of_next(have, v, ["k"], "day", ["x"], d, order=["day", "x"])
        have = step if have is None else have.unionByName(step)
    assert rows(have.select(*want.columns)) == rows(want)
    again = PIT.pit_as_of_next(have, v, ["k"], "day", ["x"], dates[-1], order=["day", "x"])
    assert rows(again.drop("day").select(*want.columns)) == rows(want.filter(F.col("snapshot_date") == F.lit(dates[-1]).cast("timestamp_ntz")))
