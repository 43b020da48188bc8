import pytest
from pyspark.sql import functions as F

from satlink.operators import flatten as FL
from satlink.session import run_dir
from satlink.sources import landing as L
from satlink.sources import shapers as S
from satlink.sources.json_scan import scan_json
from satlink.sources.registry import SourceRegistry, scan_source

from core_helpers import SMALL


def test_landed_payloads_are_gzip_and_round_trip(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    out = run_dir(spark, "test-land")
    pay = S.wikimedia_payloads(ev).withColumn("source", F.lit("wikimedia"))
    L.land_payloads(pay, out, partition_cols=["source"])
    L.land_payloads(pay, out, partition_cols=["source"])  # append: old files are kept
    scanned = scan_json(spark, f"{out}/source=wikimedia")
    paths = [r.file_path for r in scanned.select("file_path").distinct().collect()]
    assert paths and all(p.endswith(".gz") for p in paths)
    assert FL.stg_wikimedia(scanned).count() == 2 * ev.count()


def test_registry_default_and_missing(spark):
    reg = SourceRegistry().add("raw_vault", "usgs", glob="/nowhere")
    assert reg.meta("raw_vault", "usgs", "glob") == "/nowhere"
    assert reg.meta("raw_vault", "other", "glob", "dflt") == "dflt"
    assert reg.meta("raw_vault", "usgs", "missing_key", "dflt") == "dflt"
    with pytest.raises(KeyError):
        scan_source(spark, reg, "raw_vault", "other")


def test_compaction_file_count(spark):
    out = run_dir(spark, "test-compact-parquet")
    L.compact_to_parquet(spark.range(1000).repartition(8), out, files=2)
    files = [f for f in spark.read.parquet(out).inputFiles()]
    assert len(files) == 2 and spark.read.parquet(out).count() == 1000
