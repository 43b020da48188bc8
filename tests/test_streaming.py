from pyspark.sql import functions as F

from satlink.operators import vault as V
from satlink.plans.store import VaultStore
from satlink.plans.warehouse import Warehouse
from satlink.session import run_dir
from satlink.sources import landing as L
from satlink.sources import shapers as S
from satlink.streaming import start_landing_loads

from core_helpers import SMALL


def test_stream_loads_only_new_files(spark):
    root = run_dir(spark, "test-stream")
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    wh = Warehouse(spark, VaultStore(spark, f"{root}/vault"))
    land = f"{root}/landing/wikimedia"
    L.land_payloads(S.wikimedia_payloads(ev.filter(F.col("ts") < "2024-01-15")), land)
    q = start_landing_loads(spark, wh, "wikimedia", land, f"{root}/ckpt", load_dt=lambda b: "2025-01-01 00:00:00")
    q.awaitTermination()
    first = wh.table("sat_article_views").count()
    L.land_payloads(S.wikimedia_payloads(ev.filter(F.col("ts") >= "2024-01-15")), land)
    q = start_landing_loads(spark, wh, "wikimedia", land, f"{root}/ckpt", load_dt=lambda b: "2025-01-02 00:00:00")
    q.awaitTermination()
    total = wh.table("sat_article_views").count()
    # Same result as one batch load of everything.
    all_rows = V.sat_article_views(__import__("satlink.operators.flatten", fromlist=["x"]).stg_wikimedia(
        S.wikimedia_payloads(ev)), "2025-01-01 00:00:00").count()
    assert 0 < first < total == all_rows
    assert wh.table("hub_article").count() == ev.select("user_id").distinct().count()
    assert wh.run_checks().filter("failures > 0").count() == 0
