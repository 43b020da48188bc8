"""Registered queries over the driver tables, each with its equivalent DuckDB SQL.

Every query reads the given tables (whole), shapes them into API payloads where a source
is needed, and runs the library operator on them. Computed columns carry the same alias
on both sides. ``load_dt`` never appears in compared output (it is a literal per batch).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlink.functions import keys as K
from satlink.functions import text as T
from satlink.operators import checks as C
from satlink.operators import flatten as FL
from satlink.operators import marts as M
from satlink.operators import pit as PIT
from satlink.operators import vault as V
from satlink.operators.joins import null_aware_anti_join
from satlink.operators.load import Period, load_satellite
from satlink.plans import oracle as O
from satlink.plans.store import COMPRESSION, VaultStore, materialize
from satlink.plans.warehouse import Warehouse
from satlink.session import run_dir
from satlink.sources import landing as L
from satlink.sources import shapers as S
from satlink.sources.landing_sink import LandingSink
from satlink.sources.json_scan import is_valid_json, scan_json, scan_parquet
from satlink.sources.registry import SourceRegistry, scan_source

LOAD_DT_1 = "2025-01-01 00:00:00"
LOAD_DT_2 = "2025-01-02 00:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables(dict):
    """Lazy map name -> DataFrame over ``<sf_dir>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __missing__(self, name: str) -> DataFrame:
        df = scan_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        self[name] = df
        return df


# ---------------------------------------------------------------------------------------
# Batches: batch 1 is the older part of a table, batch 2 overlaps it and alters values.
# ---------------------------------------------------------------------------------------

def source_batch(t: Tables, source: str, batch: int | None) -> dict[str, DataFrame]:
    """Input tables of ``source`` for batch 1, 2 or (None) everything."""
    ev, od, li = t["events"], t["orders"], t["lineitem"]
    if batch == 1:
        ev = ev.filter(F.col("ts") < F.lit(O.EVENTS_CUT_1).cast("timestamp_ntz"))
        od = od.filter(F.col("o_orderdate") < F.lit(O.ORDERS_CUT_1).cast("timestamp_ntz"))
        li = li.filter(F.col("l_shipdate") < F.lit(O.LINEITEM_CUT_1).cast("timestamp_ntz"))
    elif batch == 2:
        ev = (ev.filter(F.col("ts") >= F.lit(O.EVENTS_CUT_2).cast("timestamp_ntz"))
              .withColumn("value", F.col("value") * F.lit(1.1)))
        od = (od.filter(F.col("o_orderdate") >= F.lit(O.ORDERS_CUT_2).cast("timestamp_ntz"))
              .withColumn("o_totalprice", F.col("o_totalprice") * F.lit(1.01))
              .withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", F.lit("F"))
                          .otherwise(F.col("o_orderstatus"))))
        li = (li.filter(F.col("l_shipdate") >= F.lit(O.LINEITEM_CUT_2).cast("timestamp_ntz"))
              .withColumn("l_quantity", F.col("l_quantity") + F.col("l_tax")))
    return {"events": ev, "orders": od, "lineitem": li, "customer": t["customer"], "nation": t["nation"]}


def staged(t: Tables, source: str, batch: int | None = None) -> DataFrame:
    return FL.FLATTENERS[source](S.SHAPERS[source](source_batch(t, source, batch)))


def _no_load_dt(df: DataFrame) -> DataFrame:
    return df.drop("load_dt")


# ---------------------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------------------

def _stg(source: str):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        stg = staged(Tables(spark, sf_dir), source)
        # The unsigned epoch is a DECIMAL(20,0); event times fit a bigint.
        return stg.withColumn("epoch_ms", F.col("epoch_ms").cast("bigint")) if source == "usgs" else stg
    return q


def q_scan_json_roundtrip(spark, sf_dir):
    """Shape -> land as gzip JSON lines -> scan back -> flatten (wikimedia)."""
    t = Tables(spark, sf_dir)
    out = run_dir(spark, "landing")
    pay = S.wikimedia_payloads(t["events"]).withColumn("source", F.lit("wikimedia"))
    L.land_payloads(pay, out, partition_cols=["source"])
    return FL.stg_wikimedia(scan_json(spark, f"{out}/source=wikimedia"))


def q_compact_parquet(spark, sf_dir):
    """Shape -> flatten -> compact to Parquet -> read back (openaq)."""
    t = Tables(spark, sf_dir)
    out = run_dir(spark, "compact")
    L.compact_to_parquet(staged(t, "openaq"), out)
    return spark.read.parquet(out)


def q_src_registry_scan(spark, sf_dir):
    """Land usgs payloads, register the landing root, scan through the registry, flatten."""
    t = Tables(spark, sf_dir)
    root = run_dir(spark, "registry")
    L.land_payloads(S.usgs_payloads(t["events"]), f"{root}/usgs")
    reg = SourceRegistry.for_landing(root)
    return FL.stg_usgs(scan_source(spark, reg, "raw_vault", "usgs")).withColumn("epoch_ms", F.col("epoch_ms").cast("bigint"))


def q_filter_valid_json(spark, sf_dir):
    """events.props, with the text of every error event cut short; keep the valid ones."""
    ev = Tables(spark, sf_dir)["events"]
    txt = (F.when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)"))
           .otherwise(F.col("props")))
    return ev.select("event_id", txt.alias("payload")).filter(is_valid_json("payload"))


def q_explode_list(spark, sf_dir):
    e = Tables(spark, sf_dir)["embeddings"]
    j = e.select("vec_id", F.to_json(F.col("embedding").cast("array<double>")).alias("js"))
    return FL.explode_path(j, "js", "double", alias="x", keep=["vec_id"])


def q_zip_explode(spark, sf_dir):
    e = Tables(spark, sf_dir)["embeddings"]
    emb = F.col("embedding").cast("array<double>")
    return FL.zip_explode(e, {"a": emb, "b": F.slice(emb, 1, 40)}, keep=["vec_id"])


def q_hash_key(spark, sf_dir):
    c = Tables(spark, sf_dir)["customer"]
    return c.select("c_custkey", K.hash_key("c_name").alias("hk_name"), K.hash_key("c_mktsegment").alias("hk_segment"))


def q_hash_key_composite(spark, sf_dir):
    o = Tables(spark, sf_dir)["orders"]
    return o.select("o_orderkey", K.hash_key_composite([F.col("o_orderpriority"), F.col("o_orderstatus"),
                                                       F.col("o_custkey").cast("string")]).alias("hk_composite"))


def q_hash_diff(spark, sf_dir):
    o = Tables(spark, sf_dir)["orders"]
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return o.select("o_orderkey", K.hash_diff([T.double_text("o_totalprice"), status,
                                               F.col("o_orderpriority")]).alias("hd_attributes"))


def q_double_text(spark, sf_dir):
    li = Tables(spark, sf_dir)["lineitem"]
    return li.select("l_orderkey", "l_linenumber",
                     T.double_text("l_extendedprice").alias("price_text"),
                     T.double_text(F.col("l_discount") / F.lit(100.0)).alias("small_text"),
                     T.double_text(F.col("l_extendedprice") * F.lit(1000.0)).alias("big_text"))


def _hub(name: str):
    fn, src = V.HUBS[name]

    def q(spark, sf_dir):
        return _no_load_dt(fn(staged(Tables(spark, sf_dir), src), LOAD_DT_1))
    return q


def _link(name: str):
    fn, src = V.LINKS[name]

    def q(spark, sf_dir):
        return _no_load_dt(fn(staged(Tables(spark, sf_dir), src), LOAD_DT_1))
    return q


def two_loads(spark, sf_dir, sat: str, mode: str | None = None) -> DataFrame:
    """Batch 1 then batch 2 into a fresh store; the satellite as stored afterwards."""
    fn, src, default_mode = V.SATELLITES[sat]
    mode = mode or default_mode
    t = Tables(spark, sf_dir)
    store = VaultStore(spark, run_dir(spark, "vault"))
    how = {"period": Period(*V.PERIODS[sat]) if sat in V.PERIODS else None, "on_write": "merge"}
    load_satellite(fn(staged(t, src, 1), LOAD_DT_1, hashed=False), store, sat, mode, **how)
    return load_satellite(fn(staged(t, src, 2), LOAD_DT_2, hashed=False), store, sat, mode, **how)


def _sat(sat: str, mode: str | None = None):
    def q(spark, sf_dir):
        return _no_load_dt(two_loads(spark, sf_dir, sat, mode))
    return q


def q_not_in_null_aware(spark, sf_dir):
    """(k, d) NOT IN target, where both sides carry NULL keys.

    k = market segment (NULL for the households of nations 0-9 in the target and for the
    building segment in the batch), d = nation and balance band.
    """
    c = Tables(spark, sf_dir)["customer"]
    d = F.concat(F.col("c_nationkey").cast("string"), F.lit(":"),
                 F.floor(F.col("c_acctbal") / F.lit(1000)).cast("int").cast("string"))
    seg = F.col("c_mktsegment")
    k_t = F.when(~((F.col("c_nationkey") < 10) & (seg == "HOUSEHOLD")), seg)
    target = c.filter(seg.isin(O.NOT_IN_TARGET_SEGMENTS)).select(k_t.alias("k"), d.alias("d"))
    k_n = F.when(seg != "BUILDING", seg)
    new = c.filter(seg.isin(O.NOT_IN_BATCH_SEGMENTS)).select("c_custkey", k_n.alias("k"), d.alias("d"))
    return null_aware_anti_join(new, target, ["k", "d"], non_null=["d"])


def _first_load(spark, sf_dir, sat: str) -> DataFrame:
    fn, src, _ = V.SATELLITES[sat]
    return fn(staged(Tables(spark, sf_dir), src), LOAD_DT_1)


def q_pit_article_day(spark, sf_dir):
    return PIT.pit_article_day(_first_load(spark, sf_dir, "sat_article_views"))


def q_pit_country_indicator_year(spark, sf_dir):
    return PIT.pit_country_indicator_year(_first_load(spark, sf_dir, "sat_country_indicator_values"))


def q_pit_latest_version(spark, sf_dir):
    sat = two_loads(spark, sf_dir, "sat_country_indicator_values")
    return PIT.pit_latest(sat, ["hk_country", "hk_indicator", "year"], ["value", "unit", "obs_status", "decimal_places"])


def q_pit_as_of(spark, sf_dir):
    """Newest order per customer at each of 12 half-year snapshot dates."""
    o = Tables(spark, sf_dir)["orders"]
    df = PIT.pit_as_of(o, ["o_custkey"], "o_orderdate", ["o_orderkey", "o_totalprice", "o_orderstatus"],
                       O.AS_OF_DATES, order=["o_orderdate", "o_orderkey"])
    return df.withColumn("snapshot_date", T.ntz_text("snapshot_date", "yyyy-MM-dd"))


def q_pit_as_of_incremental(spark, sf_dir):
    """The same snapshots, each made from the one before and the orders since, and stored."""
    o = Tables(spark, sf_dir)["orders"]
    store = VaultStore(spark, run_dir(spark, "vault"))
    order = ["o_orderdate", "o_orderkey"]
    for d in sorted(O.AS_OF_DATES):
        rows = PIT.pit_as_of_next(store.read("pit_orders"), o, ["o_custkey"], "o_orderdate",
                                  ["o_orderkey", "o_totalprice", "o_orderstatus"], d, order=order)
        store.write_delta(rows, "pit_orders")
    return (store.read("pit_orders").drop("o_orderdate")
            .withColumn("snapshot_date", T.ntz_text("snapshot_date", "yyyy-MM-dd")))


def q_landing_sink(spark, sf_dir):
    """Pageviews landed in three batches, one of them twice and one after an attempt that died; read back and flattened."""
    t = Tables(spark, sf_dir)
    sink = LandingSink(spark, run_dir(spark, "landing"))
    key = F.concat(F.lit("wikimedia/"), F.sha2("value", 256))
    for n in (0, 1, 2, 1):
        pay = S.wikimedia_payloads(t["events"].filter(F.pmod("user_id", F.lit(3)) == n))
        if n == 2:  # an attempt without its marker is not read
            pay.select(key.alias("landing_key"), "value").write.parquet(f"{sink.root}/wikimedia/load_date={LOAD_DT_1[:10]}/b2-died")
        sink.land(pay, "wikimedia", LOAD_DT_1, f"b{n}", key=key)
    return FL.stg_wikimedia(sink.read("wikimedia"))


def q_pit_weather_day(spark, sf_dir):
    return PIT.pit_weather_day(_first_load(spark, sf_dir, "sat_weather_hourly"))


def q_pit_sensor_hour(spark, sf_dir):
    return PIT.pit_sensor(_first_load(spark, sf_dir, "sat_sensor_measurements"), "hour")


def q_pit_sensor_day(spark, sf_dir):
    return PIT.pit_sensor(_first_load(spark, sf_dir, "sat_sensor_measurements"), "day")


def q_pit_quake_day(spark, sf_dir):
    return PIT.pit_quake_day(staged(Tables(spark, sf_dir), "usgs"))


def q_pit_commit_day(spark, sf_dir):
    return PIT.pit_commit_day(_first_load(spark, sf_dir, "sat_commit_meta"))


def stage_once(spark, df: DataFrame, label: str) -> DataFrame:
    """Write a staging result once so several consumers read files instead of re-parsing."""
    out = run_dir(spark, f"stage-{label}")
    df.write.option("compression", COMPRESSION).parquet(out)
    return spark.read.parquet(out)


def q_mart_article_traffic_daily(spark, sf_dir):
    stg = stage_once(spark, staged(Tables(spark, sf_dir), "wikimedia"), "wikimedia")
    sat = V.sat_article_views(stg, LOAD_DT_1)
    return M.article_traffic_daily(V.hub_article(stg, LOAD_DT_1), V.link_project_article(stg, LOAD_DT_1),
                                   PIT.pit_article_day(sat))


def q_mart_population_by_country_year(spark, sf_dir):
    stg = stage_once(spark, staged(Tables(spark, sf_dir), "worldbank"), "worldbank")
    sat = V.sat_country_indicator_values(stg, LOAD_DT_1)
    return M.population_by_country_year(V.hub_country(stg, LOAD_DT_1), V.hub_indicator(stg, LOAD_DT_1),
                                        PIT.pit_country_indicator_year(sat))


def q_mart_weather_daily(spark, sf_dir):
    stg = stage_once(spark, staged(Tables(spark, sf_dir), "openmeteo"), "openmeteo")
    return M.weather_daily(V.hub_location(stg, LOAD_DT_1), PIT.pit_weather_day(V.sat_weather_hourly(stg, LOAD_DT_1)))


def _mart_air_quality(grain: str):
    def q(spark, sf_dir):
        stg = stage_once(spark, staged(Tables(spark, sf_dir), "openaq"), "openaq")
        return M.air_quality(V.hub_sensor(stg, LOAD_DT_1), PIT.pit_sensor(V.sat_sensor_measurements(stg, LOAD_DT_1), grain))
    return q


def two_builds(spark, sf_dir, source: str) -> Warehouse:
    """A fresh warehouse that has built batch 1 and then batch 2 of one source."""
    t = Tables(spark, sf_dir)
    wh = Warehouse(spark, VaultStore(spark, run_dir(spark, "warehouse")))
    for batch, load_dt in ((1, LOAD_DT_1), (2, LOAD_DT_2)):
        wh.build({source: S.SHAPERS[source](source_batch(t, source, batch))}, load_dt)
    return wh


def q_mart_quakes_daily(spark, sf_dir):
    return two_builds(spark, sf_dir, "usgs").marts()["quakes_daily"]


def q_mart_commits_daily(spark, sf_dir):
    return two_builds(spark, sf_dir, "github").marts()["commits_daily"]


def q_pit_article_day_incremental(spark, sf_dir):
    """The PIT after two builds, the second merged from the appended rows."""
    return two_builds(spark, sf_dir, "wikimedia").table("pit_article_day")


def q_pit_weather_day_incremental(spark, sf_dir):
    """The PIT after two builds, the second computed anew for the touched days only."""
    return two_builds(spark, sf_dir, "openmeteo").table("pit_weather_day")


def q_materialize_view(spark, sf_dir):
    hub = V.hub_article(staged(Tables(spark, sf_dir), "wikimedia"), LOAD_DT_1)
    materialize(hub, "hub_article_view", "view")
    return _no_load_dt(spark.table("hub_article_view"))


def q_materialize_table(spark, sf_dir):
    store = VaultStore(spark, run_dir(spark, "vault"))
    materialize(V.hub_article(staged(Tables(spark, sf_dir), "wikimedia"), LOAD_DT_1), "hub_article", "table", store)
    return _no_load_dt(store.read("hub_article"))


def q_dq_run_checks(spark, sf_dir):
    """One summary row per data test over orders, customer and lineitem."""
    t = Tables(spark, sf_dir)
    c = t["customer"].select("c_custkey", _segment_null(t["customer"]).alias("segment"))
    o, li = t["orders"], t["lineitem"]
    kept = t["customer"].filter(F.col("c_mktsegment") != "BUILDING")
    late = li.join(o, li["l_orderkey"] == o["o_orderkey"]).filter(F.col("l_shipdate") < F.col("o_orderdate"))
    return C.run_checks([
        C.Check("customer", "c_custkey", "not_null", table=c),
        C.Check("customer", "segment", "not_null", table=c),
        C.Check("orders", "o_custkey", "unique", C.unique(o, "o_custkey")),
        C.Check("orders", "o_custkey", "relationships", C.relationships(o, "o_custkey", kept, "c_custkey")),
        C.Check("orders", "o_orderpriority", "accepted_values", C.accepted_values(o, "o_orderpriority", O.ACCEPTED_PRIORITIES)),
        C.Check("lineitem", "l_shipdate", "singular", C.singular(late)),
    ])


def _orders_with_missing_customers(t: Tables):
    """Orders, and customers minus the BUILDING segment: orders of those become orphans."""
    cust = t["customer"].filter(F.col("c_mktsegment") != "BUILDING")
    return t["orders"], cust


def q_dq_not_null(spark, sf_dir):
    c = Tables(spark, sf_dir)["customer"]
    seg = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment")
    return C.not_null(c.select("c_custkey", seg), "segment")


def q_dq_unique(spark, sf_dir):
    stg = staged(Tables(spark, sf_dir), "wikimedia")
    return C.unique(V.hub_article(stg, LOAD_DT_1, dedupe_on="raw").withColumn(
        "article_std", K.std("article_bkey")), "article_std").union(
        C.unique(stg.select(F.col("project").alias("p")), "p"))


def q_dq_relationships(spark, sf_dir):
    orders, cust = _orders_with_missing_customers(Tables(spark, sf_dir))
    return C.relationships(orders, "o_custkey", cust, "c_custkey")


def q_dq_accepted_values(spark, sf_dir):
    o = Tables(spark, sf_dir)["orders"]
    return C.accepted_values(o, "o_orderpriority", O.ACCEPTED_PRIORITIES)


def q_dq_singular(spark, sf_dir):
    """Anomaly: lineitem rows shipped before their order date."""
    t = Tables(spark, sf_dir)
    li = t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate")
    o = t["orders"].select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return C.singular(li.join(o, "l_orderkey").filter(F.col("l_shipdate") < F.col("o_orderdate"))
                      .select("l_orderkey", "l_linenumber"))


def q_dq_freshness(spark, sf_dir):
    t = Tables(spark, sf_dir)
    parts = [C.freshness(t[name], col, O.FRESHNESS_NOW, O.FRESH_WARN_S, O.FRESH_ERROR_S, name)
             for name, col in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("source", T.ntz_text("newest", "yyyy-MM-dd HH:mm:ss").alias("newest"), "age_s", "status")


def _segment_null(c):
    return F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment"))


def q_filter_not_null(spark, sf_dir):
    c = Tables(spark, sf_dir)["customer"]
    return c.select("c_custkey", _segment_null(c).alias("segment")).filter(F.col("segment").isNotNull())


def q_filter_not_null_all(spark, sf_dir):
    c = Tables(spark, sf_dir)["customer"]
    nat = F.when(F.col("c_nationkey") >= 3, F.col("c_nationkey"))
    df = c.select("c_custkey", _segment_null(c).alias("segment"), nat.alias("nation"))
    return df.dropna(subset=["segment", "nation"])


def q_filter_std_equals(spark, sf_dir):
    stg = staged(Tables(spark, sf_dir), "worldbank")
    return stg.filter(K.std("indicator_id") == F.lit(M.POPULATION_INDICATOR)).select("country_iso3", "year", "value")


def q_case_boolean(spark, sf_dir):
    o = Tables(spark, sf_dir)["orders"]
    st = F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus"))
    return o.select("o_orderkey", F.coalesce(F.when(st == "f", F.lit(True)), F.lit(False)).alias("is_final"))


def q_null_sentinel(spark, sf_dir):
    c = Tables(spark, sf_dir)["customer"]
    return c.select("c_custkey", K.null_sentinel(_segment_null(c)).alias("segment"))


def q_scalar_functions(spark, sf_dir):
    """try_int / try_double / substring / url-encode / epoch -> day over text made from events."""
    ev = Tables(spark, sf_dir)["events"]
    txt = T.double_text("value")
    name = F.concat(F.lit("User "), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"), F.lit("*~"))
    return ev.select(
        "event_id",
        T.try_int(txt).alias("value_int"),
        T.try_double(txt).alias("value_double"),
        T.try_int(F.col("props")).alias("props_int"),
        F.substring(T.ntz_text("ts", "yyyyMMddHH"), 1, 8).alias("day8"),
        T.url_encode_segment(name).alias("article_enc"),
        PIT.quake_day(T.epoch_millis("ts")).alias("day"),
        T.utc_stamp("ts").alias("stamp"),
    )


def request_tables(t: Tables) -> dict[str, DataFrame]:
    """One request (page) per row, derived from the driver tables."""
    ev, li = t["events"], t["lineitem"]
    wb = S.worldbank_observations(t["orders"], t["customer"], t["nation"])
    ind = (F.when(F.col("o_orderpriority") == S.WORLDBANK_HEADLINE_PRIORITY, F.lit(S.WORLDBANK_HEADLINE_INDICATOR))
           .otherwise(F.col("o_orderpriority")))
    return {
        "worldbank": wb.select(ind.alias("indicator"), F.col("n_name").alias("country")).distinct(),
        "openmeteo": li.select((F.col("l_suppkey") / 10.0).alias("lat"), (F.col("l_linenumber") / 10.0).alias("lon")).distinct(),
        "wikimedia": ev.groupBy(F.col("event_type").alias("project"),
                                F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("article"))
        .agg(T.ntz_text(F.min("ts"), "yyyyMMdd").alias("start"), T.ntz_text(F.max("ts"), "yyyyMMdd").alias("end"))
        .select("project", "article", F.lit(S.WIKI_ACCESS).alias("access"), F.lit(S.WIKI_AGENT).alias("agent"),
                F.lit(S.WIKI_GRANULARITY).alias("granularity"), "start", "end"),
        "github": t["orders"].select(F.lit("orders").alias("owner"), F.col("o_orderpriority").alias("repo"),
                                     F.when(F.col("o_orderstatus") == "F", F.lit("main")).alias("sha")).distinct(),
        "openaq": li.groupBy(F.col("l_suppkey").alias("sensor_id")).agg(
            F.min(F.to_date("l_shipdate")).cast("string").alias("date_from"),
            F.when(F.max("l_shipdate") < F.lit(O.LINEITEM_CUT_1).cast("timestamp_ntz"),
                   F.max(F.to_date("l_shipdate")).cast("string")).alias("date_to"))
        .select("sensor_id", F.lit("measurements").alias("resource"), "date_from", "date_to"),
        "usgs": ev.select(F.concat(F.col("event_type"), F.lit("_day")).alias("feed")).distinct(),
    }


def q_request_plan(spark, sf_dir):
    reqs = request_tables(Tables(spark, sf_dir))
    parts = [L.plan_requests(df, src, F.lit(LOAD_DT_1).cast("timestamp_ntz")) for src, df in reqs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("source", "url")


def q_landing_keys(spark, sf_dir):
    reqs = request_tables(Tables(spark, sf_dir))
    parts = [L.plan_requests(df, src, F.lit(LOAD_DT_1).cast("timestamp_ntz")) for src, df in reqs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("source", "landing_key")


def q_row_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    from satlink.operators.counts import row_counts
    return row_counts({"orders": t["orders"], "lineitem": t["lineitem"], "events": t["events"],
                       "customer": t["customer"], "missing_table": None})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable] = {f"stg_{s}": _stg(s) for s in FL.FLATTENERS}
    q.update({
        "scan_json_roundtrip": q_scan_json_roundtrip,
        "landing_sink": q_landing_sink,
        "compact_parquet": q_compact_parquet,
        "src_registry_scan": q_src_registry_scan,
        "filter_valid_json": q_filter_valid_json,
        "explode_list": q_explode_list,
        "zip_explode": q_zip_explode,
        "hash_key": q_hash_key,
        "hash_key_composite": q_hash_key_composite,
        "hash_diff": q_hash_diff,
        "double_text": q_double_text,
    })
    q.update({n: _hub(n) for n in V.HUBS})
    q.update({n: _link(n) for n in V.LINKS})
    q.update({
        "sat_append_article_views": _sat("sat_article_views"),
        "sat_append_country_indicator": _sat("sat_country_indicator_values"),
        "sat_upsert_weather": _sat("sat_weather_hourly"),
        "sat_upsert_commit": _sat("sat_commit_meta"),
        "sat_upsert_sensor": _sat("sat_sensor_measurements"),
        "sat_upsert_country_indicator": _sat("sat_country_indicator_values", "upsert"),
        "not_in_null_aware": q_not_in_null_aware,
        "pit_article_day": q_pit_article_day,
        "pit_country_indicator_year": q_pit_country_indicator_year,
        "pit_latest_version": q_pit_latest_version,
        "pit_as_of": q_pit_as_of,
        "pit_as_of_incremental": q_pit_as_of_incremental,
        "pit_weather_day": q_pit_weather_day,
        "pit_sensor_hour": q_pit_sensor_hour,
        "pit_sensor_day": q_pit_sensor_day,
        "pit_quake_day": q_pit_quake_day,
        "pit_commit_day": q_pit_commit_day,
        "mart_article_traffic_daily": q_mart_article_traffic_daily,
        "mart_population_by_country_year": q_mart_population_by_country_year,
        "mart_weather_daily": q_mart_weather_daily,
        "mart_air_quality_hourly": _mart_air_quality("hour"),
        "mart_air_quality_daily": _mart_air_quality("day"),
        "mart_quakes_daily": q_mart_quakes_daily,
        "mart_commits_daily": q_mart_commits_daily,
        "pit_article_day_incremental": q_pit_article_day_incremental,
        "pit_weather_day_incremental": q_pit_weather_day_incremental,
        "materialize_view": q_materialize_view,
        "materialize_table": q_materialize_table,
        "dq_run_checks": q_dq_run_checks,
        "dq_not_null": q_dq_not_null,
        "dq_unique": q_dq_unique,
        "dq_relationships": q_dq_relationships,
        "dq_accepted_values": q_dq_accepted_values,
        "dq_singular": q_dq_singular,
        "dq_freshness": q_dq_freshness,
        "filter_not_null": q_filter_not_null,
        "filter_not_null_all": q_filter_not_null_all,
        "filter_std_equals": q_filter_std_equals,
        "case_boolean": q_case_boolean,
        "null_sentinel": q_null_sentinel,
        "scalar_functions": q_scalar_functions,
        "request_plan": q_request_plan,
        "landing_keys": q_landing_keys,
        "row_counts": q_row_counts,
    })
    return q


def oracle_sql() -> dict[str, str]:
    return O.oracle_sql()
