"""Driver tables -> API-shaped payloads, so every staging path runs on data that grows with them.

Each payload is one page: pages are cut by ranges of an id (``floor(id / PAGE_ROWS)``), which
bounds every ``collect_list`` group no matter how skewed the grouping key is: at most
``PAGE_ROWS`` rows where the id is unique (events, orders), up to seven times as many where it is
the order key of lineitem; a customer's observations of one priority for worldbank. The page id joins the natural grouping key (article, sensor, ...)
in the grouping, so a hot key is spread over many pages and many tasks.

Only the columns of the table are collected and shuffled; the page's records are made of them after.

Output of every shaper: request-parameter columns (see ``landing.landing_key``) + ``value``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlink.functions.once import once
from satlink.functions.text import ISO, double_text, epoch_millis, iso_text, ntz_fields, ntz_text, ntz_whole

PAGE_ROWS = 1000

# Fixed values written into the shaped payloads.
WIKI_GRANULARITY = "hourly"
WIKI_ACCESS = "all-access"
WIKI_AGENT = "all-agents"
WORLDBANK_HEADLINE_PRIORITY = "1-URGENT"
WORLDBANK_HEADLINE_INDICATOR = "SP.POP.TOTL"


def _page(id_col: str):
    return F.floor(F.col(id_col) / F.lit(PAGE_ROWS)).alias("page")


def wikimedia_items(events: DataFrame) -> DataFrame:
    """events -> what differs between the pageview items (one per event)."""
    return events.select(
        "event_id",
        F.col("event_type").alias("project"),
        F.concat(F.lit("User_"), F.col("user_id").cast("string")).alias("article"),
        F.col("ts"),
        F.floor("value").cast("bigint").alias("views"),
    )


def wikimedia_payloads(events: DataFrame) -> DataFrame:
    """One ``{"items": [...]}`` page per (project, article, page of event ids)."""
    items = wikimedia_items(events)
    day = ntz_text("ts", "yyyyMMdd")
    g = items.groupBy("project", "article", _page("event_id")).agg(
        F.collect_list(F.struct("ts", "views")).alias("items"), F.min(day).alias("start"), F.max(day).alias("end"))
    g = g.withColumn("items", F.transform("items", lambda x: F.struct(
        F.col("project"), F.col("article"),
        F.lit(WIKI_GRANULARITY).alias("granularity"), F.lit(WIKI_ACCESS).alias("access"), F.lit(WIKI_AGENT).alias("agent"),
        ntz_text(x["ts"], "yyyyMMddHH").alias("timestamp"), x["views"].alias("views"))))
    return g.select("project", "article", "start", "end",
                    F.lit(WIKI_ACCESS).alias("access"), F.lit(WIKI_AGENT).alias("agent"),
                    F.lit(WIKI_GRANULARITY).alias("granularity"),
                    F.to_json(F.struct("items")).alias("value"))


def worldbank_observations(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Max order price per (customer, priority, year) as indicator observations.

    A customer plays the country (``NATION-custkey``), so that countries grow with the data.
    ``max`` is aggregated before the joins.
    """
    per_cust = (orders.groupBy("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("yr"))
                .agg(F.max("o_totalprice").alias("value")))
    joined = (per_cust.join(customer.select("c_custkey", "c_nationkey"), per_cust.o_custkey == customer.c_custkey)
              .join(F.broadcast(nation.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey")))
    name = F.concat("n_name", F.lit("-"), F.col("c_custkey").cast("string"))
    return joined.select("n_nationkey", name.alias("n_name"), "o_orderpriority", "yr", "value")


def worldbank_payloads(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """``[meta, [obs...]]`` per (indicator, country), like one API response."""
    obs = worldbank_observations(orders, customer, nation)
    ind = (F.when(F.col("o_orderpriority") == WORLDBANK_HEADLINE_PRIORITY, F.lit(WORLDBANK_HEADLINE_INDICATOR))
           .otherwise(F.col("o_orderpriority")))
    o = obs.select(ind.alias("indicator"), F.col("n_name").alias("country"),
                   F.struct("n_nationkey", "o_orderpriority", "yr", "value").alias("obs"))
    g = o.groupBy("indicator", "country").agg(F.collect_list("obs").alias("obs"), F.count("*").alias("n"))
    g = g.withColumn("obs", F.transform("obs", lambda x: F.struct(
        F.struct(F.col("indicator").alias("id"), x["o_orderpriority"].alias("value")).alias("indicator"),
        F.struct(x["n_nationkey"].cast("string").alias("id"), F.col("country").alias("value")).alias("country"),
        F.col("country").alias("countryiso3code"),
        x["yr"].cast("string").alias("date"),
        x["value"].alias("value"),
        F.lit("").alias("unit"),
        F.lit("").alias("obs_status"),
        F.lit(0).alias("decimal"),
    )))
    meta = F.to_json(F.struct(F.lit(1).alias("page"), F.lit(1).alias("pages"),
                              F.lit(20000).alias("per_page"), F.col("n").alias("total")))
    value = F.concat(F.lit("["), meta, F.lit(","), F.to_json("obs"), F.lit("]"))
    return once(g, "value", value).select("indicator", "country", "value")


def openmeteo_payloads(lineitem: DataFrame) -> DataFrame:
    """Hourly parallel arrays per (supplier, line number, page of order keys).

    The three arrays come from one sorted array of structs, so positions line up.
    """
    rows = lineitem.select(
        "l_suppkey", "l_linenumber", _page("l_orderkey"),
        F.struct("l_shipdate", F.col("l_quantity").alias("t"), F.col("l_discount").alias("rh")).alias("h"),
    )
    g = rows.groupBy("l_suppkey", "l_linenumber", "page").agg(F.collect_list("h").alias("hs"))
    whole = lambda x: F.struct(ntz_whole(x["l_shipdate"]).alias("at"), x["t"].alias("t"), x["rh"].alias("rh"))
    hour = lambda x: F.struct(ntz_fields(x["at"], "yyyy-MM-dd'T'HH:mm").alias("time"), x["t"].alias("t"), x["rh"].alias("rh"))
    g = g.withColumn("hs", F.sort_array(F.transform(F.transform("hs", whole), hour)))
    lat = (F.col("l_suppkey") / F.lit(10.0)).alias("latitude")
    lon = (F.col("l_linenumber") / F.lit(10.0)).alias("longitude")
    hourly = F.struct(
        F.transform("hs", lambda x: x["time"]).alias("time"),
        F.transform("hs", lambda x: x["t"]).alias("temperature_2m"),
        F.transform("hs", lambda x: x["rh"]).alias("relativehumidity_2m"),
    ).alias("hourly")
    return once(g, "value", F.to_json(F.struct(lat, lon, hourly))).select(
        (F.col("l_suppkey") / F.lit(10.0)).alias("lat"), (F.col("l_linenumber") / F.lit(10.0)).alias("lon"), "value")


def github_payloads(orders: DataFrame) -> DataFrame:
    """Top-level commit lists, one per page of order keys."""
    order = F.struct("o_orderkey", "o_orderpriority", "o_orderdate", "o_custkey", "o_orderstatus")
    g = orders.groupBy(_page("o_orderkey")).agg(F.collect_list(order).alias("orders"))
    commits = F.transform("orders", lambda x: F.struct(
        F.sha2(x["o_orderkey"].cast("string"), 256).alias("sha"),
        F.struct(
            F.struct(x["o_orderpriority"].alias("name"), iso_text(x["o_orderdate"]).alias("date")).alias("author"),
            F.struct(x["o_custkey"].cast("string").alias("name")).alias("committer"),
            F.concat(F.lit("order "), x["o_orderkey"].cast("string")).alias("message"),
            F.struct((x["o_orderstatus"] == F.lit("F")).alias("verified")).alias("verification"),
        ).alias("commit"),
    ))
    return once(g, "value", F.to_json(commits)).select(
        F.lit("orders").alias("owner"), F.col("page").cast("string").alias("repo"), "value")


def openaq_payloads(lineitem: DataFrame) -> DataFrame:
    """``{"results": [...]}`` per (sensor, page of order keys)."""
    g = lineitem.groupBy("l_suppkey", _page("l_orderkey")).agg(
        F.collect_list(F.struct("l_returnflag", "l_linestatus", "l_shipdate", "l_quantity")).alias("rows"),
        F.min(F.to_date("l_shipdate")).alias("date_from"),
        F.max(F.to_date("l_shipdate")).alias("date_to"),
    )
    whole = F.transform("rows", lambda x: F.struct(x["l_returnflag"].alias("l_returnflag"), x["l_linestatus"].alias("l_linestatus"),
                                                   ntz_whole(x["l_shipdate"]).alias("at"), x["l_quantity"].alias("l_quantity")))
    results = F.transform(whole, lambda x: F.struct(
        F.col("l_suppkey").alias("locationId"),
        F.col("l_suppkey").alias("sensorId"),
        x["l_returnflag"].alias("parameter"),
        x["l_linestatus"].alias("unit"),
        F.struct(ntz_fields(x["at"], ISO).alias("utc")).alias("date"),
        x["l_quantity"].alias("value"),
        F.struct((F.col("l_suppkey") / F.lit(10.0)).alias("latitude"),
                 (F.col("l_suppkey") / F.lit(20.0)).alias("longitude")).alias("coordinates"),
    )).alias("results")
    return g.select(F.col("l_suppkey").alias("sensor_id"), F.lit("measurements").alias("resource"),
                    F.col("date_from").cast("string").alias("date_from"),
                    F.col("date_to").cast("string").alias("date_to"),
                    F.to_json(F.struct(results)).alias("value"))


def usgs_payloads(events: DataFrame) -> DataFrame:
    """GeoJSON feature collections, one per page of event ids."""
    feat = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            F.concat(F.lit("M "), double_text("value")).alias("title"),
            F.col("value").alias("mag"),
            epoch_millis("ts").alias("time"),
            F.col("event_type").alias("place"),
        ).alias("properties"),
        F.struct(F.array(F.col("user_id") / F.lit(10.0), F.col("user_id") / F.lit(20.0),
                         F.col("value")).alias("coordinates")).alias("geometry"),
    )
    g = events.groupBy(_page("event_id")).agg(F.collect_list(feat).alias("features"))
    return g.select(F.lit("all_day").alias("feed"),
                    F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value"))


SHAPERS = {
    "wikimedia": lambda t: wikimedia_payloads(t["events"]),
    "worldbank": lambda t: worldbank_payloads(t["orders"], t["customer"], t["nation"]),
    "openmeteo": lambda t: openmeteo_payloads(t["lineitem"]),
    "github": lambda t: github_payloads(t["orders"]),
    "openaq": lambda t: openaq_payloads(t["lineitem"]),
    "usgs": lambda t: usgs_payloads(t["events"]),
}
