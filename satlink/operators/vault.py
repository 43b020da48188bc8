"""Hubs, links and satellites: four generic builders and the configs of every vault table.

All keys are computed once per row on the executors (``sha2`` is codegen'd), after the
NOT NULL filters so Catalyst can push those into the scan. Hubs and links aggregate on the
standardised key *before* hashing, so each distinct key is hashed once; the aggregation is
partial (map-side) so a hot key is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlink.functions.keys import composite_text, hash_diff_text, hash_key, std
from satlink.functions.once import once
from satlink.functions.text import double_text, try_double, try_int

HASH_NK = "hash_natural_key"
HD = "hd_attributes"
#: Marks (in a column's metadata) the texts that stand for hashes until rows are written into a table.
TEXT_OF_HASH = "text_of_hash"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _load_dt(load_dt) -> Column:
    return (load_dt if isinstance(load_dt, Column) else F.lit(load_dt)).cast("timestamp")


def build_hub(df: DataFrame, bkey: Column | str, name: str, load_dt, dedupe_on: str = "hk",
              never_null: bool = False) -> DataFrame:
    """One row per business key: ``hk_<name>, <name>_bkey, load_dt``.

    ``never_null``: the caller has left out the rows without a key, so no test of the key is
    planned. (The optimizer would push it, with all that the key is made of, below the parsing.)

    ``dedupe_on="hk"`` (default): one row per hash key, keeping the smallest raw spelling
    (``za``, `` ZA `` and ``ZA`` give one row). ``"raw"``: one row per raw value, as the
    reference codes it (several rows may share one hash key).
    """
    k = _c(bkey).alias("bkey")
    keys = df.select(k)
    if not never_null:
        keys = keys.filter(F.col("bkey").isNotNull())
    if dedupe_on == "hk":
        # distinct raw keys first (hash aggregate, partial per task); only the distinct set
        # reaches the sort-based min per standardised key.
        keys = keys.distinct().groupBy(std("bkey").alias("skey")).agg(F.min("bkey").alias("bkey"))
        hk = F.sha2(F.col("skey"), 256)
    elif dedupe_on == "raw":
        keys = keys.distinct()
        hk = hash_key("bkey")
    else:
        raise ValueError("dedupe_on must be 'hk' or 'raw'")
    return keys.select(hk.alias(f"hk_{name}"), F.col("bkey").alias(f"{name}_bkey"),
                       _load_dt(load_dt).alias("load_dt"))


def build_link(df: DataFrame, parts: Sequence[tuple[str, Column | str, str | None]], link_hk: str,
               load_dt, keep_std: dict[str, str] | None = None, dedupe_on: str = "hk") -> DataFrame:
    """One row per key combination.

    ``parts``: ``(role, raw column, hub hash-key name or None)`` in key order. The link key
    hashes ``std(p1)|std(p2)|...``; each part with a hub name also gets that hub's key.
    ``keep_std``: role -> output name for parts kept as standardised text (no hub).
    ``dedupe_on="hk"`` groups on the standardised parts, ``"raw"`` on the raw pairs.
    """
    roles = [r for r, _, _ in parts]
    sel = df.select(*[_c(c).alias(r) for r, c, _ in parts])
    sel = sel.filter(F.col(roles[0]).isNotNull() if len(roles) == 1 else
                     F.expr(" AND ".join(f"`{r}` IS NOT NULL" for r in roles)))
    if dedupe_on == "hk":
        pairs = sel.select(*[std(r).alias(r) for r in roles]).distinct()
    elif dedupe_on == "raw":
        pairs = sel.distinct()
    else:
        raise ValueError("dedupe_on must be 'hk' or 'raw'")
    out = [hash_key(composite_text(roles)).alias(link_hk)]
    for r, _, hub_hk in parts:
        if hub_hk:
            out.append(hash_key(r).alias(hub_hk))
    for r, name in (keep_std or {}).items():
        out.append(std(r).alias(name))
    out.append(_load_dt(load_dt).alias("load_dt"))
    return pairs.select(*out)


def build_satellite(df: DataFrame, parents: dict[str, Column], natural_key: Sequence[Column],
                    diff: Sequence[Column], attrs: Sequence[str], load_dt,
                    reject_null_keys: bool = True, dedupe: bool = True, never_null: bool = False,
                    parent_keys: dict[str, Column | str] | None = None, key_decides: bool = False, hashed: bool = True) -> DataFrame:
    """Versioned attributes: ``parents..., hash_natural_key, hd_attributes, attrs..., load_dt``.

    ``parent_keys``: parents that are the hash of a business key; they come before ``parents``.
    ``key_decides``: equal natural-key texts always have equal ``parent_keys``.

    ``natural_key``: parts joined by ``|`` (standardised) and hashed; any NULL part gives a
    NULL key. ``diff``: parts already rendered as text, NULL -> ``'NULL'``.
    ``reject_null_keys`` drops rows whose natural key is NULL (they would be re-inserted
    on every append run; ``never_null``: the caller has left them out). ``dedupe`` keeps one row per (natural key, diff), the smallest: the
    diff ignores case, so spellings that differ in case only are one version, and overlapping
    dumps insert once. Rows without a key collapse only when all their columns are equal.
    The versions are told apart by the texts that are hashed, and hashed after: what is shuffled
    are short texts and binary parent keys, not hexadecimal hashes. ``hashed=False`` leaves the texts in
    the columns of their hashes (marked; ``load_satellite`` makes the hashes when it writes the table).
    """
    nk_parts = list(natural_key)
    if reject_null_keys and not never_null:
        # The key is NULL exactly when a part is: test the parts, so the hash is computed once.
        df = df.filter(reduce(lambda a, b: a & b, [p.isNotNull() for p in nk_parts]))
    hash_now, parent_texts = hashed, {n: std(c) for n, c in (parent_keys or {}).items()}
    # The smallest row is that of the smallest hash: bytes compare as their hexadecimal text does.
    # Where the natural key decides, all rows that are compared have the same one.
    keys = [(c if key_decides else F.unhex(F.sha2(c, 256))).alias(n) for n, c in parent_texts.items()]
    row = F.struct(*keys, *[c.alias(n) for n, c in parents.items()], *attrs)
    sat = df.select(std(composite_text(nk_parts)).alias("__nk"), std(hash_diff_text(diff)).alias("__hd"), row.alias("__row"))
    if dedupe:
        alone = [] if reject_null_keys else [F.when(F.col("__nk").isNull(), F.col("__row")).alias("__alone")]
        sat = sat.groupBy("__nk", "__hd", *alone).agg(F.min("__row").alias("__row"))
    value = lambda n: F.col(f"__row.{n}")
    digest = lambda c, n: F.sha2(c, 256).alias(n) if hash_now else c.alias(n, metadata={TEXT_OF_HASH: True})
    return sat.select(*[digest(value(n), n) if key_decides else F.lower(F.hex(value(n))).alias(n) for n in parent_texts],
                      *[value(n).alias(n) for n in parents],
                      digest(F.col("__nk"), HASH_NK), digest(F.col("__hd"), HD),
                      *[value(a).alias(a) for a in attrs], _load_dt(load_dt).alias("load_dt"))


# ---------------------------------------------------------------------------------------
# Configs: the vault tables over the staging views.
# ---------------------------------------------------------------------------------------

def location_bkey(lat: Column | str, lon: Column | str) -> Column:
    """``LAT|LON`` with each coordinate rendered like ``cast(double as varchar)``."""
    return F.concat(std(double_text(_c(lat))), F.lit("|"), std(double_text(_c(lon))))


def hub_article(stg_wikimedia: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    return build_hub(stg_wikimedia, "article", "article", load_dt, dedupe_on)


def hub_commit(stg_github: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    return build_hub(stg_github, "commit_sha", "commit", load_dt, dedupe_on)


def hub_country(stg_worldbank: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    return build_hub(stg_worldbank, "country_iso3", "country", load_dt, dedupe_on)


def hub_indicator(stg_worldbank: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    return build_hub(stg_worldbank, "indicator_id", "indicator", load_dt, dedupe_on)


def hub_location(stg_openmeteo: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    # Few distinct places against many hours: the number texts are made once per place, and
    # after an aggregate, so that the parsing of the payload is not repeated inside them.
    # ``once`` stands between the two aggregates: the optimizer would leave out the first one.
    df = stg_openmeteo.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("lat", "lon").distinct()
    return build_hub(once(df, "bkey", location_bkey("lat", "lon")), "bkey", "location", load_dt, dedupe_on, never_null=True)


def hub_sensor(stg_openaq: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    # Few sensors against many measurements, as in hub_location.
    df = stg_openaq.filter(F.col("sensor_id").isNotNull()).select("sensor_id").distinct()
    return build_hub(once(df, "bkey", F.col("sensor_id").cast("string")), "bkey", "sensor", load_dt, dedupe_on, never_null=True)


def link_country_indicator(stg_worldbank: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    return build_link(stg_worldbank, [("country_bkey", "country_iso3", "hk_country"),
                                      ("indicator_bkey", "indicator_id", "hk_indicator")],
                      "hk_country_indicator", load_dt, dedupe_on=dedupe_on)


def link_project_article(stg_wikimedia: DataFrame, load_dt, dedupe_on: str = "hk") -> DataFrame:
    df = build_link(stg_wikimedia, [("project_id", "project", None), ("article_bkey", "article", "hk_article")],
                    "hk_project_article", load_dt, keep_std={"project_id": "project_id"}, dedupe_on=dedupe_on)
    return df.select("hk_project_article", "project_id", "hk_article", "load_dt")


def sat_article_views(stg_wikimedia: DataFrame, load_dt, **kw) -> DataFrame:
    base = stg_wikimedia.filter(F.col("project").isNotNull() & F.col("article").isNotNull()
                                & F.col("ts_yyyymmddhh").isNotNull())
    return build_satellite(
        base,
        parents={"project_id": std("project")},
        parent_keys={"hk_article": F.col("article"), "hk_project_article": composite_text(["project", "article"])},
        natural_key=[F.col("project"), F.col("article"), F.col("ts_yyyymmddhh").cast("string")],
        diff=[F.col("views").cast("string"), F.col("access"), F.col("agent"), F.col("granularity")],
        attrs=["views", "access", "agent", "granularity", "ts_yyyymmddhh"],
        load_dt=load_dt, **kw)


def sat_country_indicator_values(stg_worldbank: DataFrame, load_dt, **kw) -> DataFrame:
    base = (stg_worldbank
            .filter(F.col("country_iso3").isNotNull() & F.col("indicator_id").isNotNull() & F.col("year").isNotNull())
            .select(F.col("country_iso3").alias("country_bkey"), F.col("indicator_id").alias("indicator_bkey"),
                    try_int("year").alias("year"), try_double("value").alias("value"),
                    "unit", "obs_status", "decimal_places"))
    return build_satellite(
        base,
        parents={},
        parent_keys={"hk_country": F.col("country_bkey"), "hk_indicator": F.col("indicator_bkey")},
        natural_key=[F.col("country_bkey"), F.col("indicator_bkey"), F.col("year").cast("string")],
        diff=[double_text("value"), F.col("unit"), F.col("obs_status"), F.col("decimal_places").cast("string")],
        attrs=["value", "unit", "obs_status", "decimal_places", "year"],
        load_dt=load_dt, **kw)


def sat_weather_hourly(stg_openmeteo: DataFrame, load_dt, **kw) -> DataFrame:
    base = (stg_openmeteo
            .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("ts").isNotNull())
            .select(location_bkey("lat", "lon").alias("location_bkey"), "ts", "temperature_2m", "relativehumidity_2m"))
    return build_satellite(
        base,
        parents={},
        parent_keys={"hk_location": F.col("location_bkey")}, key_decides=True,  # (two numbers before the time)
        natural_key=[F.col("location_bkey"), F.col("ts")],
        diff=[double_text("temperature_2m"), double_text("relativehumidity_2m")],
        attrs=["temperature_2m", "relativehumidity_2m", "ts"],
        load_dt=load_dt, never_null=True, **kw)  # (a test of the number texts would be pushed below the parsing)


def sat_commit_meta(stg_github: DataFrame, load_dt, **kw) -> DataFrame:
    base = stg_github.filter(F.col("commit_sha").isNotNull())
    return build_satellite(
        base,
        parents={},
        parent_keys={"hk_commit": F.col("commit_sha")}, key_decides=True,
        natural_key=[std("commit_sha")],
        diff=[F.col("author_name"), F.col("author_date"), F.col("committer_name"), F.col("message"),
              F.when(F.col("verified"), F.lit("true")).when(~F.col("verified"), F.lit("false"))],
        attrs=["author_name", "author_date", "committer_name", "message", "verified"],
        load_dt=load_dt, **kw)


def sat_sensor_measurements(stg_openaq: DataFrame, load_dt, **kw) -> DataFrame:
    base = stg_openaq.filter(F.col("sensor_id").isNotNull() & F.col("date_utc").isNotNull())
    return build_satellite(
        base,
        parents={},
        parent_keys={"hk_sensor": F.col("sensor_id").cast("string")}, key_decides=True,  # (a number before the first separator)
        natural_key=[F.col("sensor_id").cast("string"), F.col("parameter"), F.col("date_utc")],
        diff=[double_text("value"), F.col("unit"), double_text("lat"), double_text("lon")],
        attrs=["parameter", "unit", "date_utc", "value", "lat", "lon"],
        load_dt=load_dt, **kw)


# Time part of the natural keys that have one, and the prefixes of it that make a period: year,
# month, day, hour. (A satellite is stored by period; see operators/load.py.)
PERIODS = {
    "sat_article_views": ("ts_yyyymmddhh", (4, 6, 8, 10)),
    "sat_country_indicator_values": ("year", (4,)),
    "sat_weather_hourly": ("ts", (4, 7, 10, 13)),
    "sat_sensor_measurements": ("date_utc", (4, 7, 10, 13)),
}

# Load mode per satellite, as configured in the reference (G14 is the disabled upsert
# variant of the country-indicator satellite: same builder, mode "upsert").
SATELLITES = {
    "sat_article_views": (sat_article_views, "wikimedia", "append"),
    "sat_country_indicator_values": (sat_country_indicator_values, "worldbank", "append"),
    "sat_weather_hourly": (sat_weather_hourly, "openmeteo", "upsert"),
    "sat_commit_meta": (sat_commit_meta, "github", "upsert"),
    "sat_sensor_measurements": (sat_sensor_measurements, "openaq", "upsert"),
}

HUBS = {
    "hub_article": (hub_article, "wikimedia"),
    "hub_commit": (hub_commit, "github"),
    "hub_country": (hub_country, "worldbank"),
    "hub_indicator": (hub_indicator, "worldbank"),
    "hub_location": (hub_location, "openmeteo"),
    "hub_sensor": (hub_sensor, "openaq"),
}

LINKS = {
    "link_country_indicator": (link_country_indicator, "worldbank"),
    "link_project_article": (link_project_article, "wikimedia"),
}
