"""Staging flatteners: payload text -> typed rows, one function per API.

``from_json`` with an explicit DDL (no inference), ``explode`` (an empty or NULL list drops
the payload), ``inline(arrays_zip(...))`` for parallel arrays. Nested-field pruning lets
Catalyst parse only the fields a consumer keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlink.functions.once import once
from satlink.functions.text import try_bigint, try_double, try_unsigned_bigint
from satlink.sources import payloads as P
from satlink.sources.json_scan import is_valid_json

STG_COLUMNS = {
    "stg_worldbank": ["indicator_id", "indicator_name", "country_id", "country_name", "country_iso3",
                      "year", "unit", "obs_status", "decimal_places", "value"],
    "stg_wikimedia": ["project", "article", "granularity", "access", "agent", "ts_yyyymmddhh", "views"],
    "stg_openmeteo": ["lat", "lon", "ts", "temperature_2m", "relativehumidity_2m"],
    "stg_github": ["commit_sha", "author_name", "author_date", "committer_name", "message", "verified"],
    "stg_openaq": ["sensor_id", "parameter", "unit", "date_utc", "value", "lat", "lon"],
    "stg_usgs": ["feature_id", "title", "place", "magnitude", "lon", "lat", "depth_km", "epoch_ms"],
}


def explode_path(df: DataFrame, col: Column | str, schema: str, alias: str = "j",
                 keep: list[str] | None = None) -> DataFrame:
    """Parse ``col`` as a JSON list with element type ``schema`` and emit one row per element.

    An empty or NULL list produces no row (``explode``, not ``explode_outer``).
    """
    c = F.col(col) if isinstance(col, str) else col
    return df.select(*(keep or []), F.explode(F.from_json(c, f"array<{schema}>")).alias(alias))


def zip_explode(df: DataFrame, arrays: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Parallel explode of several arrays by position; shorter arrays are padded with NULL."""
    names = list(arrays)
    zipped = F.arrays_zip(*[arrays[n].alias(n) for n in names])
    return df.select(*(keep or []), F.inline(zipped))


def stg_worldbank(payloads: DataFrame, col: str = "value") -> DataFrame:
    """``[meta, [obs...]]``: element 1 of a mixed top-level array, exploded."""
    v = payloads.filter(is_valid_json(col))
    obs = v.select(F.explode(F.from_json(F.get_json_object(F.col(col), "$[1]"), P.WORLDBANK_OBS)).alias("j"))
    j = F.col("j")
    return obs.select(
        j["indicator"]["id"].alias("indicator_id"),
        j["indicator"]["value"].alias("indicator_name"),
        j["country"]["id"].alias("country_id"),
        j["country"]["value"].alias("country_name"),
        j["countryiso3code"].alias("country_iso3"),
        j["date"].alias("year"),
        j["unit"].alias("unit"),
        j["obs_status"].alias("obs_status"),
        j["decimal"].alias("decimal_places"),
        try_double(j["value"]).alias("value"),
    )


def stg_wikimedia(payloads: DataFrame, col: str = "value") -> DataFrame:
    """``{"items": [...]}`` -> one row per item."""
    items = payloads.select(F.explode(F.from_json(F.col(col), P.WIKIMEDIA)["items"]).alias("j"))
    j = F.col("j")
    return items.select(
        j["project"].alias("project"),
        j["article"].alias("article"),
        j["granularity"].alias("granularity"),
        j["access"].alias("access"),
        j["agent"].alias("agent"),
        j["timestamp"].alias("ts_yyyymmddhh"),
        try_bigint(j["views"]).alias("views"),
    )


def stg_openmeteo(payloads: DataFrame, col: str = "value") -> DataFrame:
    """Scalar lat/lon repeated over the zip of the hourly arrays."""
    # Parsed once: what tests the coordinates is not to parse each payload again.
    p = once(payloads.filter(is_valid_json(col)).select(col), "p", F.from_json(F.col(col), P.OPENMETEO)).select("p")
    h = F.col("p.hourly")
    rows = zip_explode(
        p.select(F.col("p.latitude").alias("lat_t"), F.col("p.longitude").alias("lon_t"), h.alias("h")),
        {"ts": F.col("h.time"), "t2m": F.col("h.temperature_2m"), "rh": F.col("h.relativehumidity_2m")},
        keep=["lat_t", "lon_t"],
    )
    return rows.select(
        try_double("lat_t").alias("lat"),
        try_double("lon_t").alias("lon"),
        F.col("ts"),
        try_double("t2m").alias("temperature_2m"),
        try_double("rh").alias("relativehumidity_2m"),
    )


def stg_github(payloads: DataFrame, col: str = "value") -> DataFrame:
    """Top-level list of commits; ``verified`` from ``commit.verification`` (top level as fallback)."""
    v = payloads.filter(is_valid_json(col))
    commits = v.select(F.explode(F.from_json(F.col(col), P.GITHUB)).alias("j"))
    j = F.col("j")
    verified = F.coalesce(j["commit"]["verification"]["verified"], j["verification"]["verified"])
    return commits.select(
        j["sha"].alias("commit_sha"),
        j["commit"]["author"]["name"].alias("author_name"),
        j["commit"]["author"]["date"].alias("author_date"),
        j["commit"]["committer"]["name"].alias("committer_name"),
        j["commit"]["message"].alias("message"),
        F.coalesce(F.lower(verified) == F.lit("true"), F.lit(False)).alias("verified"),
    )


def stg_openaq(payloads: DataFrame, col: str = "value") -> DataFrame:
    """``{"results": [...]}`` with dotted paths; ``location_id`` is read then dropped."""
    res = payloads.select(F.explode(F.from_json(F.col(col), P.OPENAQ)["results"]).alias("r"))
    r = F.col("r")
    return res.select(
        try_bigint(r["sensorId"]).alias("sensor_id"),
        r["parameter"].alias("parameter"),
        r["unit"].alias("unit"),
        r["date"]["utc"].alias("date_utc"),
        try_double(r["value"]).alias("value"),
        try_double(r["coordinates"]["latitude"]).alias("lat"),
        try_double(r["coordinates"]["longitude"]).alias("lon"),
    )


def stg_usgs(payloads: DataFrame, col: str = "value") -> DataFrame:
    """GeoJSON ``features``; coordinates by position (missing index -> NULL); unsigned epoch."""
    feats = payloads.select(F.explode(F.from_json(F.col(col), P.USGS)["features"]).alias("f"))
    f = F.col("f")
    coords = f["geometry"]["coordinates"]
    return feats.select(
        f["id"].alias("feature_id"),
        f["properties"]["title"].alias("title"),
        f["properties"]["place"].alias("place"),
        try_double(f["properties"]["mag"]).alias("magnitude"),
        try_double(F.get(coords, 0)).alias("lon"),
        try_double(F.get(coords, 1)).alias("lat"),
        try_double(F.get(coords, 2)).alias("depth_km"),
        try_unsigned_bigint(f["properties"]["time"]).alias("epoch_ms"),
    )


FLATTENERS = {
    "worldbank": stg_worldbank,
    "wikimedia": stg_wikimedia,
    "openmeteo": stg_openmeteo,
    "github": stg_github,
    "openaq": stg_openaq,
    "usgs": stg_usgs,
}
