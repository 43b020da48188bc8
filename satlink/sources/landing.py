"""Landing side: payload sink, landing keys, request plans and small-file compaction.

The HTTP transport itself stays outside Spark; what Spark owns is the table of requests
(one row per request or page) and the immutable, append-only payload store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satlink.functions.text import url_encode_query, url_encode_segment, utc_stamp

# API endpoints and request defaults.
WORLDBANK_URL = "https://api.worldbank.org/v2/country/{country}/indicator/{indicator}"
WORLDBANK_PARAMS = [("format", "json"), ("per_page", "20000")]
OPENMETEO_URL = "https://api.open-meteo.com/v1/forecast"
OPENMETEO_HOURLY = "temperature_2m,relativehumidity_2m"
WIKIMEDIA_URL = ("https://wikimedia.org/api/rest_v1/metrics/pageviews/per-article/"
                 "{project}/{access}/{agent}/{article}/{granularity}/{start}/{end}")
GITHUB_URL = "https://api.github.com/repos/{owner}/{repo}/commits"
OPENAQ_URL = "https://api.openaq.org/v3/sensors/{sensor_id}/{resource}"
OPENAQ_LIMIT = "1000"
USGS_URL = "https://earthquake.usgs.gov/earthquakes/feed/v1.0/summary/{feed}.geojson"

SOURCES = ("worldbank", "openmeteo", "wikimedia", "github", "openaq", "usgs")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _template(tpl: str, cols: dict[str, Column]) -> Column:
    """Fill ``{name}`` slots of a URL template with column values (``concat``)."""
    parts: list[Column] = []
    rest = tpl
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            parts.append(F.lit(head))
        parts.append(cols[name])
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)


def _query_string(params: list[tuple[str, Column]]) -> Column:
    """``?k=v&...`` keeping parameter order; parameters that are NULL or empty are left out."""
    pieces = [F.when(v.isNotNull() & (v != ""), F.concat(F.lit(k + "="), url_encode_query(v)))
              for k, v in params]
    qs = F.concat_ws("&", *pieces)
    return F.when(qs == "", F.lit("")).otherwise(F.concat(F.lit("?"), qs))


def landing_key(source: str, load_dt: Column | str) -> Column:
    """Object key of one landed payload, as a column expression over request parameters.

    Expected columns per source: worldbank (indicator, country); openmeteo (lat, lon);
    wikimedia (project, article, start, end); github (owner, repo); openaq (sensor_id,
    resource, date_from, date_to); usgs (feed).
    """
    ts = utc_stamp(load_dt)
    if source == "worldbank":
        return F.concat_ws("/", F.lit("worldbank"), _s("indicator"), _s("country"), F.concat(ts, F.lit(".json.gz")))
    if source == "openmeteo":
        return F.concat(F.lit("openmeteo/"), _s("lat"), F.lit("_"), _s("lon"), F.lit("/"), ts, F.lit(".json.gz"))
    if source == "wikimedia":
        return F.concat(F.lit("wikimedia/"), _s("project"), F.lit("/"), url_encode_segment(_s("article")),
                        F.lit("/"), _s("start"), F.lit("_"), _s("end"), F.lit("/"), ts, F.lit(".json.gz"))
    if source == "github":
        return F.concat(F.lit("github/"), _s("owner"), F.lit("/"), _s("repo"), F.lit("/"), ts, F.lit(".json.gz"))
    if source == "openaq":
        return F.concat(F.lit("openaq/sensors/"), _s("sensor_id"), F.lit("/"), _s("resource"), F.lit("/"),
                        F.coalesce(F.nullif(_s("date_from"), F.lit("")), F.lit("na")), F.lit("_"),
                        F.coalesce(F.nullif(_s("date_to"), F.lit("")), F.lit("na")), F.lit("/"), ts, F.lit(".json.gz"))
    if source == "usgs":
        return F.concat(F.lit("usgs/earthquakes/"), _s("feed"), F.lit("/"), ts, F.lit(".geojson.gz"))
    raise ValueError(f"unknown source {source!r}")


def request_url(source: str) -> Column:
    """Full request URL (path + query string) per row of a request table (see ``landing_key``)."""
    if source == "worldbank":
        base = _template(WORLDBANK_URL, {"country": _s("country"), "indicator": _s("indicator")})
        return F.concat(base, _query_string([(k, F.lit(v)) for k, v in WORLDBANK_PARAMS]))
    if source == "openmeteo":
        return F.concat(F.lit(OPENMETEO_URL), _query_string([
            ("latitude", _s("lat")), ("longitude", _s("lon")), ("timezone", F.lit("auto")),
            ("hourly", F.lit(OPENMETEO_HOURLY)), ("daily", _s("daily"))]))
    if source == "wikimedia":
        return _template(WIKIMEDIA_URL, {
            "project": _s("project"), "access": _s("access"), "agent": _s("agent"),
            "article": url_encode_segment(_s("article")), "granularity": _s("granularity"),
            "start": _s("start"), "end": _s("end")})
    if source == "github":
        base = _template(GITHUB_URL, {"owner": _s("owner"), "repo": _s("repo")})
        return F.concat(base, _query_string([("sha", _s("sha"))]))
    if source == "openaq":
        base = _template(OPENAQ_URL, {"sensor_id": _s("sensor_id"), "resource": _s("resource")})
        return F.concat(base, _query_string([
            ("limit", F.coalesce(_s("limit"), F.lit(OPENAQ_LIMIT))),
            ("date_from", _s("date_from")), ("date_to", _s("date_to"))]))
    if source == "usgs":
        return _template(USGS_URL, {"feed": _s("feed")})
    raise ValueError(f"unknown source {source!r}")


def plan_requests(df: DataFrame, source: str, load_dt: Column | str) -> DataFrame:
    """Request table -> (source, url, landing_key): one row per request, nothing fetched here."""
    for opt in ("daily", "sha", "limit", "date_from", "date_to"):
        if opt not in df.columns:
            df = df.withColumn(opt, F.lit(None).cast("string"))
    return df.select(F.lit(source).alias("source"), request_url(source).alias("url"),
                     landing_key(source, load_dt).alias("landing_key"))


def land_payloads(df: DataFrame, out: str, payload: str = "value",
                  partition_cols: list[str] | None = None, compression: str = "gzip") -> None:
    """Append payloads as gzip JSON text, one payload per line, never rewriting old files.

    ``partition_cols`` should be coarse (source, load date): fine keys such as an article
    name would explode the number of folders at scale; keep those inside the payload.
    """
    cols = list(partition_cols or [])
    (df.select(*cols, F.col(payload).cast("string").alias("value"))
       .write.mode("append").option("compression", compression)
       .partitionBy(*cols).text(out))


def compact_to_parquet(df: DataFrame, out: str, files: int | None = None,
                       max_records_per_file: int = 5_000_000) -> None:
    """Fold many small payload files (already flattened to rows) into Parquet.

    ``files`` sets the output file count (``coalesce``: no shuffle); by default Spark keeps
    the scan's partitioning and ``maxRecordsPerFile`` bounds each file.
    """
    if files:
        df = df.coalesce(files)
    (df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
       .parquet(out))
