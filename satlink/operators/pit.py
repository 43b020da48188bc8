"""Point-in-time tables: aggregated snapshots at a grain, latest version, and as-of snapshots.

All are hash aggregates with partial (map-side) aggregation, so a key holding a third of
the rows is combined inside each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AVG_DIGITS = 6


def pit_article_day(sat_article_views: DataFrame) -> DataFrame:
    """Views per article, project and day (``yyyymmdd`` = first 8 chars of the hour stamp)."""
    return (sat_article_views
            .groupBy("hk_article", "project_id", F.substring("ts_yyyymmddhh", 1, 8).alias("yyyymmdd"))
            .agg(F.sum("views").alias("views_day")))


def pit_country_indicator_year(sat_country_indicator_values: DataFrame) -> DataFrame:
    """Max value per country, indicator and year (as coded: max, not the latest version)."""
    return (sat_country_indicator_values
            .groupBy("hk_country", "hk_indicator", F.col("year").cast("int").alias("year"))
            .agg(F.max("value").alias("value_year")))


def merge_pit(old: DataFrame, delta: DataFrame, keys: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Fold a PIT computed over newly inserted rows into the stored PIT.

    ``measures``: column -> ``"sum"`` or ``"max"`` (mergeable aggregates). Costs the PIT plus
    the delta, not the satellite.
    """
    fn = {"sum": F.sum, "max": F.max}
    both = old.select(*keys, *measures).unionByName(delta.select(*keys, *measures))
    return both.groupBy(*keys).agg(*[fn[m](c).alias(c) for c, m in measures.items()])


def pit_latest(sat: DataFrame, keys: Sequence[str], attrs: Sequence[str],
               order: Sequence[str] = ("load_dt", "hd_attributes")) -> DataFrame:
    """Newest version per key: ``max_by(attrs, (load_dt, hd_attributes))``."""
    best = F.max_by(F.struct(*attrs), F.struct(*order)).alias("__v")
    return sat.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__v.{a}").alias(a) for a in attrs])


def _lit_dates(dates: Sequence) -> Column:
    vals = sorted({d if isinstance(d, (date, datetime)) else date.fromisoformat(str(d)) for d in dates})
    return F.array(*[F.lit(v).cast("timestamp_ntz") for v in vals])


def _last(arr: Column) -> Column:
    """Last element of an array, NULL when it is empty."""
    return F.get(arr, F.size(arr) - 1)


def pit_as_of(versions: DataFrame, keys: Sequence[str], ts: str, attrs: Sequence[str],
              snapshot_dates: Sequence, order: Sequence[str] | None = None,
              date_col: str = "snapshot_date") -> DataFrame:
    """For every key and snapshot date, the newest version with ``ts <= date``.

    1. each version goes to the first snapshot date at or after its ``ts`` (an expression
       over the small, fixed list of dates: no join);
    2. newest version per (key, bucket) with ``max_by`` — partial aggregation, skew-safe;
    3. per key at most one entry per date remains, so a ``collect_list`` bounded by the
       number of dates, then a ``transform`` over the date list, carries each version
       forward to later dates.
    Keys get rows from their first version's date on. Versions after the last date drop.
    """
    order = list(order or [ts])
    dates = _lit_dates(snapshot_dates)
    t = F.col(ts).cast("timestamp_ntz")
    v = versions.select(*keys, *attrs, *[F.col(o).alias(f"__o{i}") for i, o in enumerate(order)],
                        F.get(F.filter(dates, lambda d: d >= t), 0).alias("__b"))
    v = v.filter(F.col("__b").isNotNull())
    ord_struct = F.struct(*[F.col(f"__o{i}") for i in range(len(order))])
    latest = v.groupBy(*keys, "__b").agg(
        F.max_by(F.struct(*attrs), ord_struct).alias("__v"), F.max(ord_struct).alias("__ord"))
    per_key = latest.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col("__b").alias("b"), F.col("__v").alias("v")))).alias("__hist"))
    # For each date: the last history entry whose bucket <= date.
    picked = per_key.select(
        *keys,
        F.explode(F.transform(dates, lambda d: F.struct(
            d.alias("d"),
            _last(F.filter(F.col("__hist"), lambda h: h["b"] <= d)).alias("h")))).alias("__x"))
    picked = picked.filter(F.col("__x.h").isNotNull())
    return picked.select(*keys, F.col("__x.d").alias(date_col), *[F.col(f"__x.h.v.{a}").alias(a) for a in attrs])


def pit_as_of_next(snapshots: DataFrame | None, versions: DataFrame, keys: Sequence[str], ts: str, attrs: Sequence[str],
                   snapshot, order: Sequence[str] | None = None, date_col: str = "snapshot_date") -> DataFrame:
    """The rows of ``pit_as_of`` for one more date, from its last snapshot and the versions since.

    ``snapshots``: earlier rows as this function makes them (with the ``order`` columns), or None;
    only those of the newest earlier date are read, and of ``versions`` only those after it up to
    date ``snapshot`` (both filters reach the scans). Versions with a ``ts`` at or before an earlier
    snapshot's date must have been there when that snapshot was made.
    """
    order = list(order or [ts])
    to = F.lit(snapshot if isinstance(snapshot, (date, datetime)) else date.fromisoformat(str(snapshot))).cast("timestamp_ntz")
    names = list(dict.fromkeys([*keys, *attrs, *order]))
    t = F.col(ts).cast("timestamp_ntz")
    new = versions.filter(t <= to)
    if snapshots is not None:
        last = snapshots.filter(F.col(date_col) < to).agg(F.max(date_col)).first()[0]
        if last is not None:
            old = snapshots.filter(F.col(date_col) == F.lit(last).cast("timestamp_ntz")).select(*names)
            new = new.filter(t > F.lit(last).cast("timestamp_ntz")).select(*names).unionByName(old)
    best = F.max_by(F.struct(*names), F.struct(*order)).alias("__v")
    return new.select(*names).groupBy(*keys).agg(best).select(*[F.col(f"__v.{n}").alias(n) for n in names], to.alias(date_col))


def daily_stats(df: DataFrame, keys: Sequence[Column | str], value: str, prefix: str) -> DataFrame:
    """min / avg (rounded to 6 places) / max / count of ``value`` per key."""
    return df.groupBy(*keys).agg(
        F.min(value).alias(f"{prefix}_min"),
        F.round(F.avg(value), AVG_DIGITS).alias(f"{prefix}_avg"),
        F.max(value).alias(f"{prefix}_max"),
        F.count(value).alias("n_obs"),
    )


def pit_weather_day(sat_weather_hourly: DataFrame) -> DataFrame:
    """Daily min / avg / max temperature and humidity per location."""
    day = F.substring("ts", 1, 10).alias("day")
    return sat_weather_hourly.groupBy("hk_location", day).agg(
        F.min("temperature_2m").alias("temp_min"),
        F.round(F.avg("temperature_2m"), AVG_DIGITS).alias("temp_avg"),
        F.max("temperature_2m").alias("temp_max"),
        F.min("relativehumidity_2m").alias("rh_min"),
        F.round(F.avg("relativehumidity_2m"), AVG_DIGITS).alias("rh_avg"),
        F.max("relativehumidity_2m").alias("rh_max"),
        F.count("*").alias("n_obs"),
    )


def pit_sensor(sat_sensor_measurements: DataFrame, grain: str = "hour") -> DataFrame:
    """Per sensor and parameter: min / avg / max value per hour (``yyyy-MM-ddTHH``) or day."""
    n = {"hour": 13, "day": 10}[grain]
    period = F.substring("date_utc", 1, n).alias(grain)
    return daily_stats(sat_sensor_measurements, ["hk_sensor", "parameter", period], "value", "value")


def quake_day(epoch_ms: Column | str) -> Column:
    """UTC day of an epoch in milliseconds as ``yyyy-MM-dd`` (integer math, zone-free).

    NULL beyond the year 9999 (an unsigned 64-bit epoch reaches further than a date).
    """
    c = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    days = F.floor(c.cast("decimal(20,0)") / F.lit(86_400_000))
    return F.when(days <= 2_932_896, F.date_from_unix_date(days.try_cast("int")).cast("string"))


def pit_quake_day(stg_usgs: DataFrame) -> DataFrame:
    """Quakes per UTC day: count and max magnitude (from staging: there is no quake hub)."""
    return (stg_usgs.filter(F.col("epoch_ms").isNotNull())
            .groupBy(quake_day("epoch_ms").alias("day"))
            .agg(F.count("*").alias("n_quakes"), F.max("magnitude").alias("max_magnitude")))


def pit_commit_day(sat_commit_meta: DataFrame) -> DataFrame:
    """Commits per author day: count and verified count."""
    return (sat_commit_meta.groupBy(F.substring("author_date", 1, 10).alias("day"))
            .agg(F.count("*").alias("n_commits"),
                 F.sum(F.when(F.col("verified"), 1).otherwise(0)).cast("bigint").alias("n_verified")))
