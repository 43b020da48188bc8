"""Data-quality checks. Each returns the failing rows as a DataFrame: empty means pass.

``run_checks`` evaluates a list of checks into one summary: all not-null checks of a table
share one scan and one aggregate; uniqueness and relationships have a job part of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlink.operators.joins import orphans


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` that occur more than once (NULLs ignored): ``value, n``."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count("*").alias("n")).filter(F.col("n") > 1))


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys without a parent row: ``value, n``."""
    return (orphans(child.select(col), col, parent, field)
            .groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")))


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Values of ``col`` outside ``values`` (NULL is not checked): ``value, n``."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n")))


def singular(df: DataFrame) -> DataFrame:
    """A query that must return no rows: its rows are the failures."""
    return df


@dataclass(frozen=True)
class Singular:
    """A named query over the warehouse's tables that must return no rows.

    ``query`` gets the tables by name and is run when all of ``models`` exist; the first of
    them is the model it is reported under.
    """

    name: str
    models: tuple[str, ...]
    query: Callable[[dict[str, DataFrame]], DataFrame]


def _totals_differ(t: dict[str, DataFrame]) -> DataFrame:
    """Articles whose daily views do not add up to the satellite's."""
    sat = t["sat_article_views"].groupBy("hk_article").agg(F.sum("views").alias("views"))
    pit = t["pit_article_day"].groupBy(F.col("hk_article").alias("hk")).agg(F.sum("views_day").alias("views_day"))
    return sat.join(pit, sat["hk_article"].eqNullSafe(pit["hk"]), "full").filter(~F.col("views").eqNullSafe(F.col("views_day")))


SINGULAR = (
    Singular("views_are_not_negative", ("sat_article_views",), lambda t: t["sat_article_views"].filter("views < 0")),
    Singular("daily_views_add_up", ("pit_article_day", "sat_article_views"), _totals_differ),
    Singular("one_row_per_quake", ("quakes",), lambda t: unique(t["quakes"], "feature_id")),
    Singular("quakes_of_days_add_up", ("pit_quake_day", "quakes"), lambda t: t["quakes"].filter("epoch_ms is not null").agg(F.count("*").alias("n"))
             .join(t["pit_quake_day"].agg(F.coalesce(F.sum("n_quakes"), F.lit(0)).alias("n_days")), F.col("n") != F.col("n_days"))),
    Singular("a_link_has_one_project", ("link_project_article",), lambda t: unique(t["link_project_article"], "hk_project_article")),
)


def singular_checks(t: dict[str, DataFrame], tests: Iterable[Singular] = SINGULAR) -> list[Check]:
    return [Check(s.models[0], "", s.name, s.query(t)) for s in tests if all(m in t for m in s.models)]


def freshness_checks(t: dict[str, DataFrame], now, warn_after_s: int, error_after_s: int, models: Iterable[str], ts_col: str = "load_dt") -> list[Check]:
    """One failing row per table whose newest ``ts_col`` is too old (its status is ``warn`` or ``error``)."""
    return [Check(m, ts_col, "freshness", freshness(t[m], ts_col, now, warn_after_s, error_after_s, m).filter("status <> 'pass'")) for m in models if m in t]


def failing_rows(checks: Iterable[Check]) -> DataFrame | None:
    """``model, column, test, row``: the failing rows of checks, each as JSON."""
    parts = []
    for c in checks:
        rows = c.failures if c.table is None else not_null(c.table, c.column)
        parts.append(rows.select(F.lit(c.model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.test).alias("test"),
                                 F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None


def freshness(df: DataFrame, ts_col: str, now, warn_after_s: int, error_after_s: int,
              source: str) -> DataFrame:
    """Newest ``ts_col`` against ``now``: ``source, newest, age_s, status`` (one row)."""
    now_c = F.lit(now).cast("timestamp_ntz")
    newest = F.max(F.col(ts_col).cast("timestamp_ntz"))
    agg = df.agg(newest.alias("newest"))
    age = F.timestamp_diff("SECOND", F.col("newest"), now_c)
    status = (F.when(F.col("newest").isNull(), F.lit("error"))
              .when(age > error_after_s, F.lit("error"))
              .when(age > warn_after_s, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return agg.select(F.lit(source).alias("source"), F.col("newest"), age.alias("age_s"), status.alias("status"))


@dataclass(frozen=True)
class Check:
    """``failures``: rows that fail; or, for a not-null check, the ``table`` to count them in."""

    model: str
    column: str
    test: str
    failures: DataFrame | None = None
    table: DataFrame | None = None


def run_checks(checks: Iterable[Check]) -> DataFrame:
    """``model, column, test, failures`` for every check."""
    by_table: dict[int, list[Check]] = {}
    parts = []
    for c in checks:
        if c.table is not None:
            by_table.setdefault(id(c.table), []).append(c)
        else:
            parts.append(c.failures.agg(F.count("*").alias("failures")).select(
                F.lit(c.model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.test).alias("test"), "failures"))
    for group in by_table.values():
        counts = group[0].table.agg(*[F.count_if(F.col(c.column).isNull()).alias(f"c{i}") for i, c in enumerate(group)])
        rows = F.array(*[F.struct(F.lit(c.model).alias("model"), F.lit(c.column).alias("column"), F.lit(c.test).alias("test"),
                                  F.col(f"c{i}").alias("failures")) for i, c in enumerate(group)])
        parts.append(counts.select(F.inline(rows)))
    return reduce(lambda a, b: a.unionByName(b), parts)


HUB_NAMES = {"hub_country": "country", "hub_indicator": "indicator", "hub_article": "article",
             "hub_location": "location", "hub_commit": "commit", "hub_sensor": "sensor"}
RELATIONSHIPS = [("link_country_indicator", "hk_country", "hub_country"),
                 ("link_country_indicator", "hk_indicator", "hub_indicator"),
                 ("link_project_article", "hk_article", "hub_article"),
                 ("sat_article_views", "hk_article", "hub_article"),
                 ("sat_country_indicator_values", "hk_country", "hub_country"),
                 ("sat_country_indicator_values", "hk_indicator", "hub_indicator"),
                 ("sat_weather_hourly", "hk_location", "hub_location"),
                 ("sat_commit_meta", "hk_commit", "hub_commit"),
                 ("sat_sensor_measurements", "hk_sensor", "hub_sensor"),
                 ("pit_article_day", "hk_article", "hub_article"),
                 ("pit_country_indicator_year", "hk_country", "hub_country"),
                 ("pit_country_indicator_year", "hk_indicator", "hub_indicator"),
                 ("pit_weather_day", "hk_location", "hub_location"),
                 ("pit_sensor_hour", "hk_sensor", "hub_sensor"),
                 ("pit_sensor_day", "hk_sensor", "hub_sensor")]
NOT_NULL = {sat: ("hash_natural_key", "hd_attributes") for sat in (
    "sat_country_indicator_values", "sat_article_views", "sat_weather_hourly", "sat_commit_meta", "sat_sensor_measurements")}
NOT_NULL |= {"pit_article_day": ("hk_article", "project_id", "yyyymmdd", "views_day"),
             "pit_country_indicator_year": ("hk_country", "hk_indicator", "year"),
             "pit_weather_day": ("hk_location", "day"), "pit_sensor_hour": ("hk_sensor", "parameter", "hour"),
             "pit_sensor_day": ("hk_sensor", "parameter", "day"), "pit_commit_day": ("day",), "pit_quake_day": ("n_quakes",),
             "article_traffic_daily": ("article", "project", "yyyymmdd", "views_day"),
             "population_by_country_year": ("iso3", "indicator", "year"), "weather_daily": ("location", "day"),
             "air_quality_hourly": ("sensor", "parameter", "hour"), "air_quality_daily": ("sensor", "parameter", "day"),
             "quakes_daily": ("n_quakes",), "commits_daily": ("day", "n_commits")}


def vault_checks(t: dict[str, DataFrame]) -> list[Check]:
    """The constraint set of the warehouse: hubs, links, satellites, PITs and marts."""
    out: list[Check] = []
    for model, name in HUB_NAMES.items():
        if model in t:
            for col in (f"hk_{name}", f"{name}_bkey"):
                out.append(Check(model, col, "not_null", table=t[model]))
                out.append(Check(model, col, "unique", unique(t[model], col)))
    for child, col, parent in RELATIONSHIPS:
        if child in t and parent in t:
            out.append(Check(child, col, "relationships", relationships(t[child], col, t[parent], col)))
    for model, cols in NOT_NULL.items():
        if model in t:
            out += [Check(model, col, "not_null", table=t[model]) for col in cols]
    return out
