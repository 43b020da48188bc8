"""Marts: hubs joined with PITs.

No join hints: hubs grow with the data, so AQE picks broadcast at run time only when a side
is actually small. The indicator filter is turned into a literal hash-key filter that
reaches the PIT scan, so only one indicator's rows enter the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlink.functions.keys import hash_key, std

POPULATION_INDICATOR = "SP.POP.TOTL"


def article_traffic_daily(hub_article: DataFrame, link_project_article: DataFrame,
                          pit_article_day: DataFrame) -> DataFrame:
    """article, project, yyyymmdd, views_day: hub ⋈ link on hk_article ⋈ PIT on (hk_article, project)."""
    a = hub_article.select("hk_article", F.col("article_bkey").alias("article"))
    link = link_project_article.select("hk_article", "project_id")
    d = pit_article_day.select("hk_article", "project_id", "yyyymmdd", "views_day")
    return (d.join(link, ["hk_article", "project_id"])
            .join(a, "hk_article")
            .select("article", F.col("project_id").alias("project"), "yyyymmdd", "views_day"))


def population_by_country_year(hub_country: DataFrame, hub_indicator: DataFrame,
                               pit_country_indicator_year: DataFrame,
                               indicator: str = POPULATION_INDICATOR) -> DataFrame:
    """iso3, indicator, year, value_year for one indicator (``upper(trim(bkey)) = indicator``)."""
    hk = hash_key(F.lit(indicator))
    ind = (hub_indicator.filter(std("indicator_bkey") == F.lit(indicator.strip().upper()))
           .select("hk_indicator", F.col("indicator_bkey").alias("indicator")))
    y = pit_country_indicator_year.filter(F.col("hk_indicator") == hk)
    c = hub_country.select("hk_country", F.col("country_bkey").alias("iso3"))
    return (y.join(ind, "hk_indicator").join(c, "hk_country")
            .select("iso3", "indicator", "year", "value_year"))


def weather_daily(hub_location: DataFrame, pit_weather_day: DataFrame) -> DataFrame:
    """Daily temperature / humidity statistics per location key (``LAT|LON``)."""
    return (pit_weather_day.join(hub_location.select("hk_location", F.col("location_bkey").alias("location")),
                                 "hk_location").drop("hk_location"))


def air_quality(hub_sensor: DataFrame, pit_sensor: DataFrame) -> DataFrame:
    """Per sensor, parameter and period: min / avg / max value."""
    return (pit_sensor.join(hub_sensor.select("hk_sensor", F.col("sensor_bkey").alias("sensor")), "hk_sensor")
            .drop("hk_sensor"))
