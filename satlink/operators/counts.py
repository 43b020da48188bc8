"""Row counts of several tables in one job; a missing table yields an error row, not a failure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """``table_name, n, error``: one partial-count aggregation over the union of all tables."""
    present = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items() if df is not None]
    missing = [name for name, df in tables.items() if df is None]
    if not present:
        raise ValueError("no table to count")
    counted = (reduce(lambda a, b: a.unionByName(b), present).groupBy("table_name")
               .agg(F.count("*").alias("n")).withColumn("error", F.lit(None).cast("string")))
    spark = present[0].sparkSession
    if missing:
        rows = spark.createDataFrame([(m, None, f"table not found: {m}") for m in missing],
                                     "table_name string, n bigint, error string")
        counted = counted.unionByName(rows)
    return counted


def safe_table(read, name: str) -> DataFrame | None:
    """``read(name)`` or None when the table cannot be found."""
    try:
        return read(name)
    except Exception:  # noqa: BLE001 - any lookup failure means "missing" here
        return None
