"""Scans: JSON payload dumps (one document per line, gzip by extension) and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_json(spark: SparkSession, glob: str | list[str], whole_file: bool = False,
              source: str | None = None) -> DataFrame:
    """Read every payload matched by ``glob`` as text.

    Output: ``value`` (payload text), ``file_path`` (lineage) and, when given, ``source``.
    ``whole_file=True`` reads pretty-printed files (one document per file).
    Gzip files are unsplittable: Spark packs many small ones per task (openCostInBytes), and
    consumers repartition after the explode, not before.
    """
    paths = [glob] if isinstance(glob, str) else list(glob)
    df = spark.read.option("wholetext", str(bool(whole_file)).lower()).text(paths)
    df = df.select("value", F.col("_metadata.file_path").alias("file_path"))
    if source is not None:
        df = df.withColumn("source", F.lit(source))
    return df


def is_valid_json(c: Column | str) -> Column:
    """True when the text parses as one JSON document (``json_valid``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_parse_json(c).isNotNull()


def valid_json(df: DataFrame, col: str = "value") -> DataFrame:
    """Drop payloads that are not JSON."""
    return df.filter(is_valid_json(col))


def scan_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columnar read; Catalyst pushes filters and prunes columns into the scan."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)
