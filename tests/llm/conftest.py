import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


@pytest.fixture
def frame(spark):
    """A documents table of (doc_id, text) rows, with columns whose names clash with outputs."""

    def make(rows, clash=()):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, "doc_id long, text string")
        for c in clash:
            df = df.withColumn(c, F.lit("own"))
        return df

    return make
