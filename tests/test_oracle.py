"""Every query of the core against its DuckDB SQL on the smallest driver tables.

(The corpus operators are optional; tests/llm holds theirs against SQL or brute force.)
"""

import math

import pytest

import __spark_entry__ as E
from satlink.plans import catalog

from core_helpers import SMALL

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    return v


def _rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = _rows(df.columns, df.collect())
    res = duck.execute(SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["article", "project", "yyyymmdd", "views_day"]
    assert df.count() > 0
