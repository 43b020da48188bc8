"""Expressions that are to be computed once per row, whatever uses them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with column ``name``, computed once per row (``explode`` of a one-element array).

    A plain projection is merged into the filters and projections above it, so that a filter on a
    parsed payload writes and parses the payload again for each of its conditions. Nothing is
    pushed below a generator or merged with it.
    """
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.explode(F.array(value)).alias(name))
