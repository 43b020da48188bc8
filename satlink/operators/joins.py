"""Anti-joins with the two NULL semantics the loaders need, as equi-joins. (When no column is
declared non-NULL, the "right row NULL in every column" case joins on a constant: a nested loop
against at most one row.)

* ``anti_join`` — ``NOT EXISTS (... a = b AND ...)``: a NULL key never matches, so a row
  with a NULL key always survives.
* ``null_aware_anti_join`` — ``(a, b) NOT IN (select a, b ...)``: a right row with NULL in
  a column matches anything there, so it can hide left rows. Written literally Spark plans
  a BroadcastNestedLoopJoin (quadratic, and it broadcasts the big side); here it becomes a
  union over NULL patterns of plain equi anti-joins.

Both can first shrink the right side to the keys that the left side actually has
(``small_left=True``): ``right LEFT SEMI broadcast(left_keys)`` streams the big right side
past a hash table of the left keys, so it is never shuffled. Only pass it when the left side
has a measured size bound (a load measures its written batch); otherwise both sides are
shuffled once, which is what a big batch needs anyway.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def _subsets(items: list[str]):
    for r in range(len(items), -1, -1):
        yield from (list(c) for c in combinations(items, r))


def _probe(right: DataFrame, left: DataFrame, on: list[str]) -> DataFrame:
    """Right rows whose key also occurs on the left side, whose distinct keys were counted before."""
    return right.join(F.broadcast(left.select(*on).distinct()), on, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, on: list[str], small_left: bool = False) -> DataFrame:
    """Left rows with no right row equal on all ``on`` columns (NOT EXISTS semantics)."""
    r = right.select(*on)
    if small_left:
        r = _probe(r, left, on)
    return left.join(r, on, "left_anti")


def null_aware_anti_join(left: DataFrame, right: DataFrame, on: list[str],
                         non_null: tuple[str, ...] | list[str] = (),
                         small_left: bool = False) -> DataFrame:
    """Left rows for which ``(on...) NOT IN (select on... from right)`` is TRUE.

    A left row survives iff every right row differs from it in some column where both are
    non-NULL. Left rows are split by which columns are NULL (pattern Q); for each Q and each
    set T of columns on which a right row can still be compared, right rows that are NULL on
    the remaining columns hide left rows equal on T. ``non_null`` columns (declared never
    NULL on both sides) prune the patterns: with one of two columns declared, three
    anti-joins remain.
    """
    on = list(on)
    r_all = right.select(*on)
    nullable = [c for c in on if c not in set(non_null)]
    parts: list[DataFrame] = []
    for q in _subsets(nullable):
        rest = [c for c in on if c not in q]
        lq = left.filter(_all([F.col(c).isNull() for c in q] + [F.col(c).isNotNull() for c in rest]))
        for t in _subsets(rest):
            wild = [c for c in rest if c not in t]
            if any(c not in nullable for c in wild):
                continue
            rt = r_all.filter(_all([F.col(c).isNull() for c in wild] + [F.col(c).isNotNull() for c in t]))
            if t:
                rt = rt.select(*t)
                if small_left:
                    rt = _probe(rt, lq, t)
                lq = lq.join(rt, t, "left_anti")
            else:
                # Any right row NULL on every comparable column hides the whole pattern;
                # ``distinct`` of a constant has at most one row.
                flag = rt.select(F.lit(1).alias("__hit")).distinct()
                lq = lq.withColumn("__hit", F.lit(1)).join(flag, "__hit", "left_anti").drop("__hit")
        parts.append(lq)
    return reduce(lambda a, b: a.unionByName(b), parts)


def orphans(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no ``field`` in the parent."""
    p = parent.select(F.col(field).alias(col))
    return child.filter(F.col(col).isNotNull()).join(p, col, "left_anti")
