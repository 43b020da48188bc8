"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satlink.llm import common as C

_LINKS = "a long, b long"


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a partition as stars: each node to the least node that the partition's links reach."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if parent[x] != x]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], names=["a", "b"])


def stars(links: DataFrame) -> DataFrame:
    """Rows (a, b): every node but the least of its component, with the least one.

    Partitions first contract their own links; then large-star and small-star steps alternate
    (each node's neighbours move to its least neighbour) until nothing changes. Partial minima
    keep a node with very many links from gathering in one task.
    """
    C.python_tasks(links.sparkSession)
    now = C.cut(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(C.task("components", _stars), _LINKS).distinct())
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: neighbours above a node move to its least neighbour (or itself).
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: neighbours below a node, and the node, move to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = C.cut(moved.where("a <> b").mapInArrow(C.task("components", _stars), _LINKS).distinct())
        new = now.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")).first()
        if (new["n"], new["h"]) == state:
            return now
        state = (new["n"], new["h"])
