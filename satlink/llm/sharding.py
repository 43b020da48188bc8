"""Shards of near-equal bytes by Karmarkar-Karp differencing, groups of equal texts kept whole.

Groups are summed by a digest of their text (partial sums before the shuffle, so a text that
holds a third of all rows costs one row per task). Groups of at least 1 / ``ITEMS`` of all bytes
are items by themselves; smaller groups are bundled by the hash of their digest into at most
``ITEMS`` items. So at most 2 * ``ITEMS`` numbers reach the driver, whatever the size of the
corpus, and differencing runs on them: the two partial partitions of largest spread are added
in opposite order, until one is left. Shards go back to groups and rows by joins.

Slots number the rows of a shard without gaps: rows are numbered within (shard, chunk), where
chunks are hashes of the doc_id, and a small table of counts gives each chunk its offset.

Edge cases: a null text has no bytes and a null crc, and all null texts are one group; empty
texts are a group like any other; rows with equal or null doc_id get different slots; a group
larger than a shard's share has a shard with nothing that could go elsewhere; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satlink.llm import common as C

#: Items for each shard that the differencing may get, large groups and bundles each.
ITEMS_PER_SHARD = 2000
#: Rows of a chunk in which slots are counted, and most chunks.
CHUNK_ROWS, CHUNKS = 4096, 16384


def differencing(weights: list[int], k: int) -> np.ndarray:
    """The part (0 to k - 1) of each weight, by k-way Karmarkar-Karp differencing."""
    n = len(weights)
    if n == 0:
        return np.zeros(0, np.int64)
    sums = {i: [w] + [0] * (k - 1) for i, w in enumerate(weights)}  # largest first
    heap = [(-w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    made: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = [x + y for x, y in zip(sums.pop(a), reversed(sums.pop(b)))]
        order = sorted(range(k), key=both.__getitem__, reverse=True)
        node = n + len(made)
        made.append((a, b, np.array(order, np.uint8 if k <= 256 else np.int64)))
        both = [both[i] for i in order]
        sums[node] = both
        heapq.heappush(heap, (both[-1] - both[0], node))
    out = np.zeros(n, np.int64)
    part_of = {n + len(made) - 1 if made else 0: np.arange(k)}
    for step in range(len(made) - 1, -1, -1):  # undo: each side's parts from those of the sum
        a, b, order = made[step]
        parts = part_of.pop(n + step)
        for side, place in ((a, order), (b, k - 1 - order)):
            if side < n:
                out[side] = parts[np.flatnonzero(place == 0)[0]]
            else:
                part_of[side] = np.empty(k, np.int64)
                part_of[side][place] = parts
    return out


def shard(docs: DataFrame, shards: int, items_per_shard: int = ITEMS_PER_SHARD) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot), one per document."""
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(8)
    digest = F.coalesce(F.md5("text"), F.lit("null"))
    rows = C.written(docs.select("doc_id", size.alias("size"), F.crc32("text").alias("text_crc32"), digest.alias("digest")), "shard-rows")
    total = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    n_items = shards * items_per_shard
    large = max(1, -(-(total["bytes"] or 0) // n_items))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("digest"), F.lit(n_items)).cast("string"))
    groups = C.written(groups.select("digest", "bytes", F.when(F.col("bytes") >= large, F.col("digest")).otherwise(bundle).alias("item")), "shard-groups")
    # At most n_items large groups and n_items bundles.
    items = sorted((r["bytes"], r["item"]) for r in groups.groupBy("item").agg(F.sum("bytes").alias("bytes")).toLocalIterator())
    parts = differencing([b for b, _ in items], shards)
    dealt = spark.createDataFrame([(item, int(p)) for (_, item), p in zip(items, parts)], "item string, shard int")
    placed = rows.join(groups.join(F.broadcast(dealt), "item").select("digest", "shard"), "digest").select("doc_id", "size", "text_crc32", "shard")
    chunks = min(CHUNKS, max(1, -(-total["rows"] // CHUNK_ROWS)))
    placed = C.written(placed.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int")), "shard-placed")
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "chunk").agg(F.count("*").alias("n")).select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    number = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32", "size"))
    return placed.withColumn("number", number).join(offsets, ["shard", "chunk"]).select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("number") - 1).alias("slot"))
