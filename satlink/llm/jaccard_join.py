"""Exact Jaccard similarity join on word shingles, by T-occurrence search over inverted lists.

Two documents link when 100 * intersection >= ``PERCENT`` * union of their sets of distinct
``SHINGLE``-word shingles.

1. A scan counts all shingles in a sketch of fixed size (``CELLS`` cells); its counts order
   shingles from rare to common, the same way everywhere.
2. A scan gives every document its set's size, a 128-bit key and its prefix: the rarest
   shingles, one of which any linked document must have in its own prefix. Documents with equal
   sets become one representative (smallest doc_id).
3. The prefixes become inverted lists. Lists of common cells are split by ``SALTS``. First only
   neighbours of a list, in order of size, are candidates: they join most groups of near copies.
4. Then, in each list that still has several components, members outside the largest one are
   candidates with all members of other components. Length and position in the prefix rule
   candidates out exactly, so no pair that can link and is not yet joined is left out. Members
   of lists longer than ``LONG`` go to blocks of about ``CHUNK`` documents instead, and the blocks
   that meet in a list are compared whole: a document is sent once for each such block, not once
   for each pair.
5. Candidates meet first with their sets' spreads, the numbers of shingles in ``CLASSES`` classes
   of hashes. Two sets share no more than the smaller number of each class, so those that cannot
   reach the overlap T leave exactly; sets without a partner left are never sent.
6. A query document and its candidates, or two blocks, meet with their whole sets: the sets form
   inverted lists, DivideSkip sets the longest aside, heap-merges the short ones and probes the
   long ones by binary search, and keeps candidates that reach the overlap T.

Equal sets cost one row per task, and groups of near copies are never expanded into all pairs.

Edge cases: a document of fewer than ``SHINGLE`` words has its whole sequence as one shingle;
null and empty texts, or texts without words, have an empty set and are alone; rows of equal
doc_id count as one document, linked if any of their texts are; a row without doc_id is alone,
with a null component; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satlink.llm import bytewords as B
from satlink.llm import common as C
from satlink.llm import components
from satlink.llm.decontaminate import grams

SHINGLE, PERCENT = 4, 85
CELLS = 1 << 20
SLICES = 16
SALTS = 64
CHUNK = 64
LONG = 32
#: Candidate rows that may be broadcast (32 bytes each); beyond, the documents they name are shuffled instead.
BROADCAST_ROWS = 1_000_000
#: Classes of a spread, a byte each. A class of ``FULL`` shingles or more bounds nothing.
CLASSES, FULL = 256, 255
#: Bits that tell which documents are named by too many rows to broadcast (4 MB).
MARKS = 1 << 25
#: A cell is common when it holds this many times the mean, and this many occurrences.
COMMON_TIMES, COMMON_LEAST = 16, 8192
_WORDS = B.Words(B.nonspace_bytes())
_48 = np.uint64((1 << 48) - 1)


def shingle_sets(batch: pa.RecordBatch, size: int = SHINGLE) -> list[np.ndarray]:
    """The set (sorted hashes) of each text of a batch."""
    words, _, _, first = _WORDS(*C.utf8(batch.column("text")))
    gram = grams(words, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(gram[a : b - size + 1]))
        elif b > a:
            out.append(grams(words[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(words[:0])
    return out


def required(n: int, m: int, percent: int = PERCENT) -> int:
    """Least intersection of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def frequency_sketch(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """Occurrences of shingle hashes by their top 20 bits, over all documents: 4 MB, whatever the input."""
    part = CELLS // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.uint64)
        for batch in C.merged(batches):
            sets = shingle_sets(batch, size)
            total += np.bincount((np.concatenate(sets) >> np.uint64(44)).astype(np.int64), minlength=CELLS).astype(np.uint64)
        squeeze = zstandard.ZstdCompressor(level=3).compress
        yield pa.RecordBatch.from_pydict({"slice": list(range(SLICES)), "counts": [squeeze(total[i * part : (i + 1) * part].tobytes()) for i in range(SLICES)]}, schema=arrow)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        loose = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i, data in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                totals[i] = totals.get(i, 0) + np.frombuffer(loose(data), np.uint64)
        yield pa.RecordBatch.from_pydict({"slice": list(totals), "counts": [t.tobytes() for t in totals.values()]}, schema=arrow)

    arrow = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])
    schema = "slice int, counts binary"
    out = np.zeros(CELLS, np.uint64)
    for r in docs.select("text").mapInArrow(C.task("jaccard_join", count), schema).repartition(SLICES, "slice").mapInArrow(C.task("jaccard_join", add), schema).collect():
        out[r["slice"] * part : (r["slice"] + 1) * part] = np.frombuffer(r["counts"], np.uint64)
    return np.minimum(out, np.uint64(0xFFFFFFFF)).astype(np.uint32)


class Inverted:
    """Inverted lists of some sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        token = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.lexsort((owner, token))
        self.token, self.owner = token[order], owner[order]

    def search(self, query: np.ndarray, need: dict[int, int]) -> list[int]:
        """Numbers i of the sets that share at least need[i] shingles with the query, by DivideSkip."""
        lo, hi = np.searchsorted(self.token, query, "left"), np.searchsorted(self.token, query, "right")
        length = hi - lo
        by_length = np.argsort(length, kind="stable")
        by_length = by_length[length[by_length] > 0]
        if not len(by_length) or not need:
            return []
        least = min(need.values())
        aside = max(0, min(int(least / (0.01 * log2(length[by_length[-1]] + 1) + 1)), least - 1, len(by_length) - 1))
        short, probes = by_length[: len(by_length) - aside], np.sort(query[by_length[len(by_length) - aside :]])
        lists = [self.owner[a:b].tolist() for a, b in zip(lo[short].tolist(), hi[short].tolist())]
        found = []
        for i, same in groupby(heapq.merge(*lists)):
            if (t := need.get(i)) is None:
                continue
            count = sum(1 for _ in same)
            if count < t - aside:
                continue
            if aside:  # whether the set is in the long lists: a binary search for each
                mine = self.sets[i]
                at = np.minimum(np.searchsorted(mine, probes), len(mine) - 1)
                count += int((mine[at] == probes).sum())
            if count >= t:
                found.append(i)
        return found


def spread(s: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall into each class of hashes."""
    return np.minimum(np.bincount((s % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES), FULL).astype(np.uint8)


def _documents(docs: DataFrame, sketch, size: int, percent: int) -> DataFrame:
    """Rows (doc_id, n, k1, k2, spread, prefix) of documents with a set; the prefix from rare to common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            n, k1, k2, spreads, prefix = [], [], [], [], []
            for s in shingle_sets(batch, size):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    k1.append(int(B.mix(s).sum(dtype=np.uint64).view(np.int64)))
                    k2.append(int(B.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                spreads.append(spread(s).tobytes())
                p = len(s) - -(-percent * len(s) // 100) + 1 if len(s) else 0
                prefix.append(s[np.lexsort((s, sketch.value[(s >> np.uint64(44)).astype(np.int64)]))[:p]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(spreads, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))], names=["doc_id", "n", "k1", "k2", "spread", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(C.task("jaccard_join", run), "doc_id long, n int, k1 long, k2 long, spread binary, prefix array<long>")


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _representatives(known: DataFrame) -> DataFrame:
    """One row (rep, n, prefix) for each set, that of its smallest doc_id.

    Only the keys of the sets are shuffled: most sets are there once, and their rows stay where they are.
    """
    known = known.where("n > 0 and doc_id is not null").select("doc_id", "n", "k1", "k2", "prefix")
    again = known.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    again = C.cut(again)
    if again.count() > BROADCAST_ROWS:  # the sets meet by a shuffle in any case: one of all rows
        return known.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix")).drop("k1", "k2")
    again = F.broadcast(again)
    once = known.join(again.drop("rep"), ["k1", "k2"], "left_anti").select(F.col("doc_id").alias("rep"), "n", "prefix")
    first = known.join(again, ["k1", "k2"]).where("doc_id = rep").groupBy("k1", "k2").agg(F.first("rep").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    return once.unionByName(first.drop("k1", "k2"))


def _lists(reps: DataFrame, sketch) -> DataFrame:
    """Inverted lists of the prefixes: (token, salt, rep, n, rank). Tokens of common cells are salted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = sketch.value
        common = max(COMMON_LEAST, COMMON_TIMES * float(cells.mean()))
        for batch in batches:
            prefix = batch.column("prefix")
            if isinstance(prefix, pa.ChunkedArray):
                prefix = prefix.combine_chunks()
            token = prefix.flatten().to_numpy(zero_copy_only=False)
            length = prefix.value_lengths().to_numpy(zero_copy_only=False)
            rep = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), length)
            rank = np.arange(len(token)) - np.repeat(np.cumsum(length) - length, length)
            hot = cells[(token.view(np.uint64) >> np.uint64(44)).astype(np.int64)] >= common
            salt = np.where(hot, (B.mix(rep.view(np.uint64)) % np.uint64(SALTS)).astype(np.int64), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), pa.array(salt.astype(np.int32)), pa.array(rep), pa.array(np.repeat(batch.column("n").to_numpy(zero_copy_only=False), length).astype(np.int32)), pa.array(rank.astype(np.int32))],
                names=["token", "salt", "rep", "n", "rank"],
            )

    return reps.select("rep", "n", "prefix").mapInArrow(C.task("jaccard_join", run), "token long, salt int, rep long, n int, rank int")


def _may_link(n, rank, m, other_rank, percent: int):
    """Length and positional filter for members (n, rank) and (m, other_rank) of a list, n <= m."""
    need = F.ceil(F.lit(percent) * (n + m).cast("double") / F.lit(100 + percent) - F.lit(1e-9))
    left = F.least(n - rank, m - other_rank)
    return (F.lit(100) * n >= F.lit(percent) * m) & (left >= need)


def _pair_roles(pairs: DataFrame) -> DataFrame:
    """Roles for candidate pairs (a, b): b is the query of up to CHUNK candidates a."""
    chunk = F.floor((F.row_number().over(Window.partitionBy("b").orderBy("a")) - 1) / F.lit(CHUNK)).cast("long")
    pairs = C.cut(pairs.withColumn("chunk", chunk))
    alone = F.lit(None).cast("long").alias("root")
    candidates = pairs.select(F.col("a").alias("doc_id"), F.col("b").alias("x"), F.col("chunk").alias("y"), F.lit(1).alias("role"), alone)
    return candidates.unionByName(pairs.select(F.col("b").alias("doc_id"), F.col("b").alias("x"), F.col("chunk").alias("y"), F.lit(0).alias("role"), alone).distinct())


def _block_roles(long_: DataFrame) -> DataFrame:
    """Roles for long lists (token, members, rep, root): the blocks that meet in a list.

    A document is at home in its longest list. Documents of one home form blocks, those of a
    large component by themselves, so that blocks of one component need not be compared.
    """
    home = C.cut(long_.groupBy("rep").agg(F.max_by("token", F.struct("members", "token")).alias("home"), F.first("root").alias("root")))
    large = home.groupBy("home", "root").agg(F.count("*").alias("same")).where(F.col("same") >= CHUNK)
    home = home.join(large, ["home", "root"], "left").withColumn("pure", F.when(F.col("same").isNotNull(), F.col("root")))
    home = home.withColumn("group", F.xxhash64("home", F.coalesce("pure", F.lit(-1))))
    home = home.join(home.groupBy("group").agg(F.count("*").alias("size")), "group")
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / F.lit(CHUNK)))
    blocks = C.cut(home.select("rep", "root", "pure", F.xxhash64("group", part).alias("block")))
    met = C.cut(long_.select("token", "rep").join(blocks.select("rep", "block", "pure"), "rep").select("token", "block", "pure").distinct())
    x, y = met.select("token", F.col("block").alias("x"), F.col("pure").alias("x_pure")), met.select("token", F.col("block").alias("y"), F.col("pure").alias("y_pure"))
    tiles = x.join(y, "token").where("x <= y and not coalesce(x_pure = y_pure, false)").select("x", "y").distinct()
    members = blocks.select(F.col("rep").alias("doc_id"), "root", "block")
    first = tiles.join(members, F.col("x") == F.col("block")).select("doc_id", "x", "y", F.when(F.col("x") == F.col("y"), 2).otherwise(1).alias("role"), "root")
    return first.unionByName(tiles.where("x <> y").join(members, F.col("y") == F.col("block")).select("doc_id", "x", "y", F.lit(0).alias("role"), "root"))


_ROLE = "x long, y long, role int, root long, doc_id long"
_NAMES = ("x", "y", "role", "root", "doc_id")


def _may_reach(known: DataFrame, roles: DataFrame, percent: int) -> DataFrame:
    """The roles of documents that can link with another one under their key, by the spreads of their sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, met, out = None, [], []

        def close() -> None:
            queries = [i for i, row in enumerate(met) if row[2] != 1]
            held = [i for i, row in enumerate(met) if row[2] != 0]
            if not queries or not held:
                return
            n = np.array([row[5] for row in met], np.int64)
            spreads = np.frombuffer(b"".join(row[6] for row in met), np.uint8).reshape(-1, CLASSES)
            doc = np.array([row[4] for row in met], np.int64)
            root = np.array([row[3] or 0 for row in met], np.int64)
            rooted = np.array([row[3] is not None for row in met])
            stay, at = np.zeros(len(met), bool), np.array(held)
            theirs = spreads[at]
            for i in queries:
                least = np.minimum(theirs, spreads[i])
                reach = (least.sum(axis=1, dtype=np.int64) >= -(-percent * (n[i] + n[at]) // (100 + percent))) | (least == FULL).any(axis=1)
                reach &= (doc[at] != doc[i]) & ~(rooted[at] & rooted[i] & (root[at] == root[i]))
                stay[at] |= reach
                stay[i] |= reach.any()
            out.extend(met[i][:5] for i in np.flatnonzero(stay))

        def given() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([row[k] for row in out], pa.int32() if k == 2 else pa.int64()) for k in range(5)], names=list(_NAMES))
            out.clear()
            return batch

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*_NAMES, "n", "spread"))):
                if row[:2] != key:
                    close()
                    key, met = row[:2], []
                met.append(row)
            yield given()
        close()
        yield given()

    met = known.select("doc_id", "n", "spread").where("n > 0").join(_small(roles), "doc_id").select(*_NAMES, "n", "spread")
    return met.repartition("x", "y").sortWithinPartitions("x", "y").mapInArrow(C.task("jaccard_join", run), _ROLE).distinct()


def _marked(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id has a bit that one of ``ids`` sets: all of those, and few others."""
    part = MARKS // 8 // SLICES

    def bits(column) -> np.ndarray:
        return (B.mix(pc.fill_null(column, 0).to_numpy(zero_copy_only=False).view(np.uint64)) % np.uint64(MARKS)).astype(np.int64)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(MARKS // 8, np.uint8)
        for batch in batches:
            at = bits(batch.column("doc_id"))
            np.bitwise_or.at(total, at >> 3, (1 << (at & 7)).astype(np.uint8))
        squeeze = zstandard.ZstdCompressor(level=3).compress
        yield pa.RecordBatch.from_pydict({"slice": list(range(SLICES)), "bits": [squeeze(total[i * part : (i + 1) * part].tobytes()) for i in range(SLICES)]}, schema=arrow)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        loose = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i, data in zip(batch.column("slice").to_pylist(), batch.column("bits").to_pylist()):
                totals[i] = totals.get(i, np.uint8(0)) | np.frombuffer(loose(data), np.uint8)
        yield pa.RecordBatch.from_pydict({"slice": list(totals), "bits": [t.tobytes() for t in totals.values()]}, schema=arrow)

    arrow = pa.schema([("slice", pa.int32()), ("bits", pa.binary())])
    found = np.zeros(MARKS // 8, np.uint8)
    for r in ids.mapInArrow(C.task("jaccard_join", mark), "slice int, bits binary").repartition(SLICES, "slice").mapInArrow(C.task("jaccard_join", add), "slice int, bits binary").collect():
        found[r["slice"] * part : (r["slice"] + 1) * part] = np.frombuffer(r["bits"], np.uint8)
    marks = docs.sparkSession.sparkContext.broadcast(found)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bits(batch.column("doc_id"))
            yield batch.filter(pa.array((marks.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    return docs.mapInArrow(C.task("jaccard_join", keep), docs.schema)


def _links(docs: DataFrame, known: DataFrame, roles: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) that link, found by T-occurrence over the whole sets that meet under a key.

    roles: (doc_id, x, y, role, root); under each key (x, y) every query (role 0) searches the
    candidates (role 1), and documents of role 2 search each other; never those of its own root.
    Under a key the links are given as a forest: those that only close a circle are left out, and
    candidates that are reached already are not searched again, so a group of n near copies gives
    n - 1 rows, and components stay the same.
    """
    roles = C.cut(_may_reach(known, C.cut(roles), percent))
    docs, names = docs.select("doc_id", "text"), _NAMES
    source = docs.join(F.broadcast(roles), "doc_id") if roles.count() <= BROADCAST_ROWS else _marked(docs, roles.select("doc_id")).join(roles, "doc_id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            # The rows of a document stand together: its set is made once.
            text = batch.column("text")
            other = pc.fill_null(pc.not_equal(text.slice(1), text.slice(0, len(text) - 1)), True)
            new = np.append(True, other.to_numpy(zero_copy_only=False)).astype(bool)
            found = [(s & _48).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in shingle_sets(batch.filter(pa.array(new)), size)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(found, pa.binary()).take(pa.array(np.cumsum(new) - 1))], names=[*names, "shingles"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, queries, held, a, b = None, [], [], [], []

        def close() -> None:
            if not held or not queries:
                return
            index = Inverted([s for _, _, s in held])
            parent: dict[tuple[bool, int], tuple[bool, int]] = {}

            def top(doc: int, root: int | None) -> tuple[bool, int]:
                """What stands for all that the links found so far reach; documents of one root are reached from each other."""
                v = (root is None, doc if root is None else root)
                while parent.setdefault(v, v) != v:
                    parent[v] = v = parent[parent[v]]
                return v

            for doc, root, q in queries:
                own = top(doc, root)
                need = {i: required(len(q), len(s), percent) for i, (other, its, s) in enumerate(held) if len(s) and other != doc and top(other, its) != own}
                need = {i: t for i, t in need.items() if t <= min(len(q), len(held[i][2]))}
                for i in index.search(q, need) if need else ():
                    reached = top(held[i][0], held[i][1])
                    if reached != own:
                        parent[reached] = own
                        a.append(min(doc, held[i][0])), b.append(max(doc, held[i][0]))

        for batch in batches:
            for x, y, role, root, doc, data in zip(*(batch.column(c).to_pylist() for c in (*names, "shingles"))):
                if (x, y) != key:
                    close()
                    key, queries, held = (x, y), [], []
                raw = np.zeros((len(data) // 6, 8), np.uint8)
                raw[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
                s = np.sort(raw.reshape(-1).view(np.uint64))
                if role != 1:
                    queries.append((doc, root, s))
                if role != 0:
                    held.append((doc, root, s))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a.clear(), b.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = source.select("text", *names).mapInArrow(C.task("jaccard_join", sets), f"{_ROLE}, shingles binary")
    return dealt.repartition("x", "y").sortWithinPartitions("x", "y").mapInArrow(C.task("jaccard_join", search), "a long, b long").distinct()


def similarity_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id): the smallest doc_id that links reach."""
    spark = docs.sparkSession
    C.python_tasks(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketch = spark.sparkContext.broadcast(frequency_sketch(docs, size))
    known = C.written(_documents(docs, sketch, size, percent), "jaccard-documents")
    lists = _lists(_representatives(known), sketch)
    order = Window.partitionBy("token", "salt").orderBy("n", "rep")
    before = [F.lag(c).over(order).alias(f"last_{c}") for c in ("rep", "n", "rank")]
    lists = lists.select("*", *before, F.lead("rep").over(order).alias("next_rep"))
    # A list of one member links nothing, unless it is a salted part of a longer list.
    lists = C.written(lists.where("salt >= 0 or last_rep is not null or next_rep is not null").drop("next_rep"), "jaccard-lists")
    near = lists.where(F.col("last_rep").isNotNull() & _may_link(F.col("last_n"), F.col("last_rank"), F.col("n"), F.col("rank"), percent))
    near = near.select(F.col("last_rep").alias("a"), F.col("rep").alias("b"))
    # The first members of the parts of a salted list, one after the other.
    parts = Window.partitionBy("token").orderBy("n", "rep")
    heads = lists.where("salt >= 0 and last_rep is null").select("rep", F.lag("rep").over(parts).alias("last"))
    near = near.unionByName(heads.where("last is not null").select(F.col("last").alias("a"), F.col("rep").alias("b")))
    near = near.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    stars = components.stars(_links(docs, known, _pair_roles(near), size, percent))

    # What is left: in each list, members outside its largest component with members of other components.
    labelled = lists.join(_small(stars.select(F.col("a").alias("rep"), F.col("b").alias("root"))), "rep", "left")
    labelled = C.written(labelled.select("token", "rep", "n", "rank", F.coalesce("root", "rep").alias("root")), "jaccard-labelled")
    shares = labelled.groupBy("token", "root").agg(F.count("*").alias("share"))
    mixed = shares.groupBy("token").agg(F.max_by("root", F.struct("share", "root")).alias("largest"), F.sum("share").alias("members"), F.count("*").alias("roots")).where("roots > 1")
    mixed = C.written(labelled.join(mixed.select("token", "largest", "members"), "token"), "jaccard-mixed")
    short = mixed.where(F.col("members") <= LONG)
    x = short.where("root <> largest").select("token", *[F.col(c).alias(f"x_{c}") for c in ("rep", "n", "rank", "root", "largest")])
    small_x = F.struct("x_n", "x_rep") < F.struct("n", "rep")
    one_way = (F.col("root") == F.col("x_largest")) | small_x  # both outside the largest: once
    fits = F.when(F.col("x_n") <= F.col("n"), _may_link(F.col("x_n"), F.col("x_rank"), F.col("n"), F.col("rank"), percent)).otherwise(_may_link(F.col("n"), F.col("rank"), F.col("x_n"), F.col("x_rank"), percent))
    rest = x.join(short.select("token", "rep", "n", "rank", "root"), "token").where((F.col("root") != F.col("x_root")) & one_way & fits)
    rest = rest.select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b")).distinct()
    blocks = _block_roles(mixed.where(F.col("members") > LONG).select("token", "members", "rep", "root"))
    more = _links(docs, known, _pair_roles(rest).unionByName(blocks), size, percent)
    stars = components.stars(stars.unionByName(more))

    class_of = known.where("n > 0 and doc_id is not null").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")).join(stars.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left")
    class_of = class_of.select("k1", "k2", F.coalesce("root", "rep").alias("root"))
    linked = known.select("doc_id", "n", "k1", "k2").join(class_of, ["k1", "k2"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("root")).otherwise(F.col("doc_id"))
    return linked.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))
