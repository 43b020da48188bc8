"""Benchmark decontamination by winnowing.

Every window of ``w`` consecutive k-grams of words keeps its k-gram of least hash, on both
sides. With k + w - 1 equal to the window's words, two texts that share a whole window keep
a common k-gram there, so the join of the kept k-grams misses no shared window. Each hit is
extended: all windows around it are looked up among the benchmark's different windows of that
size, each document window once, and compared with it byte by byte.

A benchmark of up to ``BLOCK_BYTES`` of different texts is indexed and broadcast with that bound;
the documents probe it inside their scan, and nothing is shuffled. A larger one stays in tables:
kept k-grams and windows (by 128 bits, not compared by bytes) are joined, see ``_joined``.

Edge cases: null or empty texts have no words, and items without words match nothing; an
item shorter than a window is one window; items with a null id count as the id ''; repeated
items and repeated documents are each handled like single ones; equal words in a row make equal
windows, which count once; no benchmark, no hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlink.llm import bytewords as B
from satlink.llm import common as C

WINDOW = 10
GRAM = 4
BLOCK_BYTES = 32 << 20
#: Whole timestamps: the default of to_json leaves out microseconds.
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position (also across texts; callers leave those out)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[j : n + j]
    return np.minimum(B.mix(out), _NONE - np.uint64(1))


def winnow(gram: np.ndarray, text: np.ndarray, size: int, k: int) -> np.ndarray:
    """Positions of kept k-grams: the least of each window of ``size`` words within a text (ties: all).

    ``text`` has the number of the text of each word.
    """
    n = len(text) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    w = size - k + 1
    whole = text[:n] == text[size - 1 :]
    least = gram[:n].copy()
    for j in range(1, w):
        np.minimum(least, gram[j : n + j], out=least)
    keep = np.zeros(len(text), bool)
    for j in range(w):
        keep[j : n + j] |= whole & (gram[j : n + j] == least)
    return np.flatnonzero(keep)


class Level:
    """The benchmark's windows of one size: kept k-grams, and each different window once."""

    def __init__(self, size: int, k: int, known: np.ndarray, hashes: np.ndarray, start: np.ndarray, sets: np.ndarray):
        self.size, self.k, self.known = size, k, known
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(known >> np.uint64(44)).astype(np.int64)] = True
        #: Sorted hashes of the different windows, where each stands first, and the number of the set of items that have it.
        self.hashes, self.start, self.sets = hashes, start, sets


class Index:
    """Windows of benchmark items by size, with the items' words and bytes."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW, gram: int = GRAM):
        # Equal texts once, with all their items.
        owners: dict[str, set[str]] = {}
        for i, t in items:
            owners.setdefault(t or "", set()).add(i)
        self.ids = sorted({i for i, _ in items})
        number = {x: i for i, x in enumerate(self.ids)}
        data = [t.encode() for t in owners]
        self.of_text = [np.array(sorted(number[i] for i in of), np.int64) for of in owners.values()]
        offsets = np.concatenate([[0], np.cumsum([len(d) for d in data], dtype=np.int64)])
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.words, self.begin, self.end, first = B.Words(B.alnum_bytes())(self.data, offsets)
        self.data = _FOLD[self.data]
        #: Different sets of items, as arrays of their numbers.
        self.sets: list[np.ndarray] = []
        named: dict[bytes, int] = {}
        self.levels = []
        for size, k, at, text, gram_hash in _levels(self.words, first, window, gram):
            kept = winnow(gram_hash, text, size, k)
            whole = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :])
            h = grams(self.words[at], size)[whole]
            pairs = np.unique(np.stack([h, text[whole].astype(np.uint64)], 1), axis=0)  # window, text
            hashes, begin, count = np.unique(pairs[:, 0], return_index=True, return_counts=True)
            _, where = np.unique(h, return_index=True)
            sets = np.empty(len(hashes), np.int64)
            for i, (a, n) in enumerate(zip(begin.tolist(), count.tolist())):
                of = pairs[a : a + n, 1].astype(np.int64)
                owned = self.of_text[of[0]] if n == 1 else np.unique(np.concatenate([self.of_text[x] for x in of]))
                name = owned.tobytes()
                if name not in named:
                    named[name] = len(self.sets)
                    self.sets.append(owned)
                sets[i] = named[name]
            self.levels.append(Level(size, k, np.unique(gram_hash[kept]), hashes, at[whole[where]], sets))


def _levels(words: np.ndarray, first: np.ndarray, window: int, gram: int, sizes: list[int] | None = None):
    """(size, k, word positions, text of each, hash of the k words from each) of the items that have windows of a size."""
    count = np.diff(first)
    for size in sorted({min(int(c), window) for c in count if c}):
        mine = np.flatnonzero((count == size) if size < window else (count >= size))
        at = np.concatenate([np.arange(first[i], first[i + 1]) for i in mine])
        k = min(gram, size)
        yield size, k, at, np.repeat(mine, count[mine]), grams(words[at], k)


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def candidates(words: np.ndarray, text: np.ndarray, size: int, k: int, known) -> np.ndarray:
    """Starts of the document windows that hold a kept k-gram for which ``known(hashes)`` is true; each once."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    gram = grams(words, k)
    p = winnow(gram, text, size, k)
    p = p[known(gram[p])]
    begins = np.zeros(len(words), bool)
    for back in range(size - k + 1):  # the window begins so many words before the k-gram
        begins[p[p >= back] - back] = True
    begins = np.flatnonzero(begins[:n])
    return begins[text[begins] == text[begins + size - 1]]


def same_words(index: Index, data: np.ndarray, begin: np.ndarray, end: np.ndarray, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Whether document words and index words (numbers) are equal byte by byte; ``data`` is folded."""
    out = (end[mine] - begin[mine]) == (index.end[theirs] - index.begin[theirs])
    length = np.where(out, end[mine] - begin[mine], 0)
    for n in np.unique(length[out]):
        for at in np.array_split(np.flatnonzero(length == n), max(1, int(n) * int((length == n).sum()) >> 22)):
            span = np.arange(n)
            out[at] = (data[begin[mine[at]][:, None] + span] == index.data[index.begin[theirs[at]][:, None] + span]).all(axis=1)
    return out


def hits(index: Index, words: np.ndarray, first: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hit, pairs): whether each document word lies in an occurrence, and rows (text, item) of items that occur.

    Every document window is looked up once, whatever the number of its places in the benchmark;
    a window found by its hash counts if its words are equal byte by byte.
    """
    cover = np.zeros(len(words) + 1, np.int64)
    found = []
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for level in index.levels:
        size = level.size

        def known(h, level=level):
            ok = level.seen[(h >> np.uint64(44)).astype(np.int64)]
            at = np.searchsorted(level.known, h[ok])
            ok[ok] = level.known[np.minimum(at, len(level.known) - 1)] == h[ok]
            return ok

        start = candidates(words, text, size, level.k, known)
        if not len(start):
            continue
        h = grams(words, size)[start]
        at = np.minimum(np.searchsorted(level.hashes, h), len(level.hashes) - 1)
        ok = level.hashes[at] == h
        start, at = start[ok], at[ok]
        mine = (start[:, None] + np.arange(size)).ravel()
        theirs = (level.start[at][:, None] + np.arange(size)).ravel()
        pairs, back = np.unique(mine * np.int64(len(index.words)) + theirs, return_inverse=True)
        equal = same_words(index, data, begin, end, pairs // len(index.words), pairs % len(index.words))
        ok = equal[back].reshape(-1, size).all(axis=1)
        start, at = start[ok], at[ok]
        cover[start] += 1
        cover[start + size] -= 1  # starts differ, so no place is met twice
        if len(start):
            found.append(np.unique(np.stack([text[start], level.sets[at]], 1), axis=0))
    hit = np.cumsum(cover[:-1]) > 0
    if not found:
        return hit, np.zeros((0, 2), np.int64)
    found = np.unique(np.concatenate(found), axis=0)
    owned = [index.sets[s] for s in found[:, 1]]
    return hit, np.unique(np.stack([np.repeat(found[:, 0], [len(o) for o in owned]), np.concatenate(owned)], 1), axis=0)


def items_of(benchmark: DataFrame) -> DataFrame:
    """The different items: item_id (as text, null: empty), text."""
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").alias("text")).distinct()


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of ``block_bytes`` of text that the different items make: one is broadcast, more are joined."""
    return max(1, -(-C.text_bytes(items_of(benchmark)) // block_bytes))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, window: int = WINDOW, gram: int = GRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: ``keep`` columns (default doc_id), n_words, n_hit, item_ids (sorted array<string>), contaminated."""
    spark = docs.sparkSession
    C.python_tasks(spark)
    keep = keep or ["doc_id"]
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType(fields + [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType()))])
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    if blocks_of(benchmark, block_bytes) == 1:
        index = Index([(r.item_id, r.text) for r in items_of(benchmark).collect()], window, gram)
        found = source.mapInArrow(C.task("decontaminate", _probe(spark.sparkContext.broadcast(index), keep)), schema)
    else:
        found = _joined(source, items_of(benchmark), schema, keep, window, gram)
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def _probe(broadcast, keep: list[str]):
    """The task of a benchmark that fits one block."""
    split = B.Words(B.alnum_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = broadcast.value
        ids = np.array(index.ids, object)
        for batch in C.merged(batches):
            data, offsets = C.utf8(batch.column("text"))
            words, begin, end, first = split(data, offsets)
            hit, pairs = hits(index, words, first, _FOLD[data], begin, end)
            total = np.concatenate([[0], np.cumsum(hit)])
            per_doc = np.split(ids[pairs[:, 1]] if len(pairs) else ids[:0], np.searchsorted(pairs[:, 0], np.arange(1, batch.num_rows)))
            out = [pa.array(np.diff(first)), pa.array(total[first[1:]] - total[first[:-1]]), pa.array([sorted(x) for x in per_doc], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + out, names=[*keep, "n_words", "n_hit", "item_ids"])

    return run


# ------------------------------------------------------- a benchmark of more than one block

def _pair(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of the window from each word."""
    return grams(words, size), B.mix(grams(B.mix(words + np.uint64(0x5851F42D4C957F2D)), size))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _item_windows(window: int, gram: int):
    split = B.Words(B.alnum_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            words, _, _, first = split(*C.utf8(batch.column("text")))
            ids = batch.column("item_id")
            for size, k, at, text, gram_hash in _levels(words, first, window, gram):
                kept = np.unique(gram_hash[winnow(gram_hash, text, size, k)])
                none = pa.nulls(len(kept), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(kept), size, np.int32)), _long(kept), pa.nulls(len(kept), pa.int64()), none], names=["size", "a", "b", "item_id"])
                whole = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :])
                a, b = (x[whole] for x in _pair(words[at], size))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), size, np.int32)), _long(a), _long(b), ids.take(pa.array(text[whole])).cast(pa.string())], names=["size", "a", "b", "item_id"])

    return run


def _document_grams(key: str, sizes: list[int], gram: int):
    """(key, n_words, size, gram) for the different kept k-grams of every document; a row without size where it has none."""
    split = B.Words(B.alnum_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            words, _, _, first = split(*C.utf8(batch.column("text")))
            text = np.repeat(np.arange(batch.num_rows), np.diff(first))
            rows, level, found = [np.arange(batch.num_rows)], [np.zeros(batch.num_rows, np.int32)], [np.zeros(batch.num_rows, np.uint64)]
            for size in sizes:
                k = min(gram, size)
                hashes = grams(words, k)
                p = winnow(hashes, text, size, k)
                order = np.lexsort((hashes[p], text[p]))
                p = p[order]
                p = p[np.concatenate([[True], (text[p][1:] != text[p][:-1]) | (hashes[p][1:] != hashes[p][:-1])])] if len(p) else p
                rows.append(text[p]), level.append(np.full(len(p), size, np.int32)), found.append(hashes[p])
            row = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).cast(pa.string()).take(pa.array(row)), pa.array(np.diff(first)[row]), pa.array(np.concatenate(level)), _long(np.concatenate(found))], names=[key, "n_words", "size", "gram"])

    return run


def _document_windows(key: str, gram: int):
    """(key, size, a, b, start) of the windows around the k-grams that the benchmark has, too."""
    split = B.Words(B.alnum_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text, shared in zip(*(batch.column(c).to_pylist() for c in (key, "text", "shared"))):
                data = np.frombuffer((text or "").encode(), np.uint8)
                words = split(data, np.array([0, len(data)]))[0]
                for size in {s["size"] for s in shared}:
                    mine = np.array([s["gram"] for s in shared if s["size"] == size], np.int64).view(np.uint64)
                    start = candidates(words, np.zeros(len(words), np.int64), size, min(gram, size), lambda h: np.isin(h, mine))
                    a, b = (x[start] for x in _pair(words, size)) if len(start) else (np.zeros(0, np.uint64),) * 2
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(start), pa.string()), pa.array(np.full(len(start), size, np.int32)), _long(a), _long(b), pa.array(start)], names=[key, "size", "a", "b", "start"])

    return run


def _joined(source: DataFrame, items: DataFrame, schema: T.StructType, keep: list[str], window: int, gram: int) -> DataFrame:
    """Fingerprints joined as tables: no item's text leaves the executors.

    Kept k-grams of documents are joined with the benchmark's different ones (a semi join: a hot
    k-gram is one row there, and its document side is split by adaptive execution); documents
    with a match emit their windows around it, by 128 bits, which are joined with the different
    windows and their lists of items.
    """
    task = lambda run: C.task("decontaminate", run)
    bench = C.written(items.mapInArrow(task(_item_windows(window, gram)), "size int, a long, b long, item_id string").distinct(), "bench-windows")
    sizes = sorted(r.size for r in bench.select("size").distinct().collect())  # at most ``window`` numbers
    known = bench.where("b is null").select("size", F.col("a").alias("gram")).distinct()
    lists = bench.where("b is not null").groupBy("size", "a", "b").agg(F.collect_set("item_id").alias("ids"))
    key = C.free_name(source, "key")
    # Equal rows give equal hits, so a row is known by its values; its copies are counted and given back.
    options = {"ignoreNullFields": "false", "timestampFormat": _MICROS, "timestampNTZFormat": _MICROS.removesuffix("XXX")}
    source = source.withColumn(key, F.sha2(F.to_json(F.struct(*source.columns), options), 256))
    counts = source.groupBy(key).agg(*[F.first(c).alias(c) for c in keep], F.count("*").alias("copies"))
    prints = source.select(key, "text").mapInArrow(task(_document_grams(key, sizes, gram)), T.StructType([T.StructField(key, T.StringType()), *T._parse_datatype_string("n_words long, size int, gram long").fields]))
    prints = C.written(prints, "document-grams")
    shared = prints.join(known, ["size", "gram"], "left_semi").groupBy(key).agg(F.collect_set(F.struct("size", "gram")).alias("shared"))
    wide = T.StructType([T.StructField(key, T.StringType()), *T._parse_datatype_string("size int, a long, b long, start long").fields])
    texts = source.select(key, "text").join(shared, key).dropDuplicates([key])
    places = texts.mapInArrow(task(_document_windows(key, gram)), wide).join(lists, ["size", "a", "b"])
    found = places.groupBy(key).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("size") - 1))))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids"),
    )
    n_words = prints.where("size = 0").groupBy(key).agg(F.first("n_words").alias("n_words"))
    out = counts.join(n_words, key).join(found, key, "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select(*keep, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
