"""Removal of repeated byte strings by longest-previous-factor arrays over dealt suffixes.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier (smaller doc_id, or
earlier in the same document) leaves. Strings are judged on the input; matches never cross
documents.

A suffix array of the whole corpus would need one machine, but only matches of ``LENGTH`` bytes
count, so the suffixes are dealt by content:

1. Each string of ``LENGTH`` bytes is filed under the ``GRAM``-byte substring of least hash in it
   (the first, if equal). Equal strings have the same one in the same place. Neighbouring
   strings share it, so a document becomes runs of strings, one in about 35 bytes.
2. Runs go to buckets by that hash: packed with a hash of all their bytes, after every task has
   set aside runs whose bytes it has met earlier. In a bucket, a run with the bytes of an earlier
   run is removed. Runs that share the hash but not all bytes may still share strings; the
   first of each such kind is asked for. Runs of hot hashes, found in a sample, go to buckets by
   hash and bytes, and all their kinds are asked for.
3. The bytes of those runs are fetched and dealt by the hash; those of common hashes string by
   string, after every task has set aside the strings that it has met earlier.
   There their suffixes are sorted by ``LENGTH`` bytes (prefix doubling; equal ones by position).
   In suffix order the earlier suffix that matches one furthest is the nearest before or after it
   with a smaller position; the longer of the two matches is its longest previous factor, and
   where that reaches ``LENGTH`` the string is removed.
4. Documents lose the union of their removed strings.

So equal runs leave by their 64-bit hash (2), and all other repeats by the LPF array (3).

Texts are shuffled once (the exchange by document serves both 3 and 4), runs take about 19
bytes each, and memory is bounded by batches and buckets.

Edge cases: null and empty texts have no bytes; texts under ``LENGTH`` bytes are kept whole; rows
of equal doc_id and text are one document (each keeps its bytes); of equal doc_id and other text,
the crc32 of the text orders them; rows without doc_id come after all others; other columns are
ignored by ``spans`` and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlink.llm import bytewords as B
from satlink.llm import common as C

LENGTH, GRAM = 100, 32
#: Text that a map task gathers before it packs its runs, and text of a bucket.
FLUSH_BYTES, BUCKET_BYTES = 12 << 20, 8 << 20
#: Text that the numpy code works on at once: it takes some 100 bytes of memory a byte.
SLICE = (1 << 20) - 1024
#: Runs of one hash in a bucket from which their strings are dealt one by one.
COMMON = 4096
#: A hash is hot, so that its runs go to many buckets, with HOT runs as estimated from a sample of
#: about SAMPLE_BYTES of files, and HOT_LEAST runs in the sample. Smaller inputs have no hot hash.
SAMPLE_BYTES, HOT, HOT_LEAST = 32 << 20, 4 * COMMON, 16
#: Different strings of common hashes that a task compares before it sends their first positions.
HELD_STRINGS = 100_000
_VALUES = B.byte_values(False)
_48 = np.uint64((1 << 48) - 1)


# ---------------------------------------------------------------- suffix order within a task

def suffix_order(data: np.ndarray, ends: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]:
    """(suffix array, rank, levels) of the positions with at least ``length`` bytes before their end.

    Suffixes are compared within ``length`` bytes and by group first; equal ones have equal ranks
    and stand by position. Prefix doubling: the rank by 2h bytes comes from two ranks by h bytes.
    ``levels`` has the ranks by 1, 2, 4 ... bytes.
    """
    n = len(data)
    at = np.arange(n)
    left = ends - at
    rank = np.unique(group * 256 + data, return_inverse=True)[1].astype(np.int64) + 1
    have, levels = 1, {}
    while have < length:
        levels[have] = rank.astype(np.uint32) if n < 1 << 32 else rank
        step = min(have, length - have)
        after = np.zeros(n, np.int64)
        ok = left > step
        after[ok] = rank[at[ok] + step]
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        have += step
    if not levels:
        levels[1] = rank
    whole = np.flatnonzero(left >= length)
    sa = whole[np.argsort(rank[whole], kind="stable")]
    return sa, rank, levels


def smaller_neighbours(sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a suffix array, the nearest places before and after with a smaller position (-1: none).

    All places at once: who points at a larger position takes over what that one points at, so
    pointers double their reach with every round.
    """
    out = []
    for values in (sa, sa[::-1]):
        # Place 0 is a sentinel below all positions.
        padded = np.concatenate([[-1], values])
        to = np.arange(-1, len(values))
        to[0] = 0
        wrong = np.flatnonzero(padded[to] > padded)
        while len(wrong):
            to[wrong] = to[to[wrong]]
            wrong = wrong[padded[to[wrong]] > padded[wrong]]
        out.append(to[1:] - 1)
    before, after = out
    after = after[::-1]
    return before, np.where(after >= 0, len(sa) - 1 - after, -1)


def match_lengths(levels: dict[int, np.ndarray], left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes in which the suffixes from a and b agree (to twice the longest level), from ranks by 1, 2, 4 ... bytes."""
    n = len(left)
    most = np.minimum(left[a], left[b])
    out = np.zeros(len(a), np.int64)
    longest = max(levels)
    for h in [longest, *sorted(levels, reverse=True)]:
        i, j = a + out, b + out
        ok = (out < most) & (i < n) & (j < n)
        ok[ok] = levels[h][i[ok]] == levels[h][j[ok]]
        out[ok] += h
    return np.minimum(out, most)


def longest_previous_factors(sa: np.ndarray, levels: dict[int, np.ndarray], left: np.ndarray) -> np.ndarray:
    """LPF of each place of the suffix array: its longest match with a suffix of smaller position."""
    out = np.zeros(len(sa), np.int64)
    for places in smaller_neighbours(sa):
        at = np.flatnonzero(places >= 0)
        out[at] = np.maximum(out[at], match_lengths(levels, left, sa[at], sa[places[at]]))
    return out


def repeated(data: np.ndarray, ends: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Positions whose longest previous factor within their group reaches ``length``."""
    sa, _, levels = suffix_order(data, ends, group, length)
    return sa[longest_previous_factors(sa, levels, ends - np.arange(len(data))) >= length]


# ------------------------------------------------------------------------------- runs

def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Runs of strings filed under one gram, of all texts of a batch.

    doc: number of the text; start, last: first bytes of the first and last string; place: of the
    gram; key: its hash; all: hash of the run's bytes.
    """
    n = len(data)
    none = {k: np.zeros(0, np.int64) for k in ("doc", "start", "last", "place")} | {k: np.zeros(0, np.uint64) for k in ("key", "all")}
    if n < length:
        return none
    sums = B.prefix(_VALUES[data])
    at = np.arange(n - gram + 1)
    key = B.mix(B.hash_range(sums, at, at + gram))
    # The least of `size` hashes from each place, by doubling; the place breaks ties towards the left.
    size = length - gram + 1
    bits = max(1, int(n).bit_length())
    packed = (key >> np.uint64(bits) << np.uint64(bits)) | at.astype(np.uint64)
    have = 1
    while have < size:
        step = min(have, size - have)
        packed = np.minimum(packed[: len(packed) - step], packed[step:])
        have += step
    place = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
    count = np.diff(offsets)
    doc = np.repeat(np.arange(len(count)), np.maximum(count - length + 1, 0))
    first = np.repeat(offsets[:-1], np.maximum(count - length + 1, 0))
    within = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(count - length + 1, 0)) - np.maximum(count - length + 1, 0), np.maximum(count - length + 1, 0))
    start = first + within
    if not len(start):
        return none
    place = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(start)) - 1
    s, e, p, d = start[begin], start[end], place[begin], doc[begin]
    whole = B.mix(B.hash_range(sums, s, e + length) + ((e - s) * 256 + (p - s)).astype(np.uint64))
    base = offsets[:-1][d]
    return {"doc": d, "start": s - base, "last": e - base, "place": p - base, "key": key[p], "all": whole}


def union_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint spans, in order, that cover the same bytes; touching ones become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return start[first], reach[np.append(first[1:], len(start)) - 1]


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _eight(data: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8, 6 * n).reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


def pack_runs(ids: np.ndarray, crc: np.ndarray, doc: np.ndarray, key: np.ndarray, whole: np.ndarray, start: np.ndarray, last: np.ndarray, place: np.ndarray) -> bytes:
    """Runs of one bucket from one task, in order of document: 14 bytes of hashes each, the rest squeezed."""
    used, doc = np.unique(doc, return_inverse=True)
    span, offset = last - start, place - start
    # A run has at most length - gram strings and offsets: one byte each by default.
    small = np.min_scalar_type(int(max(span.max(initial=0), offset.max(initial=0))))
    parts = [np.diff(ids[used], prepend=0), crc[used].astype(np.uint32), np.diff(doc, prepend=0).astype(np.uint32), start.astype(np.uint32), span.astype(small), offset.astype(small)]
    rest = zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))
    return np.array([len(key), len(used), small.itemsize], np.int64).tobytes() + _six(key) + whole.astype("<u8").tobytes() + rest


def unpack_runs(data: bytes) -> dict[str, np.ndarray]:
    n, docs, width = np.frombuffer(data, np.int64, 3).tolist()
    rest = zstandard.ZstdDecompressor().decompress(data[24 + 14 * n :])
    at, out, small = 0, [], np.dtype(f"u{width}")
    for kind, count in ((np.int64, docs), (np.uint32, docs), (np.uint32, n), (np.uint32, n), (small, n), (small, n)):
        out.append(np.frombuffer(rest, kind, count, at))
        at += out[-1].nbytes
    out[4:] = [x.astype(np.int64) for x in out[4:]]
    ids, crc = np.cumsum(out[0]), out[1].astype(np.int64)
    doc, start = np.cumsum(out[2].astype(np.int64)), out[3].astype(np.int64)
    return {"key": _eight(data[24 : 24 + 6 * n], n), "all": np.frombuffer(data, "<u8", n, 24 + 6 * n), "id": ids[doc], "crc": crc[doc], "start": start, "last": start + out[4], "place": start + out[5]}


def _firsts(key: np.ndarray, whole: np.ndarray, id_: np.ndarray, crc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first, repeat) after sorting by hash, bytes and position: the first run of its bytes, and runs that repeat an earlier one."""
    order = np.lexsort((start, crc, id_, whole, key))
    k, w = key[order], whole[order]
    first = np.ones(len(order), bool)
    first[1:] = (k[1:] != k[:-1]) | (w[1:] != w[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    at = [x[order] for x in (id_, crc, start)]
    repeat = np.zeros(len(order), bool)
    for x in at:
        repeat |= x != x[head]
    return order, first, repeat


_BUCKET = pa.schema([("bucket", pa.int32()), ("spans", pa.bool_()), ("data", pa.binary())])
_FOUND = "id long, crc long, request boolean, key long, common boolean, start int, end int, place int"
_NO_ID = (1 << 63) - 1


def _base(docs: DataFrame, carry: list[str]) -> DataFrame:
    """(id, crc, text, row): what tells documents apart, never null, the text, and a struct of the columns to carry."""
    row = [F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []
    id_, crc = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), F.coalesce(F.crc32("text"), F.lit(0))
    return docs.select(id_.alias("id"), crc.alias("crc"), F.coalesce("text", F.lit("")).alias("text"), *row)


def hot_keys(base: DataFrame, size: int, length: int, gram: int) -> np.ndarray:
    """Hashes (48 bits, sorted) with so many different runs that one bucket could not hold them; size: bytes of files."""
    n = -(-size // SAMPLE_BYTES)
    if n < 2:
        return np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches, most=SLICE):
            r = runs(*C.utf8(batch.column("text")), length, gram)
            kind = np.unique(np.stack([r["key"] & _48, r["all"]], 1).view(np.int64), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(kind[:, 0]), pa.array(kind[:, 1])], names=["key", "all"])

    sample = base.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == 0).select("text")
    many = sample.mapInArrow(C.task("suffix_dedup", run), "key long, all long").distinct().groupBy("key").count().where(F.col("count") >= max(HOT_LEAST, HOT / n))
    return np.array(sorted(r["key"] for r in many.select("key").collect()), np.int64).view(np.uint64)


def bucket_of(key: np.ndarray, whole: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each run: equal runs share one, and so do all runs of a hash that is not hot."""
    return (B.mix(np.where(np.isin(key, hot), B.mix(key) ^ whole, key)) % np.uint64(buckets)).astype(np.int64)


def _found(base: DataFrame, buckets: int, length: int, gram: int, hot: np.ndarray) -> DataFrame:
    """Steps 1 and 2: removed spans (start, end), and requests for the bytes of runs."""
    hot = base.sparkSession.sparkContext.broadcast(hot)

    def flush(held: list[dict], ids: list, crcs: list) -> Iterator[pa.RecordBatch]:
        r = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
        ids, crc = np.concatenate(ids), np.concatenate(crcs)
        rank = np.empty(len(ids), np.int64)  # documents in order of (id, crc), so that ids are packed as steps
        order = np.lexsort((crc, ids))
        rank[order] = np.arange(len(ids))
        ids, crc, r["doc"] = ids[order], crc[order], rank[r["doc"]]
        key, whole = r["key"] & _48, r["all"]
        order, first, repeat = _firsts(key, whole, ids[r["doc"]], crc[r["doc"]], r["start"])
        gone = order[repeat]
        gone = gone[np.lexsort((r["start"][gone], r["doc"][gone]))]
        # Spans of repeats within the task: neighbouring runs of a document become one.
        shift = r["doc"][gone] * (1 << 40)
        s, e = union_spans(r["start"][gone] + shift, r["last"][gone] + length + shift)
        doc = s >> 40
        spans = np.stack([ids[doc], crc[doc], s - (doc << 40), e - (doc << 40)]) if len(s) else np.zeros((4, 0), np.int64)
        keep = order[first]
        bucket = bucket_of(key, whole, hot.value, buckets)
        keep = keep[np.lexsort((r["start"][keep], r["doc"][keep], bucket[keep]))]
        bucket = bucket[keep]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        out: list[tuple] = []
        for part in np.split(np.arange(len(keep)), cuts):
            if len(part):
                i = keep[part]
                out.append((int(bucket[part[0]]), False, pack_runs(ids, crc, r["doc"][i], key[i], whole[i], r["start"][i], r["last"][i], r["place"][i])))
        for part in np.array_split(np.arange(spans.shape[1]), max(1, spans.shape[1] // 4096)):
            if len(part):
                out.append((int(spans[0, part[0]] % buckets), True, spans[:, part].tobytes()))
        for at in range(0, len(out), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at : at + 64]), _BUCKET)], schema=_BUCKET)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, crcs, docs, size = [], [], [], 0, 0
        for batch in C.merged(batches, most=SLICE):
            data, offsets = C.utf8(batch.column("text"))
            r = runs(data, offsets, length, gram)
            r["doc"] = r["doc"] + docs
            held.append(r)
            ids.append(batch.column("id").to_numpy(zero_copy_only=False)), crcs.append(batch.column("crc").to_numpy(zero_copy_only=False))
            docs, size = docs + batch.num_rows, size + len(data)
            if size >= FLUSH_BYTES:
                yield from flush(held, ids, crcs)
                held, ids, crcs, docs, size = [], [], [], 0, 0
        if held:
            yield from flush(held, ids, crcs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "crc", "request", "key", "common", "start", "end", "place")

        def rows(id_, crc, request, key, common, start, end, place) -> Iterator[pa.RecordBatch]:
            n = len(id_)
            columns = [id_, crc, np.full(n, request), key.view(np.int64) if len(key) else np.zeros(n, np.int64), common, start.astype(np.int32), end.astype(np.int32), place.astype(np.int32)]
            for at in range(0, n, 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 50_000]) for c in columns], names=names)

        def bucket(held: list[dict]) -> Iterator[pa.RecordBatch]:
            r = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
            order, first, repeat = _firsts(r["key"], r["all"], r["id"], r["crc"], r["start"])
            g = order[repeat]
            no = np.zeros(len(g), np.int64)
            yield from rows(r["id"][g], r["crc"][g], False, no.view(np.uint64), no.astype(bool), r["start"][g], r["last"][g] + length, no)
            rep = order[first]
            k = r["key"][rep]  # sorted
            group = np.cumsum(np.append(True, k[1:] != k[:-1])) - 1
            kinds = np.bincount(group)[group]
            wide = np.isin(k, hot.value)  # its other runs are in other buckets
            ask, common = (kinds > 1) | wide, (kinds > COMMON) | wide
            rep, common = rep[ask], common[ask]
            yield from rows(r["id"][rep], r["crc"][rep], True, r["key"][rep], common, r["start"][rep], r["last"][rep] + length, r["place"][rep])

        held, now = [], None
        for batch in batches:  # sorted by bucket
            for b, spans, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "spans", "data"))):
                if spans:
                    x = np.frombuffer(data, np.int64).reshape(4, -1)
                    no = np.zeros(x.shape[1], np.int64)
                    yield from rows(x[0], x[1], False, no.view(np.uint64), no.astype(bool), x[2], x[3], no)
                    continue
                if b != now and held:
                    yield from bucket(held)
                    held = []
                now = b
                held.append(unpack_runs(data))
        if held:
            yield from bucket(held)

    dealt = base.select("id", "crc", "text").mapInArrow(C.task("suffix_dedup", deal), "bucket int, spans boolean, data binary")
    return dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "spans").mapInArrow(C.task("suffix_dedup", compare), _FOUND)


def _fetched(base: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Step 3, first half: the bytes of requested runs, dealt by hash; those of common hashes string by string.

    A task sends only the first position of each string of common hashes that it holds; the
    others are repeats, and their spans pass on as rows of part -1 (start, end) without bytes.
    """
    wanted = found.where("request").groupBy("id", "crc").agg(F.collect_list(F.struct("key", "common", "start", "end")).alias("wanted"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        later: list[tuple[int, int, int]] = []

        def sent(out: list[tuple]) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[at : at + 20_000]), schema)], schema=schema)

        def flush() -> Iterator[pa.RecordBatch]:
            part = []
            if first:
                data = np.frombuffer(b"".join(x for _, x in first), np.uint8)
                at = np.arange(len(first)) * length
                part = (B.mix(B.hash_range(B.prefix(_VALUES[data]), at, at + length)) >> np.uint64(34)).astype(np.int64).tolist()
            yield from sent([(key, p + 1, *place, place[2] + length, x) for ((key, x), place), p in zip(first.items(), part)])
            out, now, reach = [], None, -1
            for id_, crc, start in sorted(set(later)):  # neighbouring strings of a document become one span
                if (id_, crc) == now and start <= reach:
                    reach = start + length
                    out[-1] = (*out[-1][:5], reach, b"")
                else:
                    now, reach = (id_, crc), start + length
                    out.append((id_ ^ crc, -1, id_, crc, start, reach, b""))
            yield from sent(out)
            first.clear(), later.clear()

        for batch in C.merged(batches, most=SLICE):
            out: list[tuple] = []
            for id_, crc, text, wants in zip(*(batch.column(c).to_pylist() for c in ("id", "crc", "text", "wanted"))):
                data = text.encode()
                for key, common, start, end in {(w["key"], w["common"], w["start"], w["end"]) for w in wants}:
                    if not common:
                        out.append((key, 0, id_, crc, start, end, data[start:end]))
                        continue
                    for i in range(start, end - length + 1):
                        place, x = (id_, crc, i), (key, data[i : i + length])
                        known = first.setdefault(x, place)
                        if known > place:
                            first[x] = place
                        if known != place:
                            later.append(max(known, place))
                if len(first) >= HELD_STRINGS or len(later) >= 4 * HELD_STRINGS:
                    yield from flush()
            yield from sent(out)
        yield from flush()

    schema = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("id", pa.int64()), ("crc", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("data", pa.binary())])
    return base.join(wanted, ["id", "crc"]).mapInArrow(C.task("suffix_dedup", fetch), "key long, part int, id long, crc long, start int, end int, data binary")


def _factors(pieces: DataFrame, buckets: int, length: int) -> DataFrame:
    """Step 3, second half: spans of strings whose longest previous factor reaches ``length``."""

    names = ["id", "crc", "start", "end"]

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        passed = pc.equal(t.column("part"), -1)
        yield from t.filter(passed).select(names).to_batches()
        t = t.filter(pc.invert(passed)).combine_chunks()
        if t.num_rows:
            yield strings(t)

    def strings(t: pa.Table) -> pa.RecordBatch:
        # Rows of equal doc_id and text have asked for the same bytes: they count once.
        at = [t.column(c).to_numpy() for c in ("key", "part", "id", "crc", "start")]
        t = t.filter(pa.array(np.append(True, np.any([x[1:] != x[:-1] for x in at], axis=0)))).combine_chunks()
        data, offsets = C.utf8(t.column("data"))
        key, part = t.column("key").to_numpy(), t.column("part").to_numpy()
        new = np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1]))
        size = np.diff(offsets)
        piece = np.repeat(np.arange(len(size)), size)
        at = np.sort(repeated(data, offsets[1:][piece], (np.cumsum(new) - 1)[piece], length))
        piece = piece[at]
        start = t.column("start").to_numpy()[piece].astype(np.int64) + at - offsets[:-1][piece]
        shift = piece * (1 << 40)
        s, e = union_spans(start + shift, start + shift + length)
        piece = s >> 40
        return pa.RecordBatch.from_arrays([t.column("id").combine_chunks().take(pa.array(piece)), t.column("crc").combine_chunks().take(pa.array(piece)), pa.array((s - (piece << 40)).astype(np.int32)), pa.array((e - (piece << 40)).astype(np.int32))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:  # sorted, so that a hash's pieces are neighbours
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.column("data").nbytes + 32 * batch.num_rows
            if size < 1 << 20:
                continue
            t = pa.Table.from_batches(held)
            key, part = t.column("key").to_numpy(), t.column("part").to_numpy()
            cut = np.flatnonzero((key != key[-1]) | (part != part[-1]))
            cut = int(cut[-1]) + 1 if len(cut) else 0  # the last hash may go on
            if cut:
                yield from solve(t.slice(0, cut))
            held = t.slice(cut).to_batches()
            size = sum(b.column("data").nbytes + 32 * b.num_rows for b in held) if cut else 0
        if held:
            yield from solve(pa.Table.from_batches(held))

    dealt = pieces.repartition(buckets, "key", "part").sortWithinPartitions("key", "part", "id", "crc", "start")
    return dealt.mapInArrow(C.task("suffix_dedup", run), "id long, crc long, start int, end int")


def _with_spans(docs: DataFrame, length: int, gram: int, carry: list[str]) -> DataFrame:
    """(id, crc, text, row, starts, ends): every document with its strings to remove, or null."""
    C.python_tasks(docs.sparkSession)
    base = _base(docs, carry)
    size = C.plan_bytes(docs)
    buckets = int(max(8, 2 * size // BUCKET_BYTES))
    found = C.written(_found(base, buckets, length, gram, hot_keys(base, size, length, gram)), "suffix-found")
    more = _factors(_fetched(base, found, length), buckets, length)
    spans = found.where("not request").select("id", "crc", "start", "end").unionByName(more)
    of_doc = spans.groupBy("id", "crc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    return base.join(of_doc, ["id", "crc"], "left")


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows (doc_id, n_bytes, removed array<struct<start, end>>, kept binary), one per document."""
    schema = T.StructType.fromDDL("doc_id long, n_bytes long, removed array<struct<start:int,end:int>>, kept binary")
    pair = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches, most=SLICE):
            ids, n, removed, kept = [], [], [], []
            for id_, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "starts", "ends"))):
                data = text.encode()
                s, e = union_spans(np.array(starts or [], np.int64), np.array(ends or [], np.int64))
                ids.append(None if id_ == _NO_ID else id_), n.append(len(data))
                removed.append([{"start": a, "end": b} for a, b in zip(s.tolist(), e.tolist())])
                kept.append(b"".join([data[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(data)])]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pair), pa.array(kept, pa.binary())], names=schema.fieldNames())

    return _with_spans(docs, length, gram, []).mapInArrow(C.task("suffix_dedup", run), schema)


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents, all columns, with repeated strings cut out of their texts.

    A character of which only some bytes are left goes too; ``n_chars``, if there, is counted
    anew. A null text stays null, and a text that is repeated whole becomes empty.
    """
    carry = [c for c in docs.columns if c != "text"]
    schema = T.StructType([T.StructField("row", T.StructType([docs.schema[c] for c in carry])), T.StructField("null_text", T.BooleanType()), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches, most=SLICE):
            out = []
            for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "ends"))):
                if starts:
                    data = text.encode()
                    s, e = union_spans(np.array(starts, np.int64), np.array(ends, np.int64))
                    text = b"".join([data[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), len(data)])]).decode(errors="ignore")
                out.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("null_text"), pa.array(out, pa.string())], names=schema.fieldNames())

    # Whether the text is null travels with the carried columns.
    mark = C.free_name(docs, "null_text")
    marked = docs.withColumn(mark, F.col("text").isNull())
    rows = _with_spans(marked, length, gram, [*carry, mark]).select(F.struct(*[F.col("row")[c].alias(c) for c in carry]).alias("row"), F.col("row")[mark].alias("null_text"), "text", "starts", "ends")
    text = F.when(~F.col("null_text"), F.col("text"))
    columns = {c: F.col("row")[c] for c in carry} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.mapInArrow(C.task("suffix_dedup", run), schema).select(*[columns[c].alias(c) for c in docs.columns])
