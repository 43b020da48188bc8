"""Hard-negative mining by angular triangle filtering.

Vectors become whole numbers, ``floor(scale * x)``; the score of two vectors is their exact inner
product. For every anchor the best scoring other rows of its label are its positives, and for
every positive the best rows of other labels whose score lies in a window of percents of the
positive's score are its hard negatives.

1. *Angles.* Every vector stores its norm and its angles to a few reference directions (centres of
   a bounded sample; they change the work, never the result). For two vectors with angles s and t
   to a reference the triangle inequality of the sphere gives ``|s - t| <= angle <= s + t`` (and
   ``<= 2 pi - s - t``), so the cosine lies in an interval, and norms make it bounds of the score.
   The bounds are widened by the rounding errors of the angles (an arc cosine loses half of the
   digits), so a true score is never outside.
2. *Blocks.* Vectors are range-partitioned by label, nearest reference and angle, and packed into
   blocks of at most ``BLOCK_ROWS`` rows (a hot label or a vector with many copies is only more
   blocks). Anchors are packed the same way.
3. *Search.* Blocks are dealt into strips; every anchor block meets every strip once. In a task,
   a pair of blocks is cut to the rows whose angle to one reference can reach the scores still
   needed, then to those whose interval overlaps the needed window; only these are scored, in
   doubles that hold whole numbers exactly, or in Python integers beyond 2^52. The running best
   of an anchor raises the score that later blocks must reach.
4. *Merge.* The best few of each task per anchor (and positive) are merged by a ranked window.

The positives are searched among the blocks of the anchor's label, the negatives among the others.
Every row is compared with every anchor at most once, in blocks: the work is anchors times rows,
less what the angles exclude. Memory of a task: two blocks and the bests of a few anchor blocks.

Edge cases: rows with a null id, label, vector or component, or a component that is not finite
(also after scaling), take no part; nor do rows of norm 2^31.5 or more after scaling, whose scores
need not fit a long. Vectors of different length do not meet. Empty and zero vectors score 0. Rows
equal in id, label and vector count once; rows that share an id only are rows of their own, with
ties between them broken by a hash of label and vector. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlink.llm.common import python_tasks, written

#: Rows of a block, anchors of a block, and anchors that are scored together.
BLOCK_ROWS, BLOCK_ANCHORS, GROUP = 1024, 256, 64
#: Reference directions, and rows of the sample they are fitted on.
REFERENCES, SAMPLE = 8, 2048
#: Norm up to which all partial sums of a score are whole numbers below 2^52, exact in a double.
EXACT_NORM = 2.0**26
MOST_NORM = 2.0**31.5
#: Anchor blocks whose bests a task holds before it sends them on.
HELD = 32

_MEASURED = "vec_id long, tie long, label long, dim int, wide boolean, cell int, angle double, norm double, angles binary, q binary"
_BLOCK = "block long, label long, dim int, wide boolean, n int, ids binary, ties binary, norms binary, angles binary, q binary"


def usable(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, embedding and tie of the rows that take part."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * scale) < F.lit(float("inf")), F.lit(False)))
    rows = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.withColumn("tie", F.xxhash64("label", "embedding"))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(values.astype(np.float64) * scale)


def _vectors(column: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) per length of the vectors in a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    flat = whole(column.values.to_numpy(zero_copy_only=False), scale)
    lengths = np.diff(ends)
    for dim in np.unique(lengths):
        at = np.flatnonzero(lengths == dim)
        yield at, flat[ends[at][:, None] + np.arange(dim)] if dim else np.zeros((len(at), 0))


def fit_references(rows: DataFrame, scale: int, n: int = REFERENCES, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Reference directions per vector length: spherical k-means centres of a bounded sample."""
    table = rows.orderBy(F.xxhash64(F.lit(13), "vec_id")).limit(sample).select("embedding").toArrow()
    out = {}
    if table.num_rows:
        for _, m in _vectors(table.column("embedding"), scale):
            norm = np.linalg.norm(m, axis=1)
            m = m[norm > 0] / norm[norm > 0][:, None]
            if len(m):
                centre = m[:: max(1, len(m) // n)][:n]
                for _ in range(6):
                    near = np.argmax(m @ centre.T, axis=1)
                    centre = np.array([m[near == k].sum(0) if (near == k).any() else centre[k] for k in range(len(centre))])
                    length = np.linalg.norm(centre, axis=1)
                    centre = np.where(length[:, None] > 1e-9, centre / np.maximum(length, 1e-9)[:, None], m[: len(centre)])
                out[m.shape[1]] = centre
    return out


def references(fitted: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """Reference directions for a length; lengths that the sample lacks have fixed random ones."""
    if dim not in fitted:
        drawn = np.random.default_rng(dim).normal(size=(REFERENCES, max(dim, 1)))
        fitted[dim] = (drawn / np.linalg.norm(drawn, axis=1)[:, None])[:, :dim]
    return fitted[dim]


def angles(q: np.ndarray, norm: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angles of the rows to the references; a zero vector, whose scores are 0 anyway, has right angles."""
    cos = q @ refs.T / np.where(norm > 0, norm, 1.0)[:, None]
    return np.arccos(np.clip(np.where(norm[:, None] > 0, cos, 0.0), -1.0, 1.0))


def slack(dim: int) -> float:
    """Bound of an angle's rounding error: a cosine is off by dim + 4 roundings at most, its angle by the root of twice that."""
    return 2.0 * float(np.sqrt(2.0 * (dim + 8) * 2.3e-16)) + 1e-12


def _measure(fitted: dict[int, np.ndarray], scale: int):
    schema = pa.schema([("vec_id", pa.int64()), ("tie", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("wide", pa.bool_()),
                        ("cell", pa.int32()), ("angle", pa.float64()), ("norm", pa.float64()), ("angles", pa.binary()), ("q", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, ties, labels = (batch.column(c).to_numpy() for c in ("vec_id", "tie", "label"))
            for at, q in _vectors(batch.column("embedding"), scale):
                norm = np.sqrt((q * q).sum(1))
                keep = norm < MOST_NORM
                at, q, norm = at[keep], q[keep], norm[keep]
                if not len(at):
                    continue
                turn = angles(q, norm, references(fitted, q.shape[1]))
                cell, wide = np.argmin(turn, axis=1).astype(np.int32), norm >= EXACT_NORM
                data = [v.astype("<i8" if w else "<i4").tobytes() for v, w in zip(q, wide)]
                columns = [ids[at], ties[at], labels[at], np.full(len(at), q.shape[1], np.int32), wide, cell, turn[np.arange(len(at)), cell], norm,
                           [t.tobytes() for t in turn], data]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def measured(rows: DataFrame, fitted: dict[int, np.ndarray], scale: int) -> DataFrame:
    python_tasks(rows.sparkSession)
    return rows.select("vec_id", "tie", "label", "embedding").mapInArrow(_measure(fitted, scale), _MEASURED)


def _pack(most: int):
    schema = pa.schema([("block", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("wide", pa.bool_()), ("n", pa.int32()),
                        *[(c, pa.large_binary()) for c in ("ids", "ties", "norms", "angles", "q")]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        last = None

        def flush():
            nonlocal number
            dim, wide, label = held[0][0]
            ids, ties, norms = (np.array([r[k] for r in held], t).tobytes() for k, t in ((1, "<i8"), (2, "<i8"), (3, "<f8")))
            columns = [number, label, dim, wide, len(held), ids, ties, norms, b"".join(r[4] for r in held), b"".join(r[5] for r in held)]
            number += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, schema.types)], schema=schema)

        for batch in batches:
            names = ("dim", "wide", "label", "vec_id", "tie", "norm", "angles", "q")
            for dim, wide, label, vec_id, tie, norm, turn, q in zip(*[batch.column(c).to_pylist() for c in names]):
                group = (dim, wide, label)
                if (group, vec_id, tie, q) == last:
                    continue  # an equal row
                last = (group, vec_id, tie, q)
                if held and (held[0][0] != group or len(held) >= most):
                    yield flush()
                held.append((group, vec_id, tie, norm, turn, q))
        if held:
            yield flush()

    return run


def blocks(rows: DataFrame, most: int, partitions: int) -> DataFrame:
    """Measured rows packed into blocks of one label, length and number type, near directions together."""
    order = ["dim", "wide", "label", "cell", "angle", "vec_id", "tie"]
    return rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(_pack(most), _BLOCK)


class Block:
    """A packed block as matrices; ``order`` sorts its rows by the angle to its ``main`` reference."""

    def __init__(self, n: int, dim: int, wide: bool, ids, ties, norms, turn, q):
        self.n = n
        self.ids, self.ties, self.norms = (np.frombuffer(b, t) for b, t in ((ids, "<i8"), (ties, "<i8"), (norms, "<f8")))
        self.angles = np.frombuffer(turn, "<f8").reshape(n, -1)
        self.q = np.frombuffer(q, "<i8" if wide else "<i4").reshape(n, dim).astype(np.float64)
        self.exact = not wide
        self.slack = slack(dim)
        self.most = float(self.norms.max(initial=0.0))
        self.main = int(np.bincount(np.argmin(self.angles, axis=1)).argmax())

    def sort(self) -> None:
        order = np.argsort(self.angles[:, self.main], kind="stable")
        self.ids, self.ties, self.norms, self.angles, self.q = (a[order] for a in (self.ids, self.ties, self.norms, self.angles, self.q))


def reach(anchors: Block, group: slice, rows: Block, least: np.ndarray) -> slice:
    """Rows (sorted by their main angle) that can score ``least`` with some anchor of the group."""
    with np.errstate(divide="ignore", invalid="ignore"):
        need = least / (anchors.norms[group] * rows.most)
    # Without a positive score to reach, or beside a zero vector, every row counts.
    width = np.where(need > 0, np.arccos(np.clip(need - 1e-9, -1.0, 1.0)), np.pi) + 4 * rows.slack
    own, at = rows.angles[:, rows.main], anchors.angles[group, rows.main]
    return slice(int(np.searchsorted(own, (at - width).min(), "left")), int(np.searchsorted(own, (at + width).max(), "right")))


def overlap(anchors: Block, group: slice, rows: Block, part: slice, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """anchors x rows: whether the bounds of the score meet the window [least, most] of the anchor."""
    a, x = anchors.angles[group], rows.angles[part]
    low = np.zeros((len(a), len(x)))
    high = np.full((len(a), len(x)), np.pi)
    for r in range(a.shape[1]):
        s, t = a[:, r, None], x[None, :, r]
        np.maximum(low, np.abs(s - t), out=low)
        both = s + t
        np.minimum(high, np.minimum(both, 2 * np.pi - both), out=high)
    size = anchors.norms[group][:, None] * rows.norms[part][None, :]
    room = size * 1e-9 + 1e-3
    wide = 2 * rows.slack
    upper = size * np.cos(np.maximum(low - wide, 0.0)) + room
    lower = size * np.cos(np.minimum(high + wide, np.pi)) - room
    return (upper >= least[:, None]) & (lower <= most[:, None])


def score(anchors: Block, group: slice, rows: Block, at: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    a, x = anchors.q[group], rows.q[at]
    if (anchors.exact and rows.exact) or anchors.most * rows.most < EXACT_NORM**2:
        return a @ x.T
    whole_a, whole_x = ([[int(v) for v in row] for row in m] for m in (a, x))
    out = np.empty((len(a), len(x)), object)
    for i, u in enumerate(whole_a):
        out[i] = [sum(p * q for p, q in zip(u, w)) for w in whole_x]
    return out


def best(scores, ids, ties, most: int) -> list[tuple[int, int, int]]:
    """The first ``most`` of (score, id, tie): higher scores first, ties by smaller id."""
    if len(scores) > most:
        edge = np.partition(scores, len(scores) - most)[len(scores) - most]
        keep = np.flatnonzero(scores >= edge)
        scores, ids, ties = scores[keep], ids[keep], ties[keep]
    return sorted(((int(s), int(i), int(t)) for s, i, t in zip(scores, ids, ties)), key=lambda r: (-r[0], r[1], r[2]))[:most]


def _merge(old: list, new: list, most: int) -> list:
    return sorted(old + new, key=lambda r: (-r[0], r[1], r[2]))[:most] if new else old


def _pairs(batches: Iterable[pa.RecordBatch], extra: str | None = None):
    """(anchor block id, anchors, extra, rows) of every pair; equal neighbours are unpacked once."""
    columns = ("n", "dim", "wide", "ids", "ties", "norms", "angles", "q")
    last = [None, None, None, None]
    for batch in batches:
        for i in range(batch.num_rows):
            made = []
            for side, prefix in enumerate(("a_", "b_")):
                block = batch.column(f"{prefix}block")[i].as_py()
                if last[side] != block:
                    last[side + 2] = Block(*[v.as_buffer() if pa.types.is_large_binary(v.type) or pa.types.is_binary(v.type) else v.as_py()
                                             for v in (batch.column(prefix + c)[i] for c in columns)])
                    last[side] = block
                    if prefix == "b_":
                        last[side + 2].sort()
                made.append(last[side + 2])
            yield last[0], made[0], batch.column(extra)[i].as_py() if extra else None, made[1]


def _groups(n: int) -> Iterator[slice]:
    return (slice(i, min(i + GROUP, n)) for i in range(0, n, GROUP))


_POSITIVES = "block long, i int, anchor_id long, id long, tie long, score long"


def _search_positives(most: int):
    schema = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("anchor_id", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}

        def flush():
            rows = [(b, i, int(ids[i]), r[1], r[2], r[0]) for b, (ids, tops) in held.items() for i, top in enumerate(tops) for r in top]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(schema.types)], schema=schema)

        for block, anchors, _, rows in _pairs(batches):
            if block not in held and len(held) >= HELD:
                yield flush()
            tops = held.setdefault(block, (anchors.ids.copy(), [[] for _ in range(anchors.n)]))[1]
            for group in _groups(anchors.n):
                least = np.array([float(t[-1][0]) if len(t) >= most else -np.inf for t in tops[group]])
                part = reach(anchors, group, rows, least)
                meets = overlap(anchors, group, rows, part, least, np.full(len(least), np.inf))
                ids, ties = rows.ids[part], rows.ties[part]
                meets &= (ids[None, :] != anchors.ids[group][:, None]) | (ties[None, :] != anchors.ties[group][:, None])  # not itself
                some = np.flatnonzero(meets.any(axis=0))
                if not len(some):
                    continue
                s = score(anchors, group, rows, part.start + some)
                for i in np.flatnonzero(meets.any(axis=1)):
                    own = np.flatnonzero(meets[i, some])
                    at = group.start + i
                    tops[at] = _merge(tops[at], best(s[i, own], ids[some[own]], ties[some[own]], most), most)
        if held:
            yield flush()

    return run


_NEGATIVES = "block long, i int, number int, anchor_id long, positive_id long, positive_score long, id long, tie long, score long"


def _search_negatives(most: int, low: int, high: int):
    schema = pa.schema([("block", pa.int64()), ("i", pa.int32()), ("number", pa.int32()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()),
                        ("positive_score", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flush():
            rows = [(b, p["i"], p["number"], p["anchor_id"], p["id"], p["score"], r[1], r[2], r[0]) for b, found in held.items() for own in found for p, top in own for r in top]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(schema.types)], schema=schema)

        def window(p) -> tuple[int, int]:
            return -(-low * p["score"] // 100), high * p["score"] // 100

        for block, anchors, positives, rows in _pairs(batches, "a_positives"):
            if block not in held and len(held) >= HELD:
                yield flush()
            if block not in held:
                held[block] = [[] for _ in range(anchors.n)]
                for p in positives:
                    held[block][p["i"]].append((p, []))
            found = held[block]
            for group in _groups(anchors.n):
                # What some positive of the anchor still needs: its window, from its worst kept negative up.
                needs = [[(max(window(p)[0], top[-1][0]) if len(top) >= most else window(p)[0], window(p)[1]) for p, top in own] for own in found[group]]
                needs = [[(a, b) for a, b in own if a <= b] for own in needs]
                least = np.array([min((a for a, _ in own), default=np.inf) for own in needs], np.float64)
                limit = np.array([max((b for _, b in own), default=-np.inf) for own in needs], np.float64)
                if not np.isfinite(least).any():
                    continue
                part = reach(anchors, group, rows, np.where(np.isfinite(least), least, -np.inf))
                meets = overlap(anchors, group, rows, part, least, limit)
                some = np.flatnonzero(meets.any(axis=0))
                if not len(some):
                    continue
                ids, ties = rows.ids[part], rows.ties[part]
                s = score(anchors, group, rows, part.start + some)
                for i in np.flatnonzero(meets.any(axis=1)):
                    own = np.flatnonzero(meets[i, some])
                    scores, here = s[i, own], some[own]
                    for k, (p, top) in enumerate(found[group.start + i]):
                        a, b = window(p)
                        if len(top) >= most:
                            a = max(a, top[-1][0])
                        inside = np.flatnonzero((scores >= a) & (scores <= b))
                        if len(inside):
                            found[group.start + i][k] = (p, _merge(top, best(scores[inside], ids[here[inside]], ties[here[inside]], most), most))
        if held:
            yield flush()

    return run


def _named(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def mine(vectors: DataFrame, is_anchor: Column | str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
         block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for vec_id, label, embedding.

    ``is_anchor`` says which rows are anchors; a positive of score p has negatives of scores from
    ``low`` to ``high`` percent of p.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    rows = usable(vectors, scale)
    fitted = fit_references(rows, scale)
    n = rows.count()
    partitions = max(2 * spark.sparkContext.defaultParallelism, -(-n // (32 * block_rows)))
    packed = written(blocks(measured(rows, fitted, scale), block_rows, partitions), "mine-rows")
    anchors = written(blocks(measured(rows.where(is_anchor), fitted, scale), block_anchors, max(2, partitions // 16)), "mine-anchors")
    strips = max(1, min(2 * spark.sparkContext.defaultParallelism, packed.count()))
    dealt = _named(packed.withColumn("strip", F.pmod(F.xxhash64("block"), F.lit(strips))), "b_")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(strips - 1).cast("long")))
    alike = (F.col("a_dim") == F.col("b_dim")) & (F.col("a_strip") == F.col("b_strip"))

    own = _named(anchors.withColumn("strip", each), "a_")
    found = own.join(dealt, alike & (F.col("a_label") == F.col("b_label"))).mapInArrow(_search_positives(positives), _POSITIVES)
    first = Window.partitionBy("block", "i").orderBy(F.desc("score"), "id", "tie")
    found = found.withColumn("number", F.row_number().over(first)).where(F.col("number") <= positives)
    # At most ``positives`` times ``block_anchors`` of them in a block.
    listed = found.groupBy("block").agg(F.collect_list(F.struct("i", "number", "anchor_id", "id", "score")).alias("positives"))
    told = written(anchors.join(listed, "block"), "mine-positives")
    own = _named(told.withColumn("strip", each), "a_")
    got = own.join(dealt, alike & (F.col("a_label") != F.col("b_label"))).mapInArrow(_search_negatives(negatives, low, high), _NEGATIVES)
    first = Window.partitionBy("block", "i", "number").orderBy(F.desc("score"), "id", "tie")
    got = got.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    return got.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
