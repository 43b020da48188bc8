"""Document fingerprints: bottom-k sketches of word-shingle hashes, in built-in expressions only.

A shingle is a word with up to four words before it (the first words have fewer, so a text
has as many shingles as words and short texts still compare). The sketch keeps the ``k`` least
distinct 64-bit hashes, in order. Sketches of parts merge into the sketch of the whole, and
estimate resemblance, containment and the number of distinct shingles.

``with_ends`` and ``with_next`` pair every document with the next one in descending doc_id
order: documents are dealt by ranges of doc_id (quantiles, at most ``RANGES``), the head of each
range is repeated as the end of the range before it, and a window per range looks one row ahead. So
each text is shuffled once and no task holds more than a range.

Edge cases: a null text counts as empty; without words the sketch is empty, two empty sketches
have resemblance 1, an empty and another 0; rows of equal doc_id are ordered by text; rows
without doc_id come last; a single document is its own next one; other columns are ignored
or, in ``with_sketch``, pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlink.llm import common as C

K = 64
SHINGLE = 5
#: Rows and bytes of input aimed at for a range of doc_ids; most ranges.
RANGE_ROWS, RANGE_BYTES, RANGES = 2000, 16 << 20, 16384


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """Add the sketch (array<long>) of the column ``text``."""
    words, hashes = f"__{name}_words", f"__{name}_hashes"
    # Each step is a column of its own: an expression inside a lambda would run for each element.
    df = df.withColumn(words, F.transform(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w)))
    shingle = F.transform(words, lambda w, i: F.xxhash64(*[F.get(F.col(words), i - j) for j in range(SHINGLE - 1, 0, -1)], w))
    df = df.withColumn(hashes, F.array_distinct(shingle))
    return df.withColumn(name, F.slice(F.sort_array(F.col(hashes)), 1, k)).drop(words, hashes)


def merge(sketches: Column, k: int = K) -> Column:
    """Aggregate: the sketch of the union of the parts whose sketches are given."""
    return F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_set(sketches)))), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, from the k least hashes of both."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    shared = F.size(F.array_intersect(F.array_intersect(least, a), b))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(shared / F.size(least))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from the k-th least hash."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has."""
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    union = F.when(F.size(least) < k, F.size(least).cast("double")).otherwise(F.lit(float(k - 1)) / ((F.element_at(least, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)))
    share = resemblance(a, b, k) * union / F.greatest(distinct_shingles(a, k), F.lit(1.0))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def as_text(sketch: Column) -> Column:
    """16 hexadecimal digits per hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are at most doc_id (-1 for null): found in two steps of about sqrt(n) comparisons."""
    if not bounds:
        return F.when(doc_id.isNull(), F.lit(-1)).otherwise(F.lit(0))
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    count = lambda array: F.size(F.filter(array, lambda b: b <= doc_id))
    above = count(F.lit([g[0] for g in groups]))
    inner = F.array(*[F.lit(g) for g in groups])
    return F.when(doc_id.isNull(), F.lit(-1)).when(above == 0, F.lit(0)).otherwise((above - 1) * step + count(F.get(inner, above - 1)))


def with_ends(docs: DataFrame) -> DataFrame:
    """Deal the documents (doc_id, text, ...) by ranges of doc_id, and repeat the head of each range.

    Adds ``__range`` and ``__end``: whether the row is the head of the next lower range, repeated.
    """
    n = docs.count()
    ranges = min(RANGES, max(1, -(-n // RANGE_ROWS), -(-C.plan_bytes(docs) // RANGE_BYTES)))
    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    ids = docs.select("doc_id")
    bounds = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges).alias("b")).first()["b"] or [])) if shares else []
    place = _range_of(F.col("doc_id"), bounds)
    heads = sorted(((r["range"], r["head"]) for r in ids.groupBy(place.alias("range")).agg(F.max("doc_id").alias("head")).collect()), reverse=True)
    # The head of each range ends the range before it, the first head the last range. One row per range is broadcast.
    ends = docs.sparkSession.createDataFrame([(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)], "__head long, __before int")
    rows = docs.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("__head")), "left")
    own = F.struct(place.alias("__range"), F.lit(False).alias("__end"))
    end = F.struct(F.col("__before").alias("__range"), F.lit(True).alias("__end"))
    dealt = F.when(F.col("__before").isNull(), F.array(own)).otherwise(F.array(own, end))
    return rows.select(*docs.columns, F.inline(dealt).alias("__range", "__end"))


def with_next(rows: DataFrame, carry: list[str]) -> DataFrame:
    """Add ``next_<c>`` for each column of ``carry``: its value in the next row, descending doc_id, then text.

    ``rows`` come from with_ends(), with columns added; the repeated heads leave again.
    """
    order = Window.partitionBy("__range").orderBy("__end", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    rows = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry])
    return rows.where(~F.col("__end")).drop("__range", "__end")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Rows (doc_id, n_chars, edited, sketch, edited_sketch, near_edited, near_next).

    ``edited``: the last third of the code points replaced by the first ones of the next document.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_ends(with_sketch(rows, "text", "sketch", k)), ["text", "sketch"])
    n = F.length("text")
    cut = F.floor(n / F.lit(3)).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    rows = with_sketch(rows.select("doc_id", "n_chars", "edited", "sketch", "next_sketch"), "edited", "edited_sketch", k)
    near = resemblance(F.col("sketch"), F.col("edited_sketch"), k), resemblance(F.col("sketch"), F.col("next_sketch"), k)
    return rows.select("doc_id", "n_chars", "edited", "sketch", "edited_sketch", near[0].alias("near_edited"), near[1].alias("near_next"))
