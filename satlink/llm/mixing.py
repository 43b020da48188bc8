"""Mixing sources to target weights by a low-discrepancy schedule.

1. *Targets.* The sources share ``share`` times all words by weight; a source's target stops at
   ``most`` times its own words and the excess goes to the others by weight. That is the water
   level ``min(most * size, weight * level)``: with sources sorted by ``most * size / weight``
   the capped ones are a prefix, found by running sums.
2. *Schedule.* The mix is a row of slots of about ``block_words`` words. Slot ``i`` has the point
   ``i * golden ratio`` modulo 1, in 32-bit whole numbers; the cumulative targets cut [0, 1) into
   one interval a source, and the point's interval names the slot's source. So any stretch of the
   mix holds each source in nearly its share. A source whose interval is too narrow to hold a
   point gets one slot, where its interval lies.
3. *Ranks.* Slots are ranked per source: chunks of 65,536 slots are counted, the counts summed
   along, and slots numbered inside their chunk, so no task holds all slots of a source.
4. *Blocks.* A source's documents, in the order of a hash (the shuffle), form a stream of words,
   repeated up to ``most`` times; its target is cut into as many equal blocks as it has slots
   (lengths differ by a word at most). Block ``r`` goes into the slot of rank ``r``: an equi-join.

Only DataFrame functions are used. Work and shuffles are in proportion to documents plus slots;
rows that go through one task are one per source (running sums of the targets).

Edge cases: a null source is a source (the last one); null and empty texts have no words, belong
to no block, and get ``taken`` 0; rows equal in doc_id, source and size follow each other in the
stream, whatever their number (they are counted before the shuffle, and equal rows can change
places without changing the result); rows without doc_id are ordered by size; an empty table
gives an empty mix; columns other than doc_id, source and text play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlink.llm.common import written

#: A word, as the sizes count it.
WORD = r"[^\x20\x09-\x0D]+"
_SPACE = " \t\n\x0b\x0c\r"
#: Words of a block, about.
BLOCK_WORDS = 256
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SEED = 12

#: Golden ratio times 2^32 (odd, so that 2^32 slots meet every point once).
GOLDEN = 2654435769
POINTS = 1 << 32
_CHUNK_BITS = 16
#: Documents that a hash bucket of a source's stream holds, about.
_BUCKET_DOCS = 4096
#: Sources up to which the tables of sources and cells (17 rows of 48 bytes a source) are broadcast; beyond, joins shuffle.
BROADCAST_SOURCES = 10_000


def words(text: Column) -> Column:
    """Number of words: each becomes one letter, the spaces go, the letters are counted."""
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, WORD, "w"), _SPACE, "")), F.lit(0)).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size of every document: the only pass over the texts."""
    return docs.select("doc_id", "source", words(F.col("text")).alias("size"))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: sid (its place by code point, null last), source, source_size, weight, target, words, lo, hi.

    ``words`` is the target as a whole number, [lo, hi) the source's interval of the 2^32 points.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = per.withColumn("sid", F.row_number().over(by_name) - 1).withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("sid") % len(weights) + 1))
    s = s.withColumn("cap", F.lit(float(most)) * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    s = s.withColumn("level", left_words / left_weight)
    # Past the first source that is not capped the levels only fall: the largest is the level.
    open_level = F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(everything)
    s = s.withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("weight") * open_level, F.col("cap"))))
    up_to = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumn("reach", F.sum("target").over(up_to)).withColumn("all", F.max("reach").over(everything))
    s = s.withColumn("hi", F.when(F.col("reach") >= F.col("all"), F.lit(POINTS)).otherwise(F.floor(F.col("reach") / F.col("all") * POINTS)).cast("long"))
    s = s.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("sid")), F.lit(0).cast("long")))
    whole = F.least(F.round("target").cast("long"), F.col("source_size") * most).alias("words")
    return s.select("sid", "source", "source_size", "weight", "target", whole, "lo", "hi")


def _few(df: DataFrame, n_sources: int) -> DataFrame:
    return F.broadcast(df) if n_sources <= BROADCAST_SOURCES else df


def point(slot: Column) -> Column:
    """``slot * GOLDEN`` modulo 2^32 in two halves, so that no product passes 2^63."""
    high = F.pmod(F.shiftright(slot, 16) % 65536 * GOLDEN, F.lit(POINTS)) * 65536
    return F.pmod(high + slot % 65536 * GOLDEN, F.lit(POINTS))


def schedule(sources: DataFrame, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """(slots, counts): slot, sid, rank of every slot; sid, n_slots of every source with a target.

    ``sources`` as from ``targets``, written: it is read several times.
    """
    spark = sources.sparkSession
    total, n_sources = sources.agg(F.sum("words"), F.count("*")).first()
    n = -(-int(total or 0) // block_words)
    bits = min(32, max(1, n_sources).bit_length() + 4)
    width = 32 - bits
    wide = sources.where("hi > lo")
    cells = wide.select("sid", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", width), F.shiftright(F.col("hi") - 1, width))).alias("cell"))
    points = spark.range(n).select(F.col("id").alias("slot"), point(F.col("id")).alias("u")).withColumn("cell", F.shiftright("u", width))
    met = points.join(_few(cells, n_sources), "cell").where("lo <= u and u < hi").select("slot", "sid", F.shiftright("slot", _CHUNK_BITS).alias("chunk"))
    chunks = met.groupBy("sid", "chunk").agg(F.count("*").alias("here"))
    along = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("before", F.coalesce(F.sum("here").over(along), F.lit(0)))
    counts = written(chunks, "mix-chunks")
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = met.withColumn("inside", F.row_number().over(inside) - 1).join(counts, ["sid", "chunk"])
    ranked = ranked.select("slot", "sid", (F.col("before") + F.col("inside")).alias("rank"))
    per = counts.groupBy("sid").agg(F.sum("here").alias("n_slots"))
    missed = sources.where("words > 0").join(per, "sid", "left_anti")
    own = missed.select(F.floor(F.col("lo") / POINTS * n).cast("long").alias("slot"), "sid", F.lit(0).cast("long").alias("rank"))
    return ranked.unionByName(own), per.unionByName(missed.select("sid", F.lit(1).cast("long").alias("n_slots")))


def stream(sized: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """Documents with their place in their source's shuffled stream.

    Columns doc_id, size, copy (0.. among equal rows), sid, source_size, target, words, n_slots, at.
    ``sources`` has n_slots.
    """
    n_docs, n_sources = sized.count(), sources.count()
    bits = max(1, -(-n_docs // _BUCKET_DOCS).bit_length())
    grouped = sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n"))
    keys = _few(sources.select(F.col("source").alias("named"), "sid"), n_sources)
    placed = grouped.join(keys, F.col("source").eqNullSafe(F.col("named"))).drop("source", "named")
    placed = placed.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    run = F.col("size") * F.col("n")
    buckets = placed.groupBy("sid", "bucket").agg(F.sum(run).alias("here"))
    along = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("here").over(along), F.lit(0))).drop("here")
    buckets = buckets.join(_few(sources.drop("source", "lo", "hi", "weight"), n_sources), "sid")
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum(run).over(inside), F.lit(0))).join(buckets, ["sid", "bucket"])
    # Equal rows one by one again, in two steps so that no array is longer than a few thousand for a billion copies.
    step = 1 << 15
    placed = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / step))))
    placed = placed.withColumn("copy", F.explode(F.sequence(F.col("part") * step, F.least(F.col("n"), (F.col("part") + 1) * step) - 1)))
    at = F.col("before") + F.col("inside") + F.col("copy") * F.col("size")
    return placed.select("doc_id", "size", "copy", "sid", "source_size", "target", "words", "n_slots", at.alias("at"))


def _start(block: Column) -> Column:
    """First word of a block of a source: its target cut into n_slots equal parts."""
    return F.when(block >= F.col("n_slots"), F.col("words")).otherwise(F.floor(block * (F.col("words") / F.col("n_slots"))))


def pieces(placed: DataFrame, most: int = MOST) -> DataFrame:
    """The parts of every document that fall into blocks of its source: block, pass, first_word, n_words are added."""
    begin = F.col("at") + F.col("pass") * F.col("source_size")
    parts = placed.where("size > 0").withColumn("pass", F.explode(F.array(*[F.lit(i).cast("long") for i in range(most)])))
    parts = parts.withColumn("begin", begin).withColumn("end", F.least(begin + F.col("size"), F.col("words"))).where("begin < end")
    each = F.col("words") / F.col("n_slots")
    # One block more on both sides, as divisions round; parts without words go.
    low = F.greatest(F.lit(0).cast("long"), F.floor(F.col("begin") / each) - 1)
    high = F.least(F.col("n_slots") - 1, F.floor((F.col("end") - 1) / each) + 1)
    parts = parts.withColumn("block", F.explode(F.sequence(low, high)))
    first = F.greatest(F.col("begin"), _start(F.col("block")))
    last = F.least(F.col("end"), _start(F.col("block") + 1))
    return parts.withColumn("n_words", last - first).withColumn("first_word", first - F.col("begin")).where("n_words > 0").drop("begin", "end")


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST, block_words: int = BLOCK_WORDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(mix, placed): the mix as rows of slot, doc_id, first_word, n_words, ..., and all documents in their streams."""
    sized = written(sizes(docs), "mix-sizes")
    sources = written(targets(sized, weights, share, most), "mix-sources")
    slots, counts = schedule(sources, block_words)
    placed = stream(sized, sources.join(counts, "sid", "left"), seed)
    mix = pieces(placed, most).join(slots.withColumnRenamed("rank", "block"), ["sid", "block"])
    return mix, placed


def taken(docs: DataFrame, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document: the words that the mix takes of it, repeats counted."""
    mix, placed = mixed(docs, **how)
    whole = ["doc_id", "size", "source_size", "target"]
    # A document with words is known by its place in the stream; those past the target or without words take no part.
    some = mix.groupBy("sid", "at", *whole).agg(F.sum("n_words").alias("taken"))
    none = placed.where("size = 0 or at >= words").select(*whole, F.lit(0).cast("long").alias("taken"))
    return some.select(*whole, "taken").unionByName(none)
