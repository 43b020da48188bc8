"""Registered queries of the corpus operators, one per operator, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from satlink.llm import byte_bpe, decontaminate, fingerprint, hard_negatives, jaccard_join, language, licenses, mixing, prefix_trie, sharding, suffix_dedup, toxicity, wavelet
from satlink.llm.common import table, work_dir


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op2_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = language.fit(docs, F.coalesce(~held_out, F.lit(False)))
    return language.predict(docs.select("doc_id", "text", held_out.alias("held_out")), network, keep=["doc_id", "held_out"])


def op3_kk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.coalesce(~held_out, F.lit(False)))
    return toxicity.score(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op5_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, x: acc + (x["end"] - x["start"]))
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_licence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    begin = F.transform("base", lambda h: h["start"].cast("long"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(begin).alias("first_word"), F.array_max(begin).alias("last_word"),
        licenses.labels(F.col("base")).alias("base_labels"), licenses.labels(F.concat("base", "found")).alias("labels"), "score",
    )


def op7_winnow_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


def op8_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op9_divideskip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similarity_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = work_dir(spark, "wavelet")
    wavelet.write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), 1, path)
    return wavelet.read_documents(spark, path)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


def op12_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding"
    )
    return hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_byte_cnn_language": op2_byte_cnn_language,
    "op3_kk_shards": op3_kk_shards,
    "op4_nnpu_toxicity": op4_nnpu_toxicity,
    "op5_lpf_dedup": op5_lpf_dedup,
    "op6_licence_index": op6_licence_index,
    "op7_winnow_leaks": op7_winnow_leaks,
    "op8_bottom_k_fingerprints": op8_bottom_k_fingerprints,
    "op9_divideskip_join": op9_divideskip_join,
    "op10_wavelet_shards": op10_wavelet_shards,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_source_schedule": op12_source_schedule,
    "op13_hard_negatives": op13_hard_negatives,
}

#: A-Z to a-z, and no other letter, in DuckDB.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op7_winnow_leaks": f"""
        with docs as (
            select row_number() over () as row_id, doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
        items as (
            select distinct coalesce(cast(item_id as varchar), '') as item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words
            from benchmark),
        sized as (select *, least(len(words), 10) as size from items where len(words) > 0),
        item_windows as (
            select distinct item_id, size, list_slice(words, i, i + size - 1) as w
            from (select *, unnest(range(1, len(words) - size + 2)) as i from sized)),
        doc_windows as (
            select row_id, size, i, list_slice(words, i, i + size - 1) as w
            from (select *, unnest(range(1, len(words) - size + 2)) as i from docs, (select distinct size from sized) where len(words) >= size)),
        hits as (select row_id, d.size, i, item_id from doc_windows d join item_windows t on d.size = t.size and d.w = t.w),
        places as (select row_id, count(distinct p) as n_hit from (select row_id, unnest(range(i, i + size)) as p from hits) group by row_id),
        found as (select row_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids from (select distinct row_id, item_id from hits) group by row_id)
        select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from docs left join places using (row_id) left join found using (row_id)""",
    "op9_divideskip_join": f"""
        with recursive docs as (
            select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as words from documents),
        shingles as (
            select distinct doc_id, array_to_string(list_slice(words, i, i + 3), ' ') as shingle
            from (select *, unnest(range(1, greatest(len(words) - 3, 1) + 1)) as i from docs where len(words) > 0)),
        sizes as (select doc_id, count(*) as n from shingles group by doc_id),
        shared as (
            select a.doc_id as x, b.doc_id as y, count(*) as n
            from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
        links as (
            select x, y from shared s join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * s.n >= 85 * (a.n + b.n - s.n)),
        reach as (
            select doc_id as x, doc_id as y from docs
            union
            select r.x, l.y from reach r join links l on l.x = r.y)
        select d.doc_id, coalesce(s.n, 0) as n_shingles, c.component_id
        from docs d left join sizes s on s.doc_id = d.doc_id
        join (select x, min(y) as component_id from reach group by x) c on c.x = d.doc_id""",
    # crc32 bit by bit, as SQL has none; prefixes as lists of (role, text).
    "op11_prefix_trie": """
        with own as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
            from conversations where conv_id is not null),
        convs as (
            select conv_id, conv_id - conv_id % 20 as base, count(*) as n,
                   (4294967295 - list_reduce(
                        list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
                        lambda crc, byte: list_reduce(
                            list_prepend(xor(crc, byte), list_transform(range(8), lambda i: cast(i as bigint))),
                            lambda a, i: case when a % 2 = 1 then xor(a // 2, cast(3988292384 as bigint)) else a // 2 end))) % 4 as h
            from own group by conv_id),
        rebuilt as (
            select c.conv_id, o.pos, o.role, o.text from convs c join own o on o.conv_id = c.base and o.pos <= c.h
            union all
            select c.conv_id, o.pos - c.h + least(c.h, coalesce(b.n, 0)), o.role, o.text
            from convs c join own o on o.conv_id = c.conv_id and o.pos > c.h left join convs b on b.conv_id = c.base),
        prefixes as (
            select conv_id, pos as depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words,
                   list({'role': role, 'text': text}) over (partition by conv_id order by pos rows unbounded preceding) as prefix
            from rebuilt),
        members as (
            select conv_id, depth, words, min(conv_id) over (partition by depth, prefix) as node from prefixes
            union all
            select conv_id, 0, 0, min(conv_id) over () from convs),
        lengths as (select conv_id, max(depth) as n from members group by conv_id),
        nodes as (
            select m.node, m.depth, count(*) as n_convs, max(m.words) as words,
                   sha256(coalesce(string_agg(case when l.n = m.depth then cast(m.conv_id as varchar) end, ',' order by m.conv_id), '')) as ends_sha256
            from members m join lengths l using (conv_id) group by m.node, m.depth),
        linked as (
            select n.*, p.node as parent from nodes n left join members p on p.conv_id = n.node and p.depth = n.depth - 1),
        children as (select parent as node, depth - 1 as depth, count(*) as n from linked where depth > 0 group by 1, 2),
        full_nodes as (
            select l.*, coalesce(c.n, 0) as n_children from linked l left join children c on c.node = l.node and c.depth = l.depth),
        below as (
            select m.node, m.depth, sum(case when f.n_children = 0 then 1 else 0 end) as n_leaves, sum((f.n_convs - 1) * f.words) as saved
            from full_nodes f join members m on m.conv_id = f.node and m.depth <= f.depth group by 1, 2)
        select f.node as conv_id, cast(f.depth as bigint) as depth, f.parent as parent_conv_id, f.n_convs, cast(f.n_children as bigint) as n_children,
               cast(b.n_leaves as bigint) as n_leaves, cast(b.saved as bigint) as saved_tokens, f.ends_sha256
        from full_nodes f join below b on b.node = f.node and b.depth = f.depth""",
    "op13_hard_negatives": """
        with rows_in as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        scores as (
            select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
                   cast(list_inner_product(a.q, b.q) as bigint) as score
            from rows_in a join rows_in b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
            where a.vec_id % 50 = 0),
        positives as (
            select * from scores where same
            qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
        select p.anchor_id, p.other_id as positive_id,
               cast(row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) as int) as rank,
               n.other_id as negative_id, p.score as positive_score, n.score as negative_score
        from positives p join scores n
          on n.anchor_id = p.anchor_id and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
        qualify row_number() over (partition by p.anchor_id, p.other_id order by n.score desc, n.other_id) <= 3""",
}
