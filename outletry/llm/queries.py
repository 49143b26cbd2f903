"""Driver queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, mixing, packing, privacy, quality, shingles, token_files, toxicity, vectors, warc
from .common import documents


def op1_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = privacy.find(documents(spark, sf_dir))
    n = [privacy.count_of("base", r).alias(f"n_{k}") for r, k in enumerate(privacy.KINDS[:4])]
    return out.select("doc_id", *n, F.sha2(privacy.written(F.col("base")), 256).alias("base_sha256"), privacy.written(F.col("spans")).alias("spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.learn_and_score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "held_out", "score", "predicted")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_to_files(documents(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op5_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir))
    placed = mixing.place(mixed).groupBy("uid").agg(F.sum("size").alias("taken"))
    out = mixed.drop("taken").join(placed, "uid", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.bundle_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingles.join(documents(spark, sf_dir))


def base_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of operator 1: how many base spans of each kind a document has."""
    return op1_privacy(spark, sf_dir).select("doc_id", *[f"n_{k}" for k in privacy.KINDS[:4]])


def base_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of operator 6: the counts and the base rule."""
    return op6_quality(spark, sf_dir).drop("kept")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of operator 8: sizes and targets, and that no document is taken too often."""
    out = op8_mixing(spark, sf_dir)
    return out.select("doc_id", "size", "source_size", F.round("target", 3).alias("target"), (F.col("taken") <= 3 * F.col("size")).alias("within"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith(("op", "base_", "mix_")) and callable(f)}


_REACHED = """reach as (select id, id as other from nodes union select r.id, p.b from reach r join pairs p on p.a = r.other)"""

# All pairs by brute force; components by closure.
_OP5 = f"""with recursive v as (select vec_id, cast(embedding as double[]) as e from embeddings), nodes as (select vec_id as id from v),
 pairs as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.95), {_REACHED},
 c as (select id, min(other) as component_id from reach group by id), n as (select a as id, count(*) as n from pairs group by a)
 select c.id as vec_id, coalesce(n.n, 0) as n_links, component_id, c.id = component_id as kept from c left join n using (id)"""

# Base32 of the SHA-1: five hexadecimal digits are four characters.
_B32 = "array_to_string(list_transform(range(0, 32), lambda i: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((cast('0x' || substring(h, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as int), 1)), '')"
_OP9 = f"""select page_id, strlen(t) as payload_bytes, {_B32} as payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to
 from (select *, sha1(t) as h, min(page_id) over (partition by t) as first from (select page_id, coalesce(html, '') as t from pages))"""

_OP10 = f"""with recursive w as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') as w from documents),
 s as (select doc_id, list_distinct(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from w),
 u as (select doc_id, unnest(s) as g from s), k as (select a.doc_id as a, b.doc_id as b, count(*) as n from u a join u b on a.g = b.g and a.doc_id <> b.doc_id group by all),
 j as (select k.a, k.b, n / (len(x.s) + len(y.s) - n) as j from k join s x on x.doc_id = k.a join s y on y.doc_id = k.b), pairs as (select a, b, j from j where j >= 0.8), nodes as (select doc_id as id from s), {_REACHED},
 c as (select id, min(other) as class_id from reach group by id), n as (select a as id, count(*) as n, min(case when j = 1 then b end) as twin from pairs group by a)
 select c.id as doc_id, class_id, least(c.id, coalesce(twin, c.id)) as copy_of, coalesce(n.n, 0) as n_links from c left join n using (id)"""


_DIGITS = "regexp_replace({0}, '[^0-9]', '', 'g')"
# Luhn: from the last digit on, every second one doubled, nine off where that is over nine.
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS.format('x')}) + 1), lambda i: case when i % 2 = 1 then cast(substring(reverse({_DIGITS.format('x')}), i, 1) as int) else cast(substring(reverse({_DIGITS.format('x')}), i, 1) as int) * 2 - case when cast(substring(reverse({_DIGITS.format('x')}), i, 1) as int) > 4 then 9 else 0 end end)) % 10 = 0"
_BASE_PRIVACY = f"""select doc_id, len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+')) as n_email,
 len(list_filter(regexp_extract_all(t, '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+'), lambda x: len(list_filter(string_split(x, '.'), lambda p: length(ltrim(p, '0')) > 3 or cast('0' || right(p, 3) as int) > 255)) = 0)) as n_ip,
 len(list_filter(regexp_extract_all(t, '[0-9](?:[ -]?[0-9])+'), lambda x: length({_DIGITS.format('x')}) between 12 and 19 and {_LUHN})) as n_card,
 len(list_filter(regexp_extract_all(t, '\\+[0-9][ ().0-9-]+[0-9]'), lambda x: length({_DIGITS.format('x')}) between 9 and 15)) as n_phone from (select doc_id, coalesce(text, '') as t from documents)"""
_BASE_QUALITY = """with w as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
 g as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w)), n as (select doc_id, g from g group by all having count(*) > 1),
 r as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from g join n using (doc_id, g)) group by doc_id),
 l as (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from w)
 select l.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
 len(w) < 50 or 100 * coalesce(r.n, 0) > 50 * len(w) as base_failed from l left join r using (doc_id)"""
_MIX_TARGETS = """with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size from documents), s as (select source, sum(size) as n from d group by source),
 w as (select *, [5, 2, 1][1 + (row_number() over (order by source is null, source) - 1) % 3] as w, 3 * n as cap, sum(n) over () as total from s),
 o as (select *, (total - coalesce(sum(cap) over (order by cap / w, source rows between unbounded preceding and 1 preceding), 0)) / sum(w) over (order by cap / w, source rows between current row and unbounded following) as level from w),
 v as (select *, (select arg_min(level, cap / w) from o where cap / w >= level) as l from o)
 select doc_id, size, cast(n as bigint) as source_size, round(least(cap, l * w), 3) as target, true as within from d join v on d.source is not distinct from v.source"""


def oracle_sql() -> dict[str, str]:
    """SQL twins; the other operators fit models, draw at random, or need a tokenizer, and tests hold them against plain versions."""
    return {"base_privacy": _BASE_PRIVACY, "base_quality": _BASE_QUALITY, "mix_targets": _MIX_TARGETS, "op5_vectors": _OP5, "op9_warc": _OP9, "op10_shingle_join": _OP10}
