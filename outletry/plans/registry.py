"""The queries of this library over the test tables and, where SQL can say the same, their SQL.

The tables hold no branch lists, so names, headers and addresses are made from keys by
expressions that Spark and the oracle read alike; operators get fitting vocabularies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outletry.functions import phrases
from outletry.functions import predicates as P
from outletry.functions import similarity as S
from outletry.functions import text as T
from outletry.functions import url as U
from outletry.functions import vocab as V
from outletry.operators import chain, extract, registry, resolve, store
from outletry.sources import dom, fetch, tables

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable]:
    from outletry.plans import made  # noqa: F401  registers its queries

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _q(pattern: str) -> str:
    """A pattern as a SQL literal."""
    return "'" + pattern.replace("'", "''") + "'"


NAME = """case c_custkey % 14 when 0 then 'Motijheel   Branch' when 1 then 'GULSHAN Sub-Branch ' || c_custkey when 2 then 'ATM Booth ' || (c_custkey % 7)
 when 3 then 'Ranu Plaza Holding No.' || c_custkey when 4 then 'AB Bank opened its branch' when 5 then 'Branch Name' when 6 then 'Eid Offers ' || c_mktsegment when 7 then '12/34'
 when 8 then 'Uposhakha ' || c_nationkey when 9 then 'Mirpur ' || (c_custkey % 20) || ' Branch' when 10 then 'Zigatola Branch, Dhaka' when 11 then c_name || ' Ltd (CB) Bank'
 when 12 then 'শাখা ঢাকা ' || c_nationkey else '' end"""
ADDRESS = """case c_custkey % 6 when 0 then 'District' when 1 then c_custkey || ' Dilkusha C/A, Dhaka' when 2 then '12, Lake Road, Block ' || (c_custkey % 9) when 3 then c_mktsegment
 when 4 then 'Address: Level 4, Green Tower, Phone: 02-9551234' else '' end"""


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").selectExpr("c_custkey as id", f"{NAME} as name", f"{ADDRESS} as address", "c_nationkey as nation")


_NAMES = f"(select c_custkey as id, {NAME} as name, {ADDRESS} as address, c_nationkey as nation from customer)"


@query("select doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) as clean from documents")
def q_clean_ws(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(T.clean_ws(F.col("text"))).alias("clean"))


@query(f"select id, case when s = '' then 'bank' else s end as slug from (select id, left(trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_'), 80) as s from {_NAMES})")
def q_slugify(spark, sf_dir):
    return _names(spark, sf_dir).select("id", T.slugify(F.col("name")).alias("slug"))


@query(f"""select id, array_to_string(list_filter(string_split(trim(regexp_replace(lower(regexp_replace(name, '\\([^)]*\\)', ' ', 'g')), '[^a-z0-9ঀ-৿]+', ' ', 'g')), ' '), lambda w: w not in ({', '.join(map(_q, V.STOP_WORDS))})), ' ') as norm_key,
 regexp_replace(lower(name), '[^a-z0-9]', '', 'g') as squashed,
 trim(regexp_replace(regexp_replace(regexp_replace(lower(name), '(^|[^a-z0-9_])(sub[\\s-]*branch(es)?|branch(es)?|up[oa]sh[aeo]kha|plc|ltd|limited)($|[^a-z0-9_])', '\\1 \\5', 'g'), 'উপ\\s*শাখা|শাখা', ' ', 'g'), '[^a-z0-9ঀ-৿]+', ' ', 'g')) as branch_key from {_NAMES}""")
def q_keys(spark, sf_dir):
    n = F.col("name")
    return _names(spark, sf_dir).select("id", T.norm_key(n).alias("norm_key"), T.squash(n).alias("squashed"), T.branch_key(n).alias("branch_key"))


@query("""select page_id, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') as domain,
 case when p = '' then '' else h || p end as scope, b || case when contains(b, '?') then '&page=' else '?page=' end || (page_id % 5) as paged, ends_with(lower(regexp_replace(url, '[?#].*$', '')), '.pdf') as pdf
 from (select *, rtrim(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') as p, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) as h, regexp_replace(url, '#.*$', '') as b from pages)""")
def q_urls(spark, sf_dir):
    u = F.col("url")
    return _t(spark, sf_dir, "pages").select("page_id", U.domain_of(u).alias("domain"), U.scope_of(u).alias("scope"), U.page_number(u, F.col("page_id") % 5).alias("paged"), U.is_pdf(u).alias("pdf"))


_HREF = '<a href="([^"]*)"[^>]*>([^<]*)</a>'
_LINKS = f"""(select page_id, url, hrefs[i] as href, anchors[i] as anchor, i - 1 as ord, case when starts_with(hrefs[i], '/') then regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || hrefs[i] else hrefs[i] end as link
 from (select *, regexp_extract_all(html, '{_HREF}', 1) as hrefs, regexp_extract_all(html, '{_HREF}', 2) as anchors from pages), lateral (select unnest(range(1, len(hrefs) + 1)) as i))"""


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _t(spark, sf_dir, "pages").select("page_id", "url", *[F.regexp_extract_all("html", F.lit(_HREF), i).alias(c) for i, c in ((1, "hrefs"), (2, "anchors"))])
    p = p.select("page_id", "url", F.posexplode(F.arrays_zip("hrefs", "anchors")).alias("ord", "l"))
    return p.select("page_id", "url", "ord", F.col("l.hrefs").alias("href"), F.col("l.anchors").alias("anchor"), U.root_relative(F.col("l.hrefs"), F.col("url")).alias("link"))


@query(f"select page_id, ord, link, regexp_replace(lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') as domain from {_LINKS}")
def q_links(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", "ord", "link", U.domain_of(F.col("link")).alias("domain"))


# Weights for the invented words of the test pages.
WEIGHTS = [("the", "the", 2.5), ("tion", "tion", 1.8), ("re", "re", 1.6), ("and", "and", -2.5), ("on", "on", 1.0)]
_U, _NEVER = "lower(link)", _q(rf"\.({V.any_of(V.MEDIA_EXTENSIONS)})($|\?)")
_SCORE = f"""case when regexp_matches({_U}, {_NEVER}) or (regexp_matches({_U}, {_q(V.any_of(V.OTHER_PAGES + V.NEWS_EVENTS))}) and not regexp_matches({_U}, 'branch|শাখা|uposhakha')) then -1.0 else
 ({' + '.join(f"case when contains({_U}, '{w}') then {x} when contains(lower(anchor), '{w}') then {x} * 0.8 else 0.0 end" for w, _, x in WEIGHTS)} - case when regexp_matches({_U}, {_q(V.any_of(V.NEWS_EVENTS + V.NEWS_MORE))}) then 1.5 else 0.0 end)
 * case when length(regexp_extract(rtrim({_U}, '/'), '[^/]*$')) > 40 then 0.2 else 1.0 end end"""


@query(f"""select page_id, link, round(score, 6) as score, rank from (select *, row_number() over (partition by page_id order by score desc, ord, link) as rank from
 (select page_id, link, max(score) as score, min(ord) as ord from (select page_id, ord, link, round(cast({_SCORE} as double), 6) as score from {_LINKS}) group by page_id, link)
 where score >= 1.2) where rank <= 25""")
def q_link_score_topk(spark, sf_dir):
    l = _links(spark, sf_dir)
    s = l.select("page_id", F.col("link").alias("url"), F.lit(False).alias("is_pdf"), U.score_page(F.col("link"), F.col("anchor"), WEIGHTS).alias("score"), "ord")
    return fetch.top_pages(s, "page_id").select("page_id", F.col("url").alias("link"), F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(r"""select doc_id, array_to_string(list_distinct_ordered, '; ') as phones from (select doc_id, list_filter(found, lambda x, i: list_position(found, x) = i) as list_distinct_ordered from
 (select doc_id, list_transform(regexp_extract_all(text, '(?:^|[^0-9])(\+1(?:[\s().-]{0,2}[0-9]){10})(?:$|[^0-9])', 1), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))) as found from documents)) where len(list_distinct_ordered) > 0""")
def q_phones(spark, sf_dir):
    phones = T.find_phones(F.col("text"), r"\+1", (10, 10), 2)
    return _t(spark, sf_dir, "documents").select("doc_id", T.joined_phones(phones, 100_000).alias("phones")).where("phones <> ''")


_FLAGS = {
    "sub": (P.is_sub, f"regexp_matches(n, {_q(V.SUB)})"), "branch": (P.is_branch, f"regexp_matches(n, {_q(V.BRANCH)})"), "premises": (P.is_premises, f"regexp_matches(n, {_q(V.PREMISES)})"),
    "latin": (P.is_latin, "regexp_matches(n, '[a-z]') or not regexp_matches(n, '[ঀ-৿]')"), "booth": (P.is_booth, f"regexp_matches(n, {_q(V.bounded(V.BOOTHS))}) or contains(n, 'adjacent to branch') or contains(n, 'adjacent to the branch')"),
    "promo": (P.is_promo, f"regexp_matches(n, {_q(phrases.worded(V.PROMOS))})"), "feed": (P.is_non_branch_feed, f"regexp_matches(n, {_q(V.bounded(V.NON_BRANCH_FEEDS))})"),
    "coords": (P.is_coordinates, "regexp_matches(name, '^[0-9.,\\s-]+$')"),
}


@query(f"select id, {', '.join(f'({e}) as {k}' for k, (_, e) in _FLAGS.items())} from (select *, lower(name) as n from {_NAMES})")
def q_name_flags(spark, sf_dir):
    return _names(spark, sf_dir).select("id", *[f(F.col("name")).alias(k) for k, (f, _) in _FLAGS.items()])


@query(f"""select id, case when regexp_matches(t, {_q(V.SUB)}) then true when regexp_matches(t, '(^|[^a-z0-9_])branch($|[^a-z0-9_])') then false else id % 2 = 0 end as is_sub
 from (select id, lower(case when id % 3 = 0 then 'Branch' else '' end || ' ' || name) as t from {_NAMES})""")
def q_classify_sub(spark, sf_dir):
    kind = F.when(F.col("id") % 3 == 0, "Branch").otherwise("")
    return _names(spark, sf_dir).select("id", T.classify_sub(F.col("name"), kind, F.col("id") % 2 == 0).alias("is_sub"))


@query(f"select id, {' + '.join(f'cast(contains(lower(address), {_q(w)}) as int)' for w in V.ADDRESS_WORDS)} as hits, regexp_matches(lower(address), {_q(V.whole(V.GENERIC_ADDRESSES))}) as generic from {_NAMES}")
def q_address_words(spark, sf_dir):
    return _names(spark, sf_dir).select("id", T.keyword_hits(F.col("address")).alias("hits"), P.is_generic_address(F.col("address")).alias("generic"))


_SEEN = "length(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')))"


@query(f"""select page_id, n as visible, case when page_id % 9 = 0 then 'http_503' when kind = 'json' and regexp_matches(html, '^\\s*[\\[{{]') then 'local_json' when kind <> 'json' and not blocked and (n >= 500 or scripts <= 3) then 'local_html' else 'render' end as decision
 from (select page_id, html, {_SEEN} as n, case when page_id % 11 = 0 then 'json' else 'html' end as kind, len(string_split(lower(html), '<script')) - 1 as scripts,
 regexp_matches(lower(left(html, 5000)), {_q(V.any_of(V.BLOCK_PHRASES))}) or ({_SEEN} < 800 and regexp_matches(lower(left(html, 5000)), {_q(V.any_of(V.CHALLENGES))})) as blocked from pages)""")
def q_fetch_decision(spark, sf_dir):
    n = fetch.visible_length(F.col("html"))
    status = F.when(F.col("page_id") % 9 == 0, 503).otherwise(200)
    kind = F.when(F.col("page_id") % 11 == 0, "application/json").otherwise("text/html")
    return _t(spark, sf_dir, "pages").select("page_id", n.alias("visible"), fetch.fetch_decision(status, kind, F.col("html"), n).alias("decision"))


@query("select o_orderkey, case when s = 200 then 'use' when s = 429 then 'wait' when s in (402, 403) then 'disable' when s >= 500 then 'retry_once' else 'give_up' end as class from (select o_orderkey, [200, 429, 402, 403, 500, 404, 503][1 + o_orderkey % 7] as s from orders)")
def q_retry_class(spark, sf_dir):
    s = F.get(F.array(*[F.lit(x) for x in (200, 429, 402, 403, 500, 404, 503)]), (F.col("o_orderkey") % 7).cast("int"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", fetch.retry_class(s).alias("class"))


HEADER = "case (l_linenumber + l_orderkey) % 7 when 0 then 'Branch Name' when 1 then 'Address' when 2 then 'Phone No' when 3 then 'Routing Number' when 4 then 'Outlet' when 5 then 'Branch Code' else 'Type of branch' end"


@query(f"""select l_orderkey, coalesce(min(case when k = 'strong' then c end), min(case when k is null and regexp_matches(regexp_replace(h, '{extract.NO_NAME}', '', 'g'), '{extract.WEAK_NAME}') then c end)) as name,
 count(case when k = 'address' then 1 end) as addresses, min(case when k = 'phone' then c end) as phone, min(case when k = 'type' then c end) as type, min(case when k = 'routing' then c end) as routing
 from (select *, {'case ' + ' '.join(f"when regexp_matches(h, {_q(p)}) then '{k}'" for k, p in extract.COLUMNS.items()) + ' end'} as k from (select l_orderkey, l_linenumber as c, lower({HEADER}) as h from lineitem)) group by l_orderkey having (name is not null) and (addresses > 0 or phone is not null)""")
def q_map_columns(spark, sf_dir):
    h = _t(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber as col", f"{HEADER} as text")
    return extract.column_map(h, ["l_orderkey"]).select("l_orderkey", "name", F.size("address").cast("long").alias("addresses"), "phone", "type", "routing")


_TURNS = "(select conv_id, turn % 10 as priority, case when role = 'system' then '' else text end as name from conversations)"


@query(f"""with r as {_TURNS}, n as (select conv_id, priority, count(case when trim(name) <> '' then 1 end) as named from r group by all),
 w as (select conv_id, min(case when priority < 7 and named >= 1 and priority > 0 then priority end) as winner, min(case when priority >= 7 then priority end) as spare from (select conv_id, priority, case when priority = 0 then 0 else named end as named from n) group by conv_id)
 select r.conv_id, r.priority, count(*) as n from r join w using (conv_id) where case when winner is not null then priority <= winner else priority < 7 or priority = spare end group by all""")
def q_chain_winner(spark, sf_dir):
    r = _t(spark, sf_dir, "conversations").selectExpr("conv_id", "turn % 10 as priority", "case when role = 'system' or turn % 10 = 0 then '' else text end as name")
    return chain.select_extractors(r, "conv_id", 1).groupBy("conv_id", "priority").agg(F.count("*").alias("n"))


@query("""with f as (select conv_id, role, min(turn) as turn from conversations group by all), s as (select c.conv_id, min(c.turn) as stop from (select distinct conv_id, turn from conversations) c left join (select distinct conv_id, turn from f) g using (conv_id, turn) where g.conv_id is null group by 1)
 select c.conv_id, c.turn, c.role from conversations c left join s using (conv_id) where stop is null or turn < stop""")
def q_pagination_stop(spark, sf_dir):
    return chain.pages_until_stop(_t(spark, sf_dir, "conversations"), "conv_id", "turn", ["role"]).select("conv_id", "turn", "role")


@query("select event_type, string_agg(distinct m, '+' order by m) as method from (select event_type, 'm' || (user_id % 4) as m from events) group by 1")
def q_methods(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("extractor", F.concat(F.lit("m"), (F.col("user_id") % 4).cast("string")))
    return chain.methods(e, "event_type")


@query("select user_id, event_type, count(*) as n from events group by all")
def q_method_counts(spark, sf_dir):
    return chain.method_counts(_t(spark, sf_dir, "events"), "user_id", "event_type")


_MORE = "case when c_custkey % 2 = 0 then '' else 'u' || c_custkey end as url, case when c_custkey % 5 < 3 then '' else 'p' || c_custkey end as phone"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").selectExpr("cast(c_nationkey % 4 as string) as bank", "c_custkey as ord", f"{NAME} as name", f"{ADDRESS} as address", *_MORE.split(", "), "cast(null as string) as routing", "c_custkey % 2 = 0 as is_sub")


_RECORDS = f"(select cast(c_nationkey % 4 as varchar) as bank, c_custkey as ord, {NAME} as name, {ADDRESS} as address, {_MORE} from customer)"


@query(f"""select bank, min(ord) as ord, arg_min(name, ord) as name, arg_min(address, case when address <> '' then ord end) as address, arg_min(url, case when url <> '' then ord end) as url, arg_min(phone, case when phone <> '' then ord end) as phone
 from (select *, regexp_replace(lower(name), '[^a-z0-9ঀ-৿]', '', 'g') || '|' || left(regexp_replace(lower(address), '[^a-z0-9ঀ-৿]', '', 'g'), 40) as k from {_RECORDS}) where k <> '|' group by bank, k""")
def q_exact_duplicates(spark, sf_dir):
    return resolve.exact_duplicates(_records(spark, sf_dir)).select("bank", "ord", "name", "address", "url", "phone")


@query(f"select nation, count(*) as n from (select *, count(case when l then 1 end) over (partition by nation) as latin from (select *, regexp_matches(lower(name), '[a-z]') or not regexp_matches(name, '[ঀ-৿]') as l from {_NAMES})) where latin < 10 or l group by nation")
def q_drop_translations(spark, sf_dir):
    return resolve.drop_translations(_names(spark, sf_dir).withColumn("bank", F.col("nation"))).groupBy("nation").agg(F.count("*").alias("n"))


@query()
def q_same_name(spark, sf_dir):
    return resolve.same_name(_records(spark, sf_dir)).groupBy("bank").agg(F.count("*").alias("n"), F.sum("ord").alias("ords"))


@query()
def q_near_names(spark, sf_dir):
    r = _names(spark, sf_dir).selectExpr("cast(nation as string) as bank", "id as ord", "name", "address", "'' as url", "'' as phone", "cast(null as string) as routing", "false as is_sub")
    return resolve.resolve(r).groupBy("bank").agg(F.count("*").alias("n"))


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = _t(spark, sf_dir, "part").select("p_name").distinct()
    l, r = (p.select(F.col("p_name").alias(c), F.left("p_name", F.lit(1)).alias("block")) for c in "ab")
    return l, r


_PAIRS = "(select l.p_name as a, r.p_name as b from (select distinct p_name from part) l join (select distinct p_name from part) r on left(l.p_name, 1) = left(r.p_name, 1) and l.p_name < r.p_name)"
_EDIT = "case when abs(length(a) - length(b)) > 6 then 0.0 else 1 - levenshtein(a, b) / greatest(length(a), length(b), 1) end"


@query(f"select a, b, round(r, 9) as ratio from (select a, b, {_EDIT} as r from {_PAIRS}) where r >= 0.3")
def q_edit_pairs(spark, sf_dir):
    l, r = _parts(spark, sf_dir)
    d = l.join(r, "block").where("a < b").withColumn("ratio", F.round(S.edit_ratio(F.col("a"), F.col("b")), 9))
    return d.where("ratio >= 0.3").select("a", "b", "ratio")


_SQ = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
_TRI = "case when length({0}) < 3 then [{0}] else list_distinct(list_transform(range(1, length({0}) - 1), lambda i: substring({0}, i, 3))) end"
_TOK = "list_distinct(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda t: length(t) >= 1))"
_JAC = "len(list_intersect({0}, {1})) / greatest(len(list_distinct(list_concat({0}, {1}))), 1)"


@query(f"select a, b, round(greatest({_JAC.format('ta', 'tb')}, {_JAC.format('wa', 'wb')}), 9) as similarity from (select a, b, {_TRI.format('sa')} as ta, {_TRI.format('sb')} as tb, {_TOK.format('a')} as wa, {_TOK.format('b')} as wb from (select a, b, {_SQ.format('a')} as sa, {_SQ.format('b')} as sb from {_PAIRS}))")
def q_text_similarity(spark, sf_dir):
    l, r = _parts(spark, sf_dir)
    return l.join(r, "block").where("a < b").select("a", "b", F.round(S.text_similarity(F.col("a"), F.col("b")), 9).alias("similarity"))


@query("""select c_nationkey, c_mktsegment, arg_min(c_name, case when c_custkey % 3 <> 0 then c_custkey end) as name, arg_min(cast(c_acctbal as varchar), c_custkey) is not null as has_balance from customer group by all""")
def q_registry_upsert(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").withColumns({"name": F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise(""), "bal": F.col("c_acctbal").cast("string")})
    u = registry.upsert(c, ["c_nationkey", "c_mktsegment"], ["name", "bal"], "c_custkey")
    return u.select("c_nationkey", "c_mktsegment", "name", F.col("bal").isNotNull().alias("has_balance"))


def _registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    banks = _t(spark, sf_dir, "nation").selectExpr("lower(replace(n_name, '_', ' ')) as rkey", "cast(n_nationkey as string) as bank_id", "n_name as name", "array(concat('alt ', n_nationkey)) as alt_keys", "n_regionkey as branch_count")
    branches = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr("lower(replace(n_name, '_', ' ')) as rkey", "lower(regexp_replace(s_name, '#0*', ' ')) as bkey", "cast(s_suppkey as string) as fi_branch_id", "lpad(cast(s_suppkey as string), 9, '0') as routing", "s_name as name", "'' as district")
    return banks, branches


@query("""select distinct bank, case when k = 2 then null else lower(replace(n_name, '_', ' ')) end as rkey, case when k = 2 then null else cast(n_nationkey as varchar) end as bank_id, case when k < 2 then 'exact' when k = 3 then 'ratio' end as stage
 from (select c_custkey % 4 as k, c_nationkey, case c_custkey % 4 when 0 then 'Alt ' || c_nationkey || ' Bank Ltd' when 1 then 'NATION ' || c_nationkey || ' Bank PLC' when 2 then 'EXIM Bank' else 'Natoin ' || c_nationkey end as bank from customer) join nation on n_nationkey = c_nationkey""")
def q_bank_lookup(spark, sf_dir):
    names = _t(spark, sf_dir, "customer").selectExpr("case when c_custkey % 4 = 0 then 'Alt ' || (c_nationkey) || ' Bank Ltd' when c_custkey % 4 = 1 then 'NATION ' || c_nationkey || ' Bank PLC' when c_custkey % 4 = 2 then 'EXIM Bank' else 'Natoin ' || c_nationkey end as bank")
    return registry.lookup_banks(names, _registry(spark, sf_dir)[0])


@query("""select lower(replace(n_name, '_', ' ')) as rkey, case when s_suppkey % 3 = 0 then 'Supplir ' || s_suppkey || ' Branch' else 'Supplier ' || s_suppkey || ' Sub-Branch' end as name, 'supplier ' || case when s_suppkey > 0 then cast(s_suppkey as varchar) else '' end as bkey, cast(s_suppkey as varchar) as fi_branch_id,
 lpad(cast(s_suppkey as varchar), 9, '0') as routing, case when s_suppkey % 3 = 0 then 'ratio' else 'exact' end as stage from supplier join nation on n_nationkey = s_nationkey""")
def q_branch_lookup(spark, sf_dir):
    banks, branches = _registry(spark, sf_dir)
    r = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr("lower(replace(n_name, '_', ' ')) as rkey", "case when s_suppkey % 3 = 0 then 'Supplir ' || s_suppkey || ' Branch' else 'Supplier ' || s_suppkey || ' Sub-Branch' end as name")
    return registry.lookup_branches(r, branches)


@query()
def q_merge_offices(spark, sf_dir):
    _, b = _registry(spark, sf_dir)
    return registry.merge_offices(b.where("cast(fi_branch_id as int) % 2 = 0"), b.where("cast(fi_branch_id as int) % 2 = 1").drop("fi_branch_id"))


@query("""with w as (select r_name as bank, n_name as member, n_nationkey as rank from region join nation on n_regionkey = r_regionkey), ok as (select n_name as member from nation where n_nationkey % 7 <> 3),
 g as (select bank from w left join ok using (member) group by bank having count(*) = count(ok.member)), r as (select n_name as member, c_custkey as ord, c_mktsegment as name from customer join nation on c_nationkey = n_nationkey)
 select bank, name, arg_min(ord, (rank, ord)) as ord from w join g using (bank) join r using (member) where bank in (select bank from g) group by bank, name""")
def q_constituents(spark, sf_dir):
    nation, region, c = (_t(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    wanted = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("r_name").alias("bank")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: x["n_name"]).alias("constituents"))
    parts = nation.selectExpr("n_name as _bank", "case when n_nationkey % 7 = 3 then 'failed' else 'success' end as status")
    records = c.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("n_name as bank", "c_custkey as ord", "c_mktsegment as name", "'' as address", "false as is_sub")
    return store.constituents(wanted, parts, records).select("bank", "name", "ord")


@query("select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")
def q_resume(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").selectExpr("o_custkey as _bank", "case when o_orderstatus = 'F' then 'success' else 'failed' end as status")
    return store.resumable(_t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("bank")), o).select(F.col("bank").alias("c_custkey"))


@query("select s_suppkey from supplier where regexp_replace(lower(s_name), '[^a-z0-9]+', '_', 'g') in (select regexp_replace(lower(replace(c_name, 'Customer', 'Supplier')), '[^a-z0-9]+', '_', 'g') from customer where c_custkey % 2 = 0)")
def q_stale_parts(spark, sf_dir):
    banks = _t(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.replace("c_name", F.lit("Customer"), F.lit("Supplier")).alias("bank"))
    return store.current(_t(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("_bank")), banks).select("s_suppkey")


@query("""with o as (select o_custkey as k, arg_min(o_orderstatus, o_orderkey) as status, min(o_orderkey) as v from orders group by 1), n as (select o_custkey as k, arg_max(o_orderstatus, o_orderkey) as status, max(o_orderkey) as v from orders where o_orderkey % 3 > 0 group by 1)
 select coalesce(o.k, n.k) as k, case when n.k is not null and (o.k is null or n.status = 'F' or o.status <> 'F') then n.status else o.status end as status, case when n.k is not null and (o.k is null or n.status = 'F' or o.status <> 'F') then n.v else o.v end as v from o full join n on o.k = n.k""")
def q_no_clobber(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey"))
    old = o.groupBy("k").agg(F.min_by("o_orderstatus", "o_orderkey").alias("status"), F.min("o_orderkey").alias("v"))
    new = o.where("o_orderkey % 3 > 0").groupBy("k").agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"), F.max("o_orderkey").alias("v"))
    return store.no_clobber(old, new, "k", good="F")


@query("select n.c_custkey, n.v from (select c_custkey, c_acctbal * (c_custkey % 2) as v from customer) n join customer o using (c_custkey) where n.v is distinct from o.c_acctbal")
def q_changed(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return store.changed(c.select("c_custkey", F.col("c_acctbal").alias("v")), c.select("c_custkey", (F.col("c_acctbal") * (F.col("c_custkey") % 2)).alias("v")), "c_custkey")


@query("select l_suppkey as bank, count(case when l_returnflag <> 'R' then 1 end) as total_branch, count(case when l_returnflag = 'R' then 1 end) as total_sub_branch from lineitem group by 1")
def q_totals(spark, sf_dir):
    return store.totals(_t(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("bank"), (F.col("l_returnflag") == "R").alias("is_sub")))


@query("""with r as (select n_name as bank, c_custkey % 3 = 0 as sub, case when c_custkey % 10 = 0 then 'ATM ' || c_custkey else c_name end as name, case when c_nationkey % 4 = 0 and c_custkey % 2 = 0 then '' else 'x' end as address from customer join nation on c_nationkey = n_nationkey)
 select n_name as bank, case when n_nationkey % 5 = 0 then 'failed' else 'success' end as status, count(case when not sub then 1 end) as branches, count(case when sub then 1 end) as subs, count(case when regexp_matches(lower(name), 'atm') then 1 end) as n_junk,
 coalesce(count(case when address = '' then 1 end) / nullif(count(name), 0), 0.0) > 0.2 as flag_empty, n_nationkey % 5 = 0 as flag_status, case when contains(lower(n_name), 'nation_1') then count(case when not sub then 1 end) - 50 end as d_branches
 from nation left join r on r.bank = n_name group by n_name, n_nationkey""")
def q_audit(spark, sf_dir):
    nation, c = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "customer")
    r = c.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("n_name as bank", "c_custkey % 3 = 0 as is_sub", "case when c_custkey % 10 = 0 then 'ATM ' || c_custkey else c_name end as name", "case when c_nationkey % 4 = 0 and c_custkey % 2 = 0 then '' else 'x' end as address")
    parts = nation.selectExpr("n_name as _bank", "case when n_nationkey % 5 = 0 then 'failed' else 'success' end as status")
    expected = spark.range(1).selectExpr("0 as ord", "'nation_1' as key", "50L as branches", "0L as subs")
    return store.audit(parts, r, expected).select("bank", "status", "branches", "subs", "n_junk", "flag_empty", "flag_status", "d_branches")


@query("""with recursive e as (select 's' || (page_id // 7) as parent, case when page_id % 3 = 0 then 's' || page_id else 'p' || page_id end as child, page_id % 3 = 0 as is_index from pages),
 w as (select distinct 's' || (page_id % 5) as site, 's' || (page_id % 5) as child, true as is_index, 0 as level from pages union select w.site, e.child, e.is_index, w.level + 1 from w join e on e.parent = w.child where w.is_index and w.level < 3)
 select site, child as url, min(level) as level from w where not is_index group by site, child""")
def q_sitemap(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    edges = p.selectExpr("'s' || (page_id div 7) as parent", "case when page_id % 3 = 0 then 's' || page_id else 'p' || page_id end as child", "page_id % 3 = 0 as is_index")
    roots = p.selectExpr("'s' || (page_id % 5) as site", "'s' || (page_id % 5) as url").distinct()
    return tables.sitemap_urls(edges, roots)


@query("""select user_id, line, string_agg(event_type, ' ' order by t, event_id, event_type) as words from (select *, sum(starts) over (partition by user_id order by t, event_id, event_type rows unbounded preceding) as line from
 (select user_id, event_id, event_type, round(value) as t, case when round(value) - lag(round(value)) over (partition by user_id order by round(value), event_id, event_type) > 2 or lag(round(value)) over (partition by user_id order by round(value), event_id, event_type) is null then 1 else 0 end as starts from events)) group by all""")
def q_lines_from_words(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", F.col("value").alias("top"), F.col("event_id").alias("x0"), F.col("event_type").alias("text"))
    return tables.lines_from_words(e, ["user_id"]).select("user_id", "line", F.array_join("words", " ").alias("words"))


@query("select event_id, coalesce(json_extract_string(props, '$.k'), '') as k from events")
def q_json_pick(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", extract.json_pick(F.from_json("props", "map<string,string>"), ["^key$", "^k$"]).alias("k"))


@query("""select doc_id, block, count(*) as n, sum(length(t)) as chars from (select doc_id, line, x, trim(regexp_replace(trim(trim(x, '#*- '), '`'), '\\s+', ' ', 'g')) as t, sum(case when x = '' then 1 else 0 end) over (partition by doc_id order by line rows unbounded preceding) as block
 from (select doc_id, i as line, trim(ls[i], chr(32) || chr(9)) as x from (select doc_id, string_split(text, chr(10)) as ls from documents), lateral (select unnest(range(1, len(ls) + 1)) as i))) where x <> '' and not regexp_matches(x, '^(\\||!\\[|---|===)') group by all""")
def q_line_blocks(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    b = extract.line_blocks(d, ["doc_id"])
    return b.select("doc_id", "block", F.size("lines").cast("long").alias("n"), F.aggregate("lines", F.lit(0), lambda a, x: a + F.length(x)).cast("long").alias("chars"))


@query("select page_id, tag, count(*) as n from (select page_id, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->|(<script[^>]*>).*?</script>', '\\1', 'g'), '<([a-z][a-z0-9]*)', 1)) as tag from pages) group by all")
def q_dom_tags(spark, sf_dir):
    return dom.elements(_t(spark, sf_dir, "pages")).groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query("select n_name as bank, n_name || '.com' as website, list_filter(list_transform(string_split('a' || n_nationkey || '; b|a' || n_nationkey, ';'), lambda x: trim(x)), lambda x: x <> '')[1] as first_page, n_regionkey = 1 as registry from nation")
def q_seeds(spark, sf_dir):
    raw = _t(spark, sf_dir, "nation").selectExpr("n_name as ` Bank_Name `", "concat(' ', n_name, '.com') as website", "concat('a', n_nationkey, '; b|a', n_nationkey) as branch_page_url", "case when n_regionkey = 1 then 'Yes' else 'no' end as registry")
    return tables.seeds_from(raw).select("bank", "website", F.get("seed_pages", F.lit(0)).alias("first_page"), "registry")


@query("select n_name as bank, c_custkey % 3 = 0 as is_sub, c_name as name, c_mktsegment as address, nullif(case when c_custkey % 2 = 0 then '' else 'p' end, '') as phone from customer join nation on c_nationkey = n_nationkey")
def q_parts_round_trip(spark, sf_dir):
    nation, c = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "customer")
    r = c.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr("n_name as bank", "c_custkey % 3 = 0 as is_sub", "c_custkey as ord", "c_name as name", "c_mktsegment as address", "'' as page_url", "case when c_custkey % 2 = 0 then '' else 'p' end as phone", "'' as fi_branch_id", "'' as routing_no")
    about = nation.selectExpr("n_name as bank", "'' as bank_url", "'x' as method", "'success' as status", "cast(n_nationkey as string) as bank_id")
    parts = tables.to_parts(r, about)
    return tables.records_of(tables.parts_from_json(parts.select(F.to_json(F.struct("*")).alias("value")))).select("bank", "is_sub", "name", "address", "phone")


@query("select k as bank, link as url, row_number() over (partition by k order by wave, ord, link) - 1 as ord from (select k, link, wave, ord from (select *, row_number() over (partition by k, link order by wave, ord) as nth from (select page_id % 10 as k, 'u' || (page_id % 40) as link, 0 as wave, page_id as ord from pages where page_id % 2 = 0 union all select page_id % 10, 'u' || (page_id % 60), 1, page_id from pages)) where nth = 1)")
def q_seeds_first(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    return fetch.seeds_first(p.where("page_id % 2 = 0").selectExpr("page_id % 10 as bank", "'u' || (page_id % 40) as url", "page_id as ord"), p.selectExpr("page_id % 10 as bank", "'u' || (page_id % 60) as url", "page_id as ord")).withColumn("ord", F.col("ord").cast("long"))


@query(f"""with p as (select page_id % 10 as key, page_id, url, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') as domain from pages),
 s as (select *, least((cast(contains(l, 'tion') as int) + cast(contains(l, 'blog') as int) + cast(contains(l, 'th') as int)) / 3 + case when ends_with(domain, '.bd') then 0.1 else 0 end, 1) as score from (select *, replace(split_part(domain, '.', 1), '-', '') as l from p where not regexp_matches(domain, {_q(V.any_of(V.AGGREGATORS))})))
 select key as bank, arg_max(url, (score, -page_id)) as url, max(score) as score from s where score >= 0.3 group by key""")
def q_official_site(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").select((F.col("page_id") % 10).alias("bank"), "url", F.col("page_id").alias("rank"))
    tokens = p.select("bank").distinct().withColumn("tokens", F.array(F.lit("tion"), F.lit("blog"), F.lit("th")))
    return fetch.official_site(p, tokens)


@query("""with b as (select distinct p_name as bank, list_distinct(string_split(p_name, ' ')) as t from part), w as (select distinct p_type as name, list_distinct(string_split(lower(p_type), ' ')) as t from part), h as (select b.bank, w.name, len(list_intersect(b.t, w.t)) / len(b.t) as share from b, w)
 select bank, max(share) as share from h where share >= 0.3 group by bank""")
def q_wiki_match(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    b = p.select(F.col("p_name").alias("bank"), F.array_distinct(F.split("p_name", " ")).alias("tokens")).distinct()
    w = p.select(F.col("p_type").alias("name"), F.lit("").alias("url"), F.array_distinct(F.split(F.lower("p_type"), " ")).alias("tokens")).distinct()
    return fetch.wiki_match(b, w, 0.3).select("bank", "share")
