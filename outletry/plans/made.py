"""Further queries: extractors over pages made from keys, and Columns over made names, with their SQL.

The test tables' pages hold no outlets, so these pages are made here; since they are made
from keys, the SQL says what must be found without reading any page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outletry.functions import phrases
from outletry.functions import predicates as P
from outletry.functions import similarity as S
from outletry.functions import text as T
from outletry.functions import url as U
from outletry.functions import vocab as V
from outletry.operators import extract, resolve
from outletry.plans.registry import _NAMES, _PAIRS, _EDIT, _JAC, _SQ, _TOK, _TRI, _names, _parts, _q, _t, query
from outletry.sources import dom

# A supplier's outlets: two to five, the second a sub-branch. Expressions that Spark and the oracle read alike.
_COUNT = "2 + s_suppkey % 4"
_NAME = "'Town ' || s_suppkey || 'x' || j || case when j = 1 then ' Sub Branch' else ' Branch' end"
_ADDRESS = "j || ' Lake Road, Block ' || s_suppkey"
_PHONE = "'02-' || cast(1000000 + (s_suppkey % 10000) * 10 + j as string)"
_OUTLETS = f"(select s_suppkey as page_id, j, {_NAME} as name, {_ADDRESS} as address, {_PHONE.replace('string', 'varchar')} as phone, j = 1 as is_sub from (select s_suppkey, unnest(range({_COUNT})) as j from supplier))"


def _pages(spark: SparkSession, sf_dir: str, each: str, around: str = "x", between: str = "") -> DataFrame:
    """Pages of the suppliers: `each` over the outlets (name, address, phone, j), joined, with `around` over the result x."""
    k = _t(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.expr(f"sequence(0, cast({_COUNT} - 1 as int))")).alias("j"))
    o = k.selectExpr("s_suppkey", "j", f"{_NAME} as name", f"{_ADDRESS} as address", f"{_PHONE} as phone")
    rows = o.groupBy("s_suppkey").agg(F.array_sort(F.collect_list(F.struct("j", F.expr(each).alias("t")))).alias("rows"))  # five at most
    text = F.array_join(F.transform("rows", lambda r: r["t"]), between).alias("x")
    return rows.select("s_suppkey", text).selectExpr("cast(s_suppkey as bigint) as page_id", "concat('https://b', s_suppkey, '.com/branches') as url", f"{around} as html")


def _found(records: DataFrame, *more: str) -> DataFrame:
    return records.select("page_id", F.col("ord").cast("long").alias("ord"), "name", "address", "phone", "is_sub", *more)


_ROW = "concat('<tr><td>', j + 1, '</td><td><b>', name, '</b></td><td>', address, '</td><td>Tel ', phone, '</td></tr>')"
_TABLE = """concat(case when s_suppkey % 5 = 0 then '<div id="atm-list">' else '<div>' end, '<table><tr><th>SL</th><th>', case when s_suppkey % 7 = 0 then 'Agent Name' else 'Branch Name' end, '</th><th>Address</th><th>Phone</th></tr>', x, '</table></div>')"""


@query(f"select page_id, j as ord, name, address, phone, is_sub from {_OUTLETS} where page_id % 5 <> 0 and page_id % 7 <> 0")
def q_html_tables(spark, sf_dir):
    p = _pages(spark, sf_dir, _ROW, _TABLE)
    return _found(extract.html_tables(dom.elements(p), p))


@query(f"select page_id, j as ord, name, address, phone, is_sub from {_OUTLETS}")
def q_html_cards(spark, sf_dir):
    p = _pages(spark, sf_dir, """concat('<div class="col-md-3"><h4>', name, '</h4><p>', address, '</p><p>Phone ', phone, '</p></div>')""", "concat('<body><nav><h4>Any Branch</h4></nav>', x, '</body>')")
    return _found(extract.html_cards(dom.elements(p), p))


_JSON = """concat('{"branch_name": "', name, '", "address": "', address, '", "phone": "', phone, '", "lat": 1.5}')"""


@query(f"select page_id, j as ord, name, address, phone, is_sub from {_OUTLETS}")
def q_script_json(spark, sf_dir):
    p = _pages(spark, sf_dir, _JSON, """concat('<p>x</p><script>var a = {"kind": 3}; load([', x, ']); var b = [1, 2];</script>')""", ", ")
    return _found(extract.script_json(dom.elements(p), p))


@query(f"select page_id, j as ord, name, address, phone, is_sub from {_OUTLETS} join (select page_id from {_OUTLETS} group by page_id having count(*) >= 4) using (page_id)")
def q_map_windows(spark, sf_dir):
    p = _pages(spark, sf_dir, """concat('w.push({\\'id\\': ', j, ', \\'title\\': "', name, '", "detail": "', address, ' Phone ', phone, '"});')""", "concat('<script>', x, '</script>')")
    return _found(extract.map_windows(p, 4)).withColumn("address", F.regexp_replace("address", " Phone .*", ""))


@query(f"select page_id, j as ord, name, address, phone, is_sub from {_OUTLETS}")
def q_markdown(spark, sf_dir):
    p = _pages(spark, sf_dir, "concat('| **', name, '** | ', address, ' | ', phone, ' |')", "concat('# Branches\\n\\n| Branch Name | Address | Phone |\\n|---|---|---|\\n', x, '\\n\\ntext')", "\n")
    return _found(extract.markdown_records(p.withColumnRenamed("html", "markdown")))


@query(f"select page_id, j as ord, name, address, phone, is_sub, lpad(cast(page_id as varchar), 9, '0') as routing from {_OUTLETS}")
def q_modal_tables(spark, sf_dir):
    each = """concat('<div class="modal"><h5 class="modal-title">', name, ' (', j, ')</h5><table><tr><td>Address:</td><td>', address, '</td></tr><tr><td>Phone</td><td>', phone, '</td></tr><tr><td>Routing No</td><td>', lpad(cast(s_suppkey as string), 9, '0'), '</td></tr></table></div>')"""
    p = _pages(spark, sf_dir, each)
    return _found(extract.modal_tables(dom.elements(p), p), "routing")


@query("""select conv_id, min(turn) as line, max(case when turn % 3 = 0 then 'Outlet ' || turn end) as name, string_agg(case when turn % 3 = 1 then 'Thana ' || turn end, ', ') as address,
 coalesce(max(case when turn % 3 = 2 then '02-' || (1000000 + turn) end), '') as phone from (select distinct conv_id, turn from conversations) group by conv_id, turn // 3 having count(*) > 1""")
def q_label_blocks(spark, sf_dir):
    line = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Branch Name : Outlet "), "turn")).when(F.col("turn") % 3 == 1, F.concat(F.lit("Upazila: Thana "), "turn")).otherwise(F.concat(F.lit("Address: Phone 02-"), F.col("turn") + 1000000))
    c = _t(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("line")).distinct().withColumn("turn", F.col("line"))
    out = extract.label_blocks(c.select("conv_id", "line", line.alias("text"), F.lit(False).alias("page_sub")), ["conv_id"])
    return out.select("conv_id", "line", "name", F.regexp_replace("address", ",? ?Phone 02-.*", "").alias("address"), "phone")


_LOW = "lower(name)"
_NEWS, _GENERIC = f"regexp_matches(lower(name), {_q(phrases.worded(V.NEWS))})", f"regexp_matches(rtrim(lower(name), ' :;,.|-'), {_q(phrases.whole(V.GENERIC))})"
_BOOTH = f"(regexp_matches(lower(name), {_q(V.bounded(V.BOOTHS))}) or regexp_matches(lower(name), 'adjacent to (the )?branch'))"
_PREMISES, _PROMO = f"regexp_matches(lower(name), {_q(V.PREMISES)})", f"regexp_matches(lower(name), {_q(phrases.worded(V.PROMOS))})"
_DIGITS = "(name <> '' and not regexp_matches(name, '[\\p{L}\\p{M}]'))"
_MARKED = f"(regexp_matches(lower(name), 'branch|শাখা') or regexp_matches(lower(name), {_q(V.SUB)}))"
_PLACED = "(" + " or ".join(f"contains(lower(address), {_q(w)})" for w in V.ADDRESS_WORDS) + " or length(trim(address)) >= 40)"


@query(f"""select id, length(regexp_extract({_LOW}, '^(.[^,;|:]*?)\\s+sub[\\s._-]*[bo]', 1)) >= 3 as sub_line, regexp_matches({_LOW}, 'sub|উপশাখা|up[oa]sh') as sub_loose, {_NEWS} as news, {_GENERIC} as generic, {_DIGITS} as digits,
 {_BOOTH} or {_NEWS} or {_GENERIC} or {_PREMISES} or {_PROMO} or {_DIGITS} or trim(name) = '' as junk, not {_MARKED} and not {_PLACED} as bare from {_NAMES}""")
def q_more_flags(spark, sf_dir):
    n, none = F.col("name"), F.lit("")
    flags = {"sub_line": P.is_sub_line(n), "sub_loose": P.is_sub_loose(n), "news": P.is_news(n), "generic": P.is_generic_name(n), "digits": P.is_digits(n), "junk": P.is_junk_name(n), "bare": P.is_bare(n, F.col("address"), none, none)}
    return _names(spark, sf_dir).select("id", *[f.alias(k) for k, f in flags.items()])


@query(f"""select id, name from {_NAMES} where not ({_BOOTH} or {_NEWS} or {_GENERIC} or {_PREMISES} or {_PROMO} or {_DIGITS} or trim(name) = '') and not regexp_matches(trim(name), '[,;]$') and ({_MARKED} or {_PLACED})""")
def q_keep_records(spark, sf_dir):
    return _names(spark, sf_dir).where(P.keeps_record(F.col("name"), F.col("address"), F.lit(""), F.lit(""))).select("id", "name")


_SEGMENT = "case c_custkey % 5 when 0 then 'Address: Level 4, Green Tower, Phone: 02-9551234' when 1 then c_custkey || ' Road<br/>Dhaka, Email:' when 2 then 'Cell - 01711-' || lpad(cast(c_custkey as {0}), 6, '0') || ' Zone ' || c_nationkey when 3 then 'Division: Dhaka ' || c_custkey else 'mail x' || c_custkey || '@y.com, Gulshan Branch, Dhaka' end"


@query(f"""select id, case id % 5 when 0 then 'Level 4, Green Tower,' when 1 then id || ' Road Dhaka' when 2 then 'Zone ' || nation when 3 then '' else 'mail Gulshan Branch, Dhaka' end as address,
 case id % 5 when 0 then '02-9551234' when 2 then '01711-' || lpad(cast(id as varchar), 6, '0') || ' ' else '' end as phone, case when id % 5 = 4 then 'Gulshan Branch' else '' end as salvaged from {_NAMES}""")
def q_clean_address(spark, sf_dir):
    a = _t(spark, sf_dir, "customer").selectExpr("c_custkey as id", f"{_SEGMENT.format('string')} as a")
    return a.select("id", T.clean_address(F.col("a")).alias("address"), T.labelled_phone(F.col("a")).alias("phone"), T.salvaged_name(F.lit(""), F.col("a")).alias("salvaged"))


_TEXTS = "case c_custkey % 4 when 0 then 'Routing No: ' || lpad(cast(c_custkey as {0}), 9, '0') || '.' when 1 then '**[Gulshan ' || c_custkey || '](http://x)**' when 2 then 'Gulshan ' || c_custkey || ', 12 Lake Road, Dhaka' else '0171 ; http://x/' || c_custkey || ' ; /media/a' end"


@query(f"""select id, case when id % 4 = 0 then lpad(cast(id as varchar), 9, '0') else '' end as routing, case when id % 4 = 1 then 'Gulshan ' || id else t end as markdown, case when id % 4 in (1, 3) then case id % 4 when 3 then '0171 ' else '' end else t end as phone,
 case when id % 4 = 2 then 'Gulshan ' || id else '' end as head, case when id % 4 = 2 then '12 Lake Road, Dhaka' else '' end as rest from (select c_custkey as id, {_TEXTS.format('varchar')} as t from customer)""")
def q_text_more(spark, sf_dir):
    t = F.col("t")
    d = _t(spark, sf_dir, "customer").selectExpr("c_custkey as id", f"{_TEXTS.format('string')} as t")
    return d.select("id", T.routing_in(t).alias("routing"), T.markdown_text(t).alias("markdown"), T.drop_media(t).alias("phone"), T.split_head(t)["head"].alias("head"), T.split_head(t)["rest"].alias("rest"))


@query("""select p_partkey, regexp_replace(lower(p_name), '([a-z0-9])', '\\1\\1', 'g') as doubled, replace(lower(p_name), ' ', '') as halved, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(left(w, 1)) || substring(w, 2)), ' ') || ' Branch' as title,
 array_to_string(case when list_position(['almond', 'antique'], string_split(p_name, ' ')[1]) > 0 and len(string_split(p_name, ' ')) > 1 then string_split(p_name, ' ')[2:] else string_split(p_name, ' ') end, ' ') as region_free from part""")
def q_words_more(spark, sf_dir):
    n = F.lower("p_name")
    squashed = F.replace(n, F.lit(" "), F.lit(""))
    doubled = F.regexp_replace(n, "([a-z0-9])", "$1$1")
    return _t(spark, sf_dir, "part").select("p_partkey", doubled.alias("doubled"), T.unpair(F.regexp_replace(squashed, "([a-z0-9])", "$1$1")).alias("halved"), T.office_title(F.col("p_name")).alias("title"), F.array_join(T.strip_regions(F.split("p_name", " "), ["almond", "antique"]), " ").alias("region_free"))


_SPELT = "case p_partkey % 4 when 0 then v || ' ' || w when 1 then v || substring(w, 2) when 2 then substring(v, 2) || w || 'x' else v || w || 'y Branch' end"
_WORDS = "(select p_partkey, split_part(p_name, ' ', 1) as v, split_part(p_name, ' ', 2) as w from part)"


@query(f"""with n as (select distinct p_partkey % 3 as bank, case when p_partkey % 5 = 0 then 'true' else 'false' end as sub, regexp_replace(lower({_SPELT}), '[^a-z0-9]', '', 'g') as n from {_WORDS}),
 p as (select l.bank, l.sub, l.n as a, r.n as b from n l join n r using (bank, sub) where l.n < r.n)
 select * from p where {_EDIT} >= 0.8 or ((starts_with(a, b) or starts_with(b, a)) and least(length(a), length(b)) >= 0.5 * greatest(length(a), length(b)))""")
def q_candidate_edges(spark, sf_dir):
    w = _t(spark, sf_dir, "part").selectExpr("p_partkey", "split_part(p_name, ' ', 1) as v", "split_part(p_name, ' ', 2) as w")
    r = w.selectExpr("p_partkey % 3 as bank", f"{_SPELT} as name", "p_partkey % 5 = 0 as is_sub")
    e = resolve.candidate_edges(r)
    return e.where(resolve.name_gate(F.col("a"), F.col("b")))  # those that hang together by their key alone are another rule


_AGREE = f"""(contains(a, b) or contains(b, a) or greatest({_JAC.format('ta', 'tb')}, {_JAC.format('wa', 'wb')}) >= 0.55)"""


@query(f"""with t as (select a, b, {_TRI.format('sa')} as ta, {_TRI.format('sb')} as tb, {_TOK.format('a')} as wa, {_TOK.format('b')} as wb, list_filter({_TOK.format('a')}, lambda t: length(t) >= 2) as x, list_filter({_TOK.format('b')}, lambda t: length(t) >= 2) as y from (select a, b, {_SQ.format('a')} as sa, {_SQ.format('b')} as sb from {_PAIRS})),
 s as (select *, case when len(x) <= len(y) then x else y end as small, case when len(x) <= len(y) then y else x end as big from t),
 f as (select *, len(small) = 0 or len(list_filter(small, lambda t: len(list_filter(big, lambda u: t = u or (length(t) >= 5 and length(u) >= 5 and abs(length(t) - length(u)) <= 6 and 1 - levenshtein(t, u) / greatest(length(t), length(u)) >= 0.8))) > 0)) / len(small) >= 0.7 as subset from s)
 select a, b, {_AGREE} or subset as agree, subset from f""")
def q_addresses_agree(spark, sf_dir):
    l, r = _parts(spark, sf_dir)
    return l.join(r, "block").where("a < b").select("a", "b", S.addresses_agree(F.col("a"), F.col("b")).alias("agree"), S.fuzzy_subset(F.col("a"), F.col("b")).alias("subset"))


@query(f"""with s as (select *, split_part(regexp_replace(lower(name), '[^a-z0-9 ]', '', 'g'), ' ', 1) as w from {_NAMES}) select id, name, list_sort(list_distinct(list_filter(regexp_extract_all(lower(name), '[a-z0-9]{{3,}}'), lambda t: t not in ({', '.join(map(_q, V.STOP_WORDS))})))) as words from s where regexp_matches(lower(name), '[a-z0-9]{{3,}}') and not regexp_matches(name, '[A-Z]{{2,5}}[ (]|[(]')
 and len(list_filter(regexp_extract_all(lower(name), '[a-z0-9]{{3,}}'), lambda t: t not in ({', '.join(map(_q, V.STOP_WORDS))}))) > 0""")
def q_name_tokens(spark, sf_dir):
    n = _names(spark, sf_dir).where(F.col("name").rlike("(?i)[a-z0-9]{3,}") & ~F.col("name").rlike("[A-Z]{2,5}[ (]|[(]"))
    words = F.filter(F.regexp_extract_all(F.lower("name"), F.lit("[a-z0-9]{3,}"), 0), lambda w: ~w.isin(*V.STOP_WORDS))
    return n.where(F.size(words) > 0).select("id", "name", F.array_sort(T.name_tokens(F.col("name"))).alias("words"))


@query("""select page_id, 'https://x.com/' || case page_id % 3 when 0 then 'sub-branches' when 1 then 'branch-atm' else 'atm' end as link, page_id % 3 = 2 as other, page_id % 3 = 0 as sub, contains(lower(url), 'facebook') as aggregator from pages""")
def q_link_kinds(spark, sf_dir):
    link = F.concat(F.lit("https://x.com/"), F.expr("case page_id % 3 when 0 then 'sub-branches' when 1 then 'branch-atm' else 'atm' end"))
    p = _t(spark, sf_dir, "pages").withColumn("link", link)
    return p.select("page_id", "link", P.is_non_branch_page(F.col("link")).alias("other"), U.page_is_sub(F.col("link")).alias("sub"), U.is_aggregator(F.lower("url"), ["facebook"]).alias("aggregator"))
