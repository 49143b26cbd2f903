"""Seeds, parts, registry, sitemaps and PDF words as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PART = "_bank string, bank_url string, method string, status string, bank_id string, total_branch int, total_sub_branch int, error string, constituents array<string>, merged_duplicates int, branch array<map<string,array<string>>>, sub_branch array<map<string,array<string>>>"
FIELDS = ("address", "page_url", "phone", "fi_branch_id", "routing_no")  # fixed order of a stored record
REGISTRY_BANKS = "rkey string, bank_id string, name string, alt_keys array<string>, branch_count int"
REGISTRY_BRANCHES = "rkey string, bkey string, fi_branch_id string, routing string, name string, district string"


def _list(c):
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"[;|]"), lambda x: F.btrim(x)), lambda x: x != "")


def seeds_from(raw: DataFrame) -> DataFrame:
    """Seed rows of strings to bank, website, seed_pages, constituents, registry.

    Headers are trimmed and lower-cased; missing columns are null. Rows without a name,
    and headers that are repeated, go. `kinds` says which column a page came from.
    """
    names = {c.strip().lower(): c for c in raw.columns}
    col = lambda *alts: F.coalesce(*[F.btrim(F.col(f"`{names[a]}`").cast("string")) for a in alts if a in names], F.lit(None).cast("string"))
    first = F.btrim(F.col(f"`{raw.columns[0]}`").cast("string"))
    d = raw.select(
        F.coalesce(F.nullif(col("bank_name"), F.lit("")), first).alias("bank"), col("bank_url", "website").alias("website"),
        _list(col("branch_page_url")).alias("b"), _list(col("sub_branch_page_url")).alias("s"), _list(col("branch_pages")).alias("p"), _list(col("constituents")).alias("constituents"),
        F.coalesce(F.lower(col("registry")).isin("yes", "true", "1", "x"), F.lit(False)).alias("registry"),
    )
    d = d.where((F.col("bank") != "") & (F.lower("bank") != "bank_name"))
    return d.select("bank", "website", F.array_distinct(F.concat("b", "s", "p")).alias("seed_pages"), "constituents", "registry")


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return seeds_from(spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True))


_RAW = PART.replace("array<map<string,array<string>>>", "array<map<string,string>>")


def _entry(e):
    """A record of a part as map of its name to the five fields: from {name: [fields]}, {name: {fields}} or {"name": ..., fields}."""
    own = F.element_at(F.map_entries(e), 1)
    named = e["name"].isNotNull() & (F.size(F.map_keys(e)) > 1)
    field = lambda m, f: F.coalesce(m[f], m["url"]) if f == "page_url" else F.coalesce(m[f], m["routing"]) if f == "routing_no" else m[f]
    of = lambda m: F.array(*[field(m, f) for f in FIELDS])
    listed = F.from_json(own["value"], "array<string>")
    value = F.when(named, of(e)).when(F.ltrim(own["value"]).startswith("{"), of(F.from_json(own["value"], "map<string,string>"))).otherwise(listed)
    padded = F.transform(F.sequence(F.lit(0), F.lit(len(FIELDS) - 1)), lambda i: F.get(value, i))
    return F.create_map(F.when(named, e["name"]).otherwise(own["key"]), F.when(value.isNotNull(), padded))


def parts_from_json(texts: DataFrame, column: str = "value") -> DataFrame:
    """JSON texts to parts by the explicit schema; what doesn't parse goes.

    Records of older shapes are read as those of today: an object of fields under the
    name, or one with the name among its fields; missing fields are null.
    """
    p = texts.select(F.from_json(F.col(column), _RAW).alias("p")).where(F.col("p._bank").isNotNull()).select("p.*")
    entries = lambda c: F.transform(F.filter(c, lambda e: F.coalesce(F.size(e), F.lit(0)) > 0), _entry)
    return p.withColumns({c: entries(c) for c in ("branch", "sub_branch")}).select(*[f.split()[0] for f in PART.split(", ")])


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """All part files below a path."""
    return parts_from_json(spark.read.text(path, wholetext=True))


def records_of(parts: DataFrame) -> DataFrame:
    """Parts to one row a record: bank, is_sub, ord, name and the five fields."""
    each = lambda c, sub: parts.select(F.col("_bank").alias("bank"), F.lit(sub).alias("is_sub"), F.posexplode(c).alias("ord", "entry"))
    r = each("branch", False).unionByName(each("sub_branch", True))
    e = F.element_at(F.map_entries("entry"), 1)
    return r.select("bank", "is_sub", "ord", e["key"].alias("name"), *[F.get(e["value"], F.lit(i)).alias(f) for i, f in enumerate(FIELDS)])


def to_parts(records: DataFrame, about: DataFrame) -> DataFrame:
    """Records and one row a bank (what a part says besides, as far as it is there) to parts; empty strings become null."""
    value = F.array(*[F.nullif(F.col(f), F.lit("")) for f in FIELDS])
    line = F.struct("ord", "name", value.alias("v"))
    lists = records.groupBy("bank").agg(*[F.transform(F.array_sort(F.collect_list(F.when(F.col("is_sub") == s, line))), lambda x: F.create_map(x["name"], x["v"])).alias(n) for n, s in (("branch", False), ("sub_branch", True))])
    d = about.join(lists, "bank", "left")
    none = F.array().cast("array<map<string,array<string>>>")
    d = d.withColumns({n: F.coalesce(n, none) for n in ("branch", "sub_branch")})
    made = {"_bank": F.col("bank"), "total_branch": F.size("branch"), "total_sub_branch": F.size("sub_branch")}
    kinds = dict(f.split(" ", 1) for f in PART.split(", "))
    return d.select(*[made.get(c, F.col(c) if c in d.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])


def registry_from_json(texts: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """A registry document to its banks and branches; none if it doesn't parse."""
    schema = "banks map<string,struct<bank_id:string,name:string,alt_keys:array<string>,branch_count:int>>, branches map<string,map<string,struct<fi_branch_id:string,routing:string,name:string,district:string>>>"
    r = texts.select(F.from_json(F.col(column), schema).alias("r"))
    banks = r.select(F.explode("r.banks").alias("rkey", "v")).select("rkey", "v.*")
    branches = r.select(F.explode("r.branches").alias("rkey", "m")).select("rkey", F.explode("m").alias("bkey", "v")).select("rkey", "bkey", "v.*")
    return banks, branches


def registry_to_json(banks: DataFrame, branches: DataFrame, sources: list[str]) -> DataFrame:
    """The registry document: one row, for export; the registry is a small dimension."""
    n = branches.groupBy("rkey").agg(F.count("*").cast("int").alias("branch_count"), F.map_from_entries(F.collect_list(F.struct("bkey", F.struct("fi_branch_id", "routing", "name", "district")))).alias("m"))
    b = banks.drop("branch_count").join(n, "rkey", "left")
    about = F.struct(F.date_format(F.current_date(), "yyyy-MM-dd").alias("generated"), F.array(*[F.lit(s) for s in sources]).alias("sources"), F.sum(F.coalesce("branch_count", F.lit(0))).alias("data_rows"))
    return b.agg(F.to_json(F.struct(about.alias("_meta"), F.map_from_entries(F.collect_list(F.struct("rkey", F.struct("bank_id", "name", "alt_keys", "branch_count")))).alias("banks"), F.map_from_entries(F.collect_list(F.when(F.col("m").isNotNull(), F.struct("rkey", "m")))).alias("branches"))).alias("value"))


def pdf_rows(cells: DataFrame) -> DataFrame:
    """PDF cells (doc, page, tbl, row, col, text) to rows of clean cells, without empty rows."""
    clean = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", " "))
    r = cells.groupBy("doc", "page", "tbl", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("col", clean.alias("t")))), lambda x: x["t"]).alias("cells"))
    return r.where(F.exists("cells", lambda x: x != ""))


def lines_from_words(words: DataFrame, keys: list[str], top: str = "top", left: str = "x0", gap: float = 2.0) -> DataFrame:
    """Positioned words to lines: a new one where the top jumps by more than `gap`.

    keys name a page; a page's words are sorted in one task, which no page outgrows.
    """
    by = Window.partitionBy(*keys).orderBy(F.round(top), left, "text")
    w = words.withColumn("t", F.round(top)).withColumn("starts", F.coalesce((F.col("t") - F.lag("t").over(by)) > gap, F.lit(True)).cast("int"))
    w = w.withColumn("line", F.sum("starts").over(by))
    return w.groupBy(*keys, "line").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", left, "text"))), lambda x: x["text"]).alias("words"))


def routing_lines(lines: DataFrame) -> DataFrame:
    """Lines of three words or more that end in a nine-digit number, words unpaired and trimmed."""
    from outletry.functions.text import unpair

    words = F.transform("words", lambda x: unpair(F.btrim(x, F.lit(".,"))))
    return lines.withColumn("words", words).where((F.size("words") >= 3) & F.element_at("words", -1).rlike("^[0-9]{9}$"))


def sitemap_urls(edges: DataFrame, roots: DataFrame, depth: int = 3, most: int = 3000) -> DataFrame:
    """(site, url, level) of the pages below each site's sitemaps.

    edges: parent, child, is_index; roots: site, url. One join a level, each child once a
    site (at its first level), so cycles end; `most` is the cap on a site's pages.
    """
    edges = edges.select("parent", "child", "is_index").distinct()
    level, seen = roots.select("site", F.col("url").alias("child"), F.lit(True).alias("is_index"), F.lit(0).alias("level")).distinct(), None
    seen = level
    for k in range(1, depth + 1):
        nxt = level.where("is_index").select("site", F.col("child").alias("parent")).join(edges, "parent").select("site", "child", "is_index", F.lit(k).alias("level")).distinct()
        level = nxt.join(seen, ["site", "child"], "left_anti")
        seen = seen.unionByName(level)
    by = Window.partitionBy("site").orderBy("level", "child")
    return seen.where("not is_index").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most).select("site", F.col("child").alias("url"), "level")


def sitemap_edges(documents: DataFrame) -> DataFrame:
    """Sitemap XML (url, xml) to edges, namespaces ignored."""
    is_index = F.lower("xml").rlike("<([a-z0-9]+:)?sitemapindex")
    locs = F.regexp_extract_all("xml", F.lit(r"(?is)<(?:[a-z0-9]+:)?loc[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</"), 1)
    return documents.select(F.col("url").alias("parent"), F.explode(locs).alias("child"), is_index.alias("is_index"))


def robots_sitemaps(robots: DataFrame) -> DataFrame:
    """(site, url) of a site's Sitemap lines, and of the usual places."""
    usual = ["/sitemap.xml", "/sitemap_index.xml", "/wp-sitemap.xml", "/sitemap-index.xml", "/page-sitemap.xml"]
    named = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?im)^\s*sitemap:\s*(\S+)"), 1)
    places = F.array(*[F.concat(F.rtrim("site", F.lit("/")), F.lit(p)) for p in usual])
    return robots.select("site", F.explode(F.array_distinct(F.concat(named, places))).alias("url"))
