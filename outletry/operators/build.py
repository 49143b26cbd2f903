"""Registry building, result shaping and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from outletry.functions import phrases, vocab
from outletry.functions import predicates as P
from outletry.functions.text import branch_key, clean_ws, norm_key, text_of
from outletry.operators.registry import ALIASES, bank_index, coalesce_routing, lookup_branches, resolve_bank_words, upsert

FIELDS = [(k, phrases.anywhere(v)) for k, v in vocab.REGISTRY_WORDS.items()]  # the first that fits a header cell counts
# Words before an outlet's name in a routing line, and older names of districts.
HEADS = ["BANK", "LTD", "PLC", "LIMITED", "AND", "THE", "BANGLADESH", "BANGLDESH"]
OLD_DISTRICTS = ["BOGRA", "CHITTAGONG", "COMILLA", "JESSORE", "BARISAL", "DINAJPUR", "BHOLA", "NOAKHALI", "MADARIPUR"]


def registry_header(rows: DataFrame, keys: list[str], scan: int = 400) -> DataFrame:
    """(keys, row, cells) to the first row that names two fields, a bank among them: keys, row, and a column each."""
    kind = F.lit(None).cast("string")
    for name, p in reversed(FIELDS):
        kind = F.when(F.lower("text").rlike(p), name).otherwise(kind)
    c = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("row"))).where(F.col("nth") <= scan)
    c = c.select(*keys, "row", F.posexplode("cells").alias("col", "text")).withColumn("kind", kind).where("kind is not null")
    m = c.groupBy(*keys, "row").agg(*[F.min(F.when(F.col("kind") == n, F.col("col"))).alias(n) for n, _ in FIELDS])
    named = sum((F.col(n).isNotNull().cast("int") for n, _ in FIELDS[1:]), F.col(FIELDS[0][0]).isNotNull().cast("int"))
    m = m.where((named >= 2) & (F.col("bank_name").isNotNull() | F.col("bank_id").isNotNull()))
    return m.groupBy(*keys).agg(F.min_by(F.struct("row", *[n for n, _ in FIELDS]), "row").alias("h")).select(*keys, "h.*")


def valid_rows(rows: DataFrame) -> DataFrame:
    """Registry rows with a bank that is no number or total, and a branch; a routing of other than 6 to 9 digits is emptied."""
    bank = clean_ws(F.col("bank_name"))
    ok = (bank != "") & (clean_ws(F.col("branch_name")) != "") & ~bank.rlike("^[0-9]+$") & ~F.lower(bank).rlike(r"^(grand\s+)?total")
    return rows.where(ok).withColumn("routing", F.when(text_of(F.col("routing")).rlike("^[0-9]{6,9}$"), F.col("routing")).otherwise(""))


def geo_rows(rows: DataFrame) -> DataFrame:
    """A registry PDF's rows (doc, page, tbl, row, cells) to its fields by the header that each document has once: ord and a column each."""
    by = Window.partitionBy("doc").orderBy("page", "tbl", "row")
    r = rows.withColumn("row", F.row_number().over(by))
    h = registry_header(r, ["doc"])
    d = r.join(h.select("doc", F.col("row").alias("head"), *[F.col(n).alias(f"at_{n}") for n, _ in FIELDS]), "doc").where("row > head")
    cell = lambda n: F.coalesce(F.get("cells", F.col(f"at_{n}")), F.lit(""))
    return d.select(F.row_number().over(Window.partitionBy("doc").orderBy("row")).alias("ord"), *[cell(n).alias(n) for n, _ in FIELDS])


def build_registry(geo: DataFrame, routing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Registry rows and routing lines to (banks, branches).

    geo: ord, bank_name, bank_id, branch_name, fi_branch_id, routing, district; routing:
    line, words (the last is the number). The first value that isn't empty counts.
    """
    fields = ["ord", "bank_name", "bank_id", "branch_name", "fi_branch_id", "routing", "district"]
    g = valid_rows(geo.select(*fields)).withColumns({"rkey": norm_key(F.col("bank_name")), "bkey": branch_key(F.col("branch_name"))}).where("rkey <> '' and bkey <> ''")
    alt = F.array_except(F.array(norm_key(F.col("bank_name"), False)), F.array("rkey"))
    named = g.groupBy("rkey").agg(F.min_by(F.struct("bank_id", F.col("bank_name").alias("name")), "ord").alias("f"), F.array_distinct(F.flatten(F.collect_set(alt))).alias("alt_keys")).select("rkey", "f.*", "alt_keys")
    index = bank_index(named).select("key", "rkey")
    more = [(a, t) for a, t in ALIASES if t]
    for a, t in more:
        index = index.unionByName(index.where(F.col("key") == t).select(F.lit(a).alias("key"), "rkey"))
    lines = routing.withColumns({"number": F.element_at("words", -1), "words": F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0)))})
    r = lines.join(resolve_bank_words(lines, index), "line").withColumn("rest", F.slice("words", F.col("n") + 1, F.size("words")))
    head = lambda x: F.upper(F.btrim(x, F.lit(".")))
    first = F.get(F.filter(F.transform("rest", lambda x, i: F.when(~head(x).isin(*HEADS), i)), lambda i: i.isNotNull()), 0)
    r = r.withColumn("rest", F.slice("rest", F.coalesce(first, F.size("rest")) + 1, F.size("rest"))).where(F.size("rest") > 0)
    districts = g.where("district <> ''").select(F.upper(clean_ws(F.col("district"))).alias("d")).distinct().unionByName(r.sparkSession.range(1).select(F.explode(F.array(*[F.lit(x) for x in OLD_DISTRICTS])).alias("d"))).distinct().withColumn("is_district", F.lit(True))
    r = r.join(districts, head(F.get("rest", F.lit(0))) == F.col("d"), "left")
    cut = F.coalesce("is_district", F.lit(False)) & (F.size("rest") > 1)
    r = r.withColumns({"district": F.when(cut, F.col("d")).otherwise(""), "rest": F.when(cut, F.slice("rest", F.lit(2), F.size("rest"))).otherwise(F.col("rest"))})
    r = r.withColumns({"name": F.array_join("rest", " "), "bkey": branch_key(F.array_join("rest", " "))}).where("bkey <> ''")
    rows = g.select("rkey", "bkey", F.struct(F.lit(0).alias("w"), F.col("ord").cast("long").alias("o")).alias("at"), "fi_branch_id", "routing", F.col("branch_name").alias("name"), "district")
    rows = rows.unionByName(r.select("rkey", "bkey", F.struct(F.lit(1).alias("w"), F.col("line").cast("long").alias("o")).alias("at"), F.lit("").alias("fi_branch_id"), F.col("number").alias("routing"), "name", "district"))
    branches = upsert(rows, ["rkey", "bkey"], ["fi_branch_id", "routing", "name", "district"], "at")
    counts = branches.groupBy("rkey").agg(F.count("*").cast("int").alias("branch_count"))
    return named.join(counts, "rkey", "left").withColumn("branch_count", F.coalesce("branch_count", F.lit(0))), branches


def shape(records: DataFrame, banks: DataFrame, branches: DataFrame) -> DataFrame:
    """Resolved records to stored ones: ids looked up, the site's routing first, kinds guarded by the marker.

    banks: bank, rkey.
    """
    r = records.join(banks, "bank", "left")
    found = lookup_branches(r, branches).select("rkey", "name", "fi_branch_id", F.col("routing").alias("registry_routing"))
    r = r.join(found, ["rkey", "name"], "left")
    null = lambda c: F.nullif(F.col(c), F.lit(""))
    return r.select("bank", (F.col("is_sub") | P.is_sub(F.col("name"))).alias("is_sub"), "ord", "name", null("address").alias("address"), null("url").alias("page_url"), null("phone").alias("phone"), null("fi_branch_id").alias("fi_branch_id"), coalesce_routing(F.col("routing"), F.col("registry_routing")).alias("routing_no"))


def status_of(records: DataFrame, banks: DataFrame) -> DataFrame:
    """(bank, status, error): success where a bank has a record."""
    n = records.groupBy("bank").agg(F.count("*").alias("n"))
    d = banks.select("bank").distinct().join(n, "bank", "left")
    ok = F.coalesce("n", F.lit(0)) > 0
    return d.select("bank", F.when(ok, "success").otherwise("failed").alias("status"), F.when(~ok, "no records").alias("error"))


def run_summary(parts: DataFrame, skipped: int = 0) -> DataFrame:
    """One row: banks by status, those skipped, and records."""
    return parts.agg(F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") == "failed").alias("failed"), F.lit(skipped).cast("long").alias("skipped"), F.coalesce(F.sum("total_branch"), F.lit(0)).alias("branches"), F.coalesce(F.sum("total_sub_branch"), F.lit(0)).alias("sub_branches"))


def upgrade_summary(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: what a repair changed. old, new: stored records."""
    n = new.select("bank", "name", "ord", F.col("is_sub").alias("now"), F.col("fi_branch_id").alias("id_now"), F.col("routing_no").alias("routing_now"))
    d = old.select("bank", "name", "ord", F.col("is_sub").alias("was")).join(n, ["bank", "name", "ord"], "left")
    count = lambda c, name: F.count_if(c).alias(name)
    return d.agg(
        F.count_distinct("bank").alias("parts"), count(F.col("now").isNull(), "dropped"), count(F.col("was") & ~F.col("now"), "to_branch"), count(~F.col("was") & F.col("now"), "to_sub"),
        count(F.col("was") & F.col("now") & ~P.is_sub(F.col("name")), "unmarked_subs"), count(F.col("id_now").isNotNull(), "with_ids"), count(F.col("routing_now").isNotNull(), "with_routing"),
    )
