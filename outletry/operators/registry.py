"""Joins to a registry of banks and branches: cascades from exact to fuzzy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outletry.functions.similarity import sequence_ratio
from outletry.functions.text import branch_key, norm_key, office_title, strip_regions, text_of

# Keys of banks that the registry lists under another name; null: not listed.
ALIASES = [("exim", "export import"), ("hsbc", "hong kong shanghai banking corporation"), ("ncc", "national credit commerce"), ("standard", "standard islami"), ("sammilito islami", None)]


def bank_index(banks: DataFrame) -> DataFrame:
    """(key, rkey, bank_id): each key and other key of a bank; own keys before others'."""
    rows = banks.select(F.col("rkey").alias("key"), F.lit(0).alias("rank"), "rkey", "bank_id").unionByName(banks.select(F.explode("alt_keys").alias("key"), F.lit(1).alias("rank"), "rkey", "bank_id")).where("key <> ''")
    return rows.groupBy("key").agg(F.min_by(F.struct("rkey", "bank_id"), F.struct("rank", "rkey")).alias("e")).select("key", "e.*")


def _pairs(left: DataFrame, k: str, right: DataFrame, key: str, fuzzy: float) -> DataFrame:
    """Distinct (k, key): keys of which one holds the other, or whose lengths allow a ratio of `fuzzy`, by an equi-join.

    Such keys share a run of two characters: the one that is held is such a run or has
    one, and a ratio of 0.8 or more leaves fewer gaps than single characters would
    need, but for keys of four characters together, which agree or don't match.
    """
    runs = lambda c: F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(2)))))
    a = left.select(F.col(k).alias("k")).where("k <> ''").distinct().withColumn("run", runs(F.col("k")))
    b = right.select(F.col(key).alias("key")).where("key <> ''").distinct().withColumn("run", runs(F.col("key")))
    la, lb = F.length("k"), F.length("key")
    fit = F.contains("k", F.col("key")) | F.contains("key", F.col("k")) | (2 * F.least(la, lb) >= fuzzy * (la + lb))
    return a.join(b, "run").where(fit).select("k", "key").distinct().withColumn("ratio", sequence_ratio(F.col("k"), F.col("key")))


def lookup_banks(names: DataFrame, banks: DataFrame, aliases: list = ALIASES, fuzzy: float = 0.82) -> DataFrame:
    """Names (bank) to (bank, rkey, bank_id, stage): exact, alias, containment, ratio, or null.

    Only what a stage leaves goes to the next; the last stages rate each key left with
    those registry keys that it shares a run of two characters with.
    """
    idx = bank_index(banks)
    n = names.select("bank").distinct().withColumns({"k": norm_key(F.col("bank")), "k2": norm_key(F.col("bank"), False)})
    e1 = n.join(idx.withColumnsRenamed({"key": "k"}), "k", "left").withColumnsRenamed({"rkey": "r1", "bank_id": "b1"})
    e2 = e1.join(idx.withColumnsRenamed({"key": "k2"}), "k2", "left").withColumnsRenamed({"rkey": "r2", "bank_id": "b2"})
    target = F.lit(None).cast("string")
    for a, t in aliases:
        target = F.when(F.col("k") == a, F.lit(t)).otherwise(target)
    blocked = F.col("k").isin(*[a for a, t in aliases if t is None])
    e3 = e2.withColumn("k3", target).join(idx.withColumnsRenamed({"key": "k3"}), "k3", "left").withColumnsRenamed({"rkey": "r3", "bank_id": "b3"})
    stage = F.when(F.coalesce("r1", "r2").isNotNull(), "exact").when(blocked, "blocked").when(F.col("r3").isNotNull(), "alias")
    done = e3.select("bank", "k", F.coalesce("r1", "r2", F.when(~blocked, F.col("r3"))).alias("rkey"), F.coalesce("b1", "b2", F.when(~blocked, F.col("b3"))).alias("bank_id"), stage.alias("stage"))
    left = done.where("stage is null and k <> ''").select("bank", "k")
    pairs = left.join(_pairs(left, "k", banks, "rkey", fuzzy).withColumnRenamed("key", "rkey"), "k").join(banks.select("rkey", "bank_id", "branch_count"), "rkey")
    pairs = pairs.withColumns({"inside": (F.length("k") >= 6) & (F.contains("k", F.col("rkey")) | F.contains("rkey", F.col("k")))})
    best = pairs.where(F.col("inside") | (F.col("ratio") >= fuzzy)).groupBy("bank").agg(F.max_by(F.struct("rkey", "bank_id", "inside"), F.struct("inside", "ratio", F.coalesce("branch_count", F.lit(0)), "rkey")).alias("m"))
    d = done.join(best, "bank", "left")
    return d.select("bank", F.coalesce("rkey", "m.rkey").alias("rkey"), F.coalesce("bank_id", "m.bank_id").alias("bank_id"), F.coalesce("stage", F.when(F.col("m.inside"), "containment").when(F.col("m").isNotNull(), "ratio")).alias("stage"))


def lookup_branches(records: DataFrame, branches: DataFrame, fuzzy: float = 0.87) -> DataFrame:
    """(rkey, name) to (rkey, name, bkey, fi_branch_id, routing, stage).

    Exact key; then candidates that share a token's first four letters: containment (the
    longest common part, then the ratio, then the key decides), then the best ratio.
    """
    n = records.select("rkey", "name").distinct().withColumn("k", branch_key(F.col("name"))).where("rkey is not null and k <> ''")
    b = branches.select("rkey", "bkey", "fi_branch_id", F.col("routing"))
    exact = n.join(b.withColumn("k", F.col("bkey")), ["rkey", "k"]).withColumn("stage", F.lit("exact"))
    left = n.join(exact.select("rkey", "name"), ["rkey", "name"], "left_anti")
    heads = lambda c: F.explode(F.array_distinct(F.transform(F.split(c, " "), lambda t: F.left(t, F.lit(4)))))
    pairs = left.withColumn("head", heads(F.col("k"))).join(b.withColumn("head", heads(F.col("bkey"))), ["rkey", "head"]).drop("head").distinct()
    inside = (F.length("k") >= 4) & (F.contains("k", F.col("bkey")) | F.contains("bkey", F.col("k")))
    pairs = pairs.withColumns({"ratio": sequence_ratio(F.col("k"), F.col("bkey")), "inside": inside, "common": F.when(inside, F.least(F.length("k"), F.length("bkey"))).otherwise(0)})
    fit = pairs.where(F.col("inside") | (F.col("ratio") >= fuzzy))
    best = fit.groupBy("rkey", "name").agg(F.max_by(F.struct("bkey", "fi_branch_id", "routing", "inside"), F.struct("inside", "common", "ratio", "bkey")).alias("m"))
    best = best.select("rkey", "name", "m.bkey", "m.fi_branch_id", "m.routing", F.when(F.col("m.inside"), "containment").otherwise("ratio").alias("stage"))
    return exact.select(*best.columns).unionByName(best)


def upsert(rows: DataFrame, keys: list[str], fields: list[str], order: str = "ord") -> DataFrame:
    """One row a key: of each field the first value by `order` that isn't empty."""
    first = lambda c: F.min_by(c, F.when(text_of(F.col(c)) != "", F.col(order))).alias(c)
    return rows.groupBy(*keys).agg(*[first(c) for c in fields])


def resolve_bank_words(lines: DataFrame, index: DataFrame, most: int = 6, fuzzy: float = 0.85) -> DataFrame:
    """Lines (line, words) to the bank that their first words name: (line, n, rkey, stage).

    Exact keys, the shortest prefix first; then containment and ratio, the longest first.
    """
    n = F.sequence(F.lit(1), F.least(F.size("words"), F.lit(most)))
    p = lines.select("line", F.explode(n).alias("n"), "words").withColumn("k", norm_key(F.array_join(F.slice("words", F.lit(1), F.col("n")), " "))).where("k <> ''").drop("words")
    exact = p.join(index.select(F.col("key").alias("k"), "rkey"), "k").select("line", "n", "rkey", F.lit("exact").alias("stage"), F.struct(F.lit(0).alias("s"), F.col("n").alias("o"), F.lit(0.0).alias("r"), F.col("rkey").alias("key")).alias("at"))
    pairs = p.join(_pairs(p, "k", index, "key", fuzzy), "k").join(index.select("key", "rkey"), "key")
    inside = (F.length("k") >= 6) & (F.contains("k", F.col("key")) | F.contains("key", F.col("k")))
    more = pairs.where(inside | (F.col("ratio") >= fuzzy)).select("line", "n", "rkey", F.when(inside, "containment").otherwise("ratio").alias("stage"), F.struct(F.when(inside, 1).otherwise(2).alias("s"), (-F.col("n")).alias("o"), (-F.col("ratio")).alias("r"), F.col("key")).alias("at"))
    return exact.unionByName(more).groupBy("line").agg(F.min_by(F.struct("n", "rkey", "stage"), "at").alias("m")).select("line", "m.*")


def merge_offices(with_id: DataFrame, without: DataFrame, least: float = 0.70, regions: list[str] = ["north", "south"]) -> DataFrame:
    """A registry bank's offices: rows without an id give their routing to the best row with one.

    Both: rkey, bkey, name, routing (and fi_branch_id). A row is compared by its key, by
    the key without the regions it begins with, and by its second half where the first
    is much the same; its score is the best ratio to an office of its bank, or 1 where
    one of these holds the office's key. Each office takes one routing, from the first by
    key; rows below `least` are offices of their own.
    """
    squash = lambda c: F.regexp_replace(c, "[^a-z0-9]", "")
    a = with_id.select("rkey", F.col("bkey").alias("a"))
    t = without.select("rkey", "bkey", "routing").withColumn("t", F.split("bkey", " "))
    half = F.floor(F.size("t") / 2).cast("int")
    t = t.withColumns({"h1": squash(F.array_join(F.slice("t", F.lit(1), half), "")), "h2": squash(F.array_join(F.slice("t", half + 1, F.size("t")), ""))})
    t = t.withColumn("alike", sequence_ratio(F.col("h1"), F.col("h2")))
    forms = F.array(squash(F.col("bkey")), squash(F.array_join(strip_regions(F.col("t"), regions), "")), F.when((F.size("t") > 1) & (F.col("alike") >= 0.70), F.col("h2")))
    p = t.select("rkey", "bkey", "routing", F.explode(F.array_distinct(F.array_compact(forms))).alias("form")).join(a, "rkey")
    score = F.when(F.contains("form", squash(F.col("a"))) & (squash(F.col("a")) != ""), 1.0).otherwise(sequence_ratio(F.col("form"), squash(F.col("a"))))
    best = p.withColumn("score", score).groupBy("rkey", "bkey", "routing").agg(F.max_by("a", F.struct("score", "a")).alias("a"), F.max("score").alias("score"))
    gives = best.where(F.col("score") >= least)
    first = gives.where("routing <> ''").groupBy("rkey", "a").agg(F.min_by("routing", F.lower("bkey")).alias("given"))
    office = with_id.join(first.withColumnRenamed("a", "bkey"), ["rkey", "bkey"], "left")
    office = office.select("rkey", "bkey", "name", "fi_branch_id", F.coalesce(F.nullif("routing", F.lit("")), "given").alias("routing"))
    alone = without.join(gives.select("rkey", "bkey"), ["rkey", "bkey"], "left_anti").select("rkey", "bkey", "name", F.lit(None).cast("string").alias("fi_branch_id"), "routing")
    return office.unionByName(alone).withColumn("office", office_title(F.col("name"))).withColumn("nth", F.row_number().over(Window.partitionBy("rkey").orderBy(F.lower("bkey"), "bkey")))


def enrich(records: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Records left-joined by exact name with a snapshot (name, new_address, new_url, phones)."""
    d = records.join(snapshot, "name", "left")
    return d.withColumns({"address": F.coalesce(F.nullif("new_address", F.lit("")), "address"), "url": F.coalesce("new_url", "url"), "phone": F.coalesce(F.nullif(F.array_join("phones", "; "), F.lit("")), "phone")}).drop("new_address", "new_url", "phones")


def coalesce_routing(site: Column, registry: Column) -> Column:
    """The site's own routing number before the registry's; empty is null."""
    return F.coalesce(F.nullif(site, F.lit("")), F.nullif(registry, F.lit("")))
