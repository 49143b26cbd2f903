"""Parts as a table: upserts that keep successes, merges, repair and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from outletry.functions import predicates as P
from outletry.functions import vocab
from outletry.functions.text import branch_key, drop_media, slugify, text_of
from outletry.operators.registry import coalesce_routing, lookup_branches


def no_clobber(old: DataFrame, new: DataFrame, key: str, status: str = "status", good: str = "success") -> DataFrame:
    """All keys: the new row, unless it isn't good and the old one is."""
    cols = old.columns
    o = old.select(F.col(key), F.struct(*cols).alias("o"))
    n = new.select(F.col(key), F.struct(*[F.col(c) for c in cols]).alias("n"))
    d = o.join(n, key, "full_outer")
    takes = F.col("n").isNotNull() & (F.col("o").isNull() | (F.col(f"n.{status}") == good) | ~F.coalesce(F.col(f"o.{status}") == good, F.lit(False)))
    return d.select(F.when(takes, F.col("n")).otherwise(F.col("o")).alias("r")).select("r.*")


def write_parts(parts: DataFrame, path: str) -> None:
    """One folder of JSON for each bank's slug; only the banks written are replaced."""
    p = parts.withColumn("slug", slugify(F.col("_bank")))
    p.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("slug").json(path)


def resumable(banks: DataFrame, parts: DataFrame) -> DataFrame:
    """Banks without a part that succeeded."""
    return banks.join(parts.where("status = 'success'").select(F.col("_bank").alias("bank")), "bank", "left_anti")


def current(parts: DataFrame, banks: DataFrame) -> DataFrame:
    """Parts of the banks listed now, by slug."""
    s = banks.select(slugify(F.col("bank")).alias("slug")).distinct()
    return parts.withColumn("slug", slugify(F.col("_bank"))).join(s, "slug", "left_semi").drop("slug")


def merged_document(parts: DataFrame, most: int = 20_000) -> DataFrame:
    """One row: the JSON object of bank to its part, as an export of at most so many parts; more are an error, for which :func:`write_parts` is the way."""
    if (n := parts.count()) > most:
        raise ValueError(f"{n} parts are too many for one document")
    rest = [c for c in parts.columns if c != "_bank"]
    key = F.regexp_extract(F.to_json(F.struct(F.col("_bank").alias("b"))), r'^\{"b":(.*)\}$', 1)
    p = parts.select("_bank", F.concat(key, F.lit(":"), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"})).alias("part"))
    all_ = p.agg(F.array_sort(F.collect_list(F.struct("_bank", "part"))).alias("all"))
    return all_.select(F.concat(F.lit("{"), F.array_join(F.transform("all", lambda x: x["part"]), ","), F.lit("}")).alias("value"))


def changed(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of `new` that differ from the old of their key, null-safe; maps are compared by their JSON."""
    cols = [c for c in new.columns if c != key]
    flat = lambda d: [F.to_json(c).alias(c) if "map<" in t else F.col(c) for c, t in d.select(*cols).dtypes]
    o = old.select(F.col(key), F.struct(*flat(old)).alias("__old"))
    return new.join(o, key, "left").where(~F.struct(*flat(new)).eqNullSafe(F.col("__old"))).drop("__old")


def constituents(wanted: DataFrame, parts: DataFrame, records: DataFrame, repeats: bool = False) -> DataFrame:
    """Banks made of others: (bank, constituents) to their records, once each.

    A bank comes only if all its constituents have a part that succeeded and has
    records. Duplicates: same kind, outlet key and first 60 of the address, words only;
    with `repeats` they stay, as those of nth > 1.
    """
    w = wanted.select("bank", F.posexplode("constituents").alias("rank", "member"))
    ok = parts.where("status = 'success'").join(records.select(F.col("bank").alias("_bank")).distinct(), "_bank", "left_semi").select(F.col("_bank").alias("member"), F.lit(True).alias("ok"))
    gate = w.join(ok, "member", "left").groupBy("bank").agg(F.bool_and(F.coalesce("ok", F.lit(False))).alias("all")).where("all").drop("all")
    r = w.join(gate, "bank").join(records.withColumnRenamed("bank", "member"), "member")
    words = F.btrim(F.regexp_replace(F.lower(F.left(text_of(F.col("address")), F.lit(60))), r"(?U)\W+", " "))
    by = Window.partitionBy("bank", "is_sub", branch_key(F.col("name")), words).orderBy("rank", "ord")
    r = r.withColumn("nth", F.row_number().over(by))
    return r if repeats else r.where("nth = 1").drop("nth", "rank")


def upgrade(records: DataFrame, banks: DataFrame, branches: DataFrame) -> DataFrame:
    """Stored records (see sources.tables) repaired: junk goes, ids are looked up, kinds are set anew.

    banks: bank, rkey. Ids that are stored stay where the registry has none.
    """
    r = records.where(~P.is_junk_part_name(F.col("name")) & ~P.is_bare(F.col("name"), F.col("address"), drop_media(F.col("phone")), F.col("page_url")))
    media = F.lower(text_of(F.col("page_url"))).rlike(rf"\.({vocab.any_of(vocab.MEDIA_EXTENSIONS)})($|\?)")
    r = r.withColumns({"page_url": F.when(~media, F.col("page_url")), "phone": F.nullif(drop_media(F.col("phone")), F.lit(""))})
    r = r.join(banks, "bank", "left")
    found = lookup_branches(r, branches).select("rkey", "name", F.col("fi_branch_id").alias("new_id"), F.col("routing").alias("new_routing"))
    r = r.join(found, ["rkey", "name"], "left")
    sub = P.is_sub(F.col("name")) | F.col("is_sub") & ~P.is_sub_loose(F.col("name"))
    return r.select("bank", sub.alias("is_sub"), "ord", "name", "address", "page_url", "phone", F.coalesce("new_id", "fi_branch_id").alias("fi_branch_id"), coalesce_routing(F.col("routing_no"), F.col("new_routing")).alias("routing_no"))


def totals(records: DataFrame) -> DataFrame:
    """Branches and sub-branches of each bank."""
    return records.groupBy("bank").agg(F.count_if(~F.col("is_sub")).alias("total_branch"), F.count_if("is_sub").alias("total_sub_branch"))


def audit(parts: DataFrame, records: DataFrame, expected: DataFrame, most_empty: float = 0.2) -> DataFrame:
    """One row a part: counts, junk names (three at most), missing addresses, and what was expected.

    expected: ord, key, branches, subs; a part's is the first whose key its name holds.
    """
    junk = F.lower(text_of(F.col("name"))).rlike(vocab.any_of(vocab.AUDIT_JUNK))
    r = records.groupBy("bank").agg(F.count_if(~F.col("is_sub")).alias("branches"), F.count_if("is_sub").alias("subs"), F.count_if(junk).alias("n_junk"), F.slice(F.array_sort(F.collect_set(F.when(junk, F.col("name")))), 1, 3).alias("junk"), (F.count_if(text_of(F.col("address")) == "") / F.count("*")).alias("empty"))
    p = parts.select(F.col("_bank").alias("bank"), "status").join(r, "bank", "left").withColumn("slug", slugify(F.col("bank")))
    x = expected.select(F.col("ord").alias("e_ord"), "key", F.col("branches").alias("e_branches"), F.col("subs").alias("e_subs"))
    m = p.select("bank", "slug").join(x, F.contains("slug", F.col("key"))).groupBy("bank").agg(F.min_by(F.struct("e_branches", "e_subs"), "e_ord").alias("e"))
    d = p.join(m, "bank", "left")
    return d.select("bank", "status", F.coalesce("branches", F.lit(0)).alias("branches"), F.coalesce("subs", F.lit(0)).alias("subs"), F.coalesce("n_junk", F.lit(0)).alias("n_junk"), "junk", (F.coalesce("empty", F.lit(0.0)) > most_empty).alias("flag_empty"), (F.col("status") != "success").alias("flag_status"), (F.col("branches") - F.col("e.e_branches")).alias("d_branches"), (F.col("subs") - F.col("e.e_subs")).alias("d_subs"))


def audit_total(audited: DataFrame) -> DataFrame:
    """One row over all parts of an audit."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("branches", "subs", "n_junk")]
    return audited.agg(F.count("*").alias("banks"), *sums, F.count_if("flag_status").alias("failed"), F.count_if("flag_empty").alias("without_addresses"))


def backup(spark: SparkSession, path: str) -> None:
    """Copy a file or folder to its name with .bak, replacing an older copy."""
    fs, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    here, there = fs.Path(path), fs.Path(path.rstrip("/") + ".bak")
    disk = here.getFileSystem(conf)
    if disk.exists(here):
        disk.delete(there, True)
        fs.FileUtil.copy(disk, here, disk, there, False, conf)
