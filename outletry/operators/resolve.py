"""Entity resolution of outlet records, in passes.

Records: bank, ord, name, address, url, phone, routing, is_sub. Later records fill what
the first of a group lacks; `ord` decides what comes first.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outletry.functions import predicates as P
from outletry.functions import similarity as S
from outletry.functions.text import bengali_squash, branch_key, clean_address, clean_ws, drop_media, find_phones, labelled_phone, salvaged_name, squash, text_of
from outletry.operators.parts import connected
from outletry.sources.staging import if_few, stage

SCHEMA = "bank string, ord long, name string, address string, url string, phone string, routing string, is_sub boolean"


def cleaned(records: DataFrame) -> DataFrame:
    """Pass 0: tidy names and phones, salvage names, drop what names no outlet."""
    n = F.btrim(F.regexp_replace(text_of(F.col("name")), r"(?i)<br\s*/?>", " "))
    r = records.withColumns({"name": n, "phone": drop_media(F.col("phone"))}).withColumn("name", salvaged_name(F.col("name"), F.col("address")))
    return r.where(P.keeps_record(F.col("name"), F.col("address"), F.col("phone"), F.col("url")))


def exact_duplicates(records: DataFrame) -> DataFrame:
    """Pass 1: one record of equal squashed name and address start; address, phone, url are filled in, routing isn't.

    Bengali letters stay in the key, so that Bengali outlets keep apart.
    """
    k = F.concat(bengali_squash(F.col("name")), F.lit("|"), F.left(bengali_squash(F.col("address")), F.lit(40)))
    filled = lambda c: F.min_by(c, F.when(text_of(F.col(c)) != "", F.col("ord"))).alias(c)
    own = lambda c: F.min_by(c, "ord").alias(c)
    r = records.withColumn("k", k).where("k <> '|'")
    return r.groupBy("bank", "k").agg(F.min("ord").alias("ord"), own("name"), filled("address"), filled("url"), filled("phone"), own("routing"), own("is_sub")).drop("k")


def drop_translations(records: DataFrame, least: int = 10) -> DataFrame:
    """Pass 2: purely Bengali names go from a bank with `least` others."""
    n = records.groupBy("bank").agg(F.count_if(P.is_latin(F.col("name"))).alias("latin"))
    return records.join(n, "bank").where((F.col("latin") < least) | P.is_latin(F.col("name"))).drop("latin")


def clean_addresses(records: DataFrame) -> DataFrame:
    """Labelled phones move from the address to an empty phone; labels and e-mails go."""
    p = labelled_phone(F.col("address"))
    moved = F.when((F.btrim(text_of(F.col("phone"))) == "") & (F.length(F.regexp_replace(p, "[^0-9]", "")) >= 6), F.btrim(clean_ws(p), F.lit(" ,.-"))).otherwise(F.col("phone"))
    return records.withColumn("phone", moved).withColumn("address", clean_address(F.col("address")))


def same_name(records: DataFrame) -> DataFrame:
    """Pass 3: records of one squashed name merge with the latest kept one whose address agrees.

    An ordered fold over the few records of a name, in the JVM.
    """
    r = records.withColumn("k", squash(F.col("name")))
    fields = ["ord", "name", "address", "url", "phone", "routing", "is_sub"]
    g = r.where("k <> ''").groupBy("bank", "k").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("rs"))
    kind = next(f for f in g.schema.fields if f.name == "rs").dataType.simpleString()

    def step(kept: Column, x: Column) -> Column:
        e = F.element_at(kept, -1)
        longer = F.length(text_of(x["address"])) > F.length(text_of(e["address"]))
        either = lambda c: F.when(text_of(e[c]) == "", x[c]).otherwise(e[c])
        merged = F.struct(e["ord"].alias("ord"), F.when(P.is_branch(x["name"]) & ~P.is_branch(e["name"]), x["name"]).otherwise(e["name"]).alias("name"), F.when(longer, x["address"]).otherwise(e["address"]).alias("address"), e["url"].alias("url"), either("phone").alias("phone"), either("routing").alias("routing"), e["is_sub"].alias("is_sub"))
        agree = S.addresses_agree(e["address"], x["address"])
        return F.when((F.size(kept) > 0) & agree, F.concat(F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))), F.array(merged))).otherwise(F.concat(kept, F.array(x)))

    folded = F.aggregate("rs", F.array().cast(kind), step)
    alone = r.where("k = ''").select("bank", *fields)
    return g.select("bank", F.inline(folded)).unionByName(alone)


def name_gate(a: Column, b: Column) -> Column:
    """Whether squashed names are close, or one begins with at least half of the other."""
    prefix = (a.startswith(b) | b.startswith(a)) & (F.least(F.length(a), F.length(b)) >= 0.5 * F.greatest(F.length(a), F.length(b)))
    return (S.edit_ratio(a, b) >= 0.8) | prefix


def _segments(n: Column, length: Column) -> Column:
    """(i, begin, size) of the even segments of a text of some length: one more than its allowed edits."""
    m = F.floor(length / 4).cast("int") + 1
    cut_ = lambda i: F.floor(i * length / m).cast("int")
    return F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.struct(i.alias("i"), cut_(i).alias("begin"), (cut_(i + 1) - cut_(i)).alias("size")))


def _edit_blocks(n: Column) -> tuple[Column, Column]:
    """Keys of a text as the shorter of a pair within the gate's edits, and as the longer; any such pair shares one.

    The gate allows a fifth of the longer length in edits, which is a quarter of the shorter
    one at most. A text cut into one more segments than edits leaves one segment
    whole, and that stands in the longer text at a place that the edits before and
    behind it can reach.
    """
    size = F.length(n)
    own = F.transform(_segments(n, size), lambda s: F.concat_ws(":", size, s["i"], F.substring(n, s["begin"] + 1, s["size"])))

    def of(length: Column) -> Column:
        edits, more = F.floor(length / 4).cast("int"), size - length

        def at(s: Column) -> Column:
            lo = F.greatest(F.lit(0), s["begin"] - s["i"], s["begin"] + more - (edits - s["i"]))
            hi = F.least(size - s["size"], s["begin"] + s["i"], s["begin"] + more + (edits - s["i"]))
            places = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda p: F.concat_ws(":", length, s["i"], F.substring(n, p + 1, s["size"])))

        return F.flatten(F.transform(_segments(n, length), at))

    lengths = F.sequence(F.greatest(F.ceil(0.8 * size).cast("int"), size - 6, F.lit(1)), size)
    return own, F.array_distinct(F.flatten(F.transform(lengths, of)))


def candidate_edges(records: DataFrame) -> DataFrame:
    """(bank, sub, a, b): pairs a < b of different squashed names of a bank that may be one outlet's.

    Their kinds and digits agree, and their names pass the gate or have an outlet key in
    common. Pairs come from equi-joins on blocks that miss none: outlet keys, the beginnings
    of a name of half its length or more against whole names, and the segments of
    :func:`_edit_blocks`. Empty names have no edges.
    """
    r = records.select("bank", F.coalesce(F.col("is_sub").cast("string"), F.lit("")).alias("sub"), squash(F.col("name")).alias("n"), branch_key(F.col("name")).alias("bk"))
    r = stage(r.where("n <> ''").withColumn("digits", F.regexp_replace("n", "[^0-9]", "")).distinct(), "names")
    on = ["bank", "sub", "digits", "block"]
    names = r.select("bank", "sub", "digits", "n").distinct()
    short, long_ = _edit_blocks(F.col("n"))
    lengths = F.sequence(F.greatest(F.ceil(F.length("n") / 2).cast("int"), F.lit(1)), F.length("n"))
    begins = F.transform(lengths, lambda i: F.left("n", i))
    sides = lambda left, right: names.select("bank", "sub", "digits", F.col("n").alias("a"), F.explode(left).alias("block")).join(names.select("bank", "sub", "digits", F.col("n").alias("b"), F.explode(right).alias("block")).hint("merge"), on).select("bank", "sub", "a", "b")
    close = sides(F.array("n"), begins).unionByName(sides(short, long_)).where("a <> b").distinct()
    close = close.where(name_gate(F.col("a"), F.col("b")))
    # Names of one key hang on the smallest of them.
    keyed = r.groupBy("bank", "sub", "digits", "bk").agg(F.min("n").alias("a"), F.count_distinct("n").alias("m")).where("m > 1").drop("m")
    keyed = r.join(keyed.hint("merge"), ["bank", "sub", "digits", "bk"]).where("n <> a").select("bank", "sub", "a", F.col("n").alias("b"))
    return close.unionByName(keyed).select("bank", "sub", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _agree(a: str, b: str) -> bool:
    a, b = a.lower(), b.lower()
    if not a or not b or a in b or b in a:
        return True
    return _similar(a, b) >= 0.55 or _mostly(a, b)


def _words(s: str, least: int = 1) -> set[str]:
    import re

    return {t for t in re.findall("[a-z0-9]+", s) if len(t) >= least}


def _grams(s: str) -> set[str]:
    s = "".join(c for c in s if c.isascii() and c.isalnum())
    return {s[i : i + 3] for i in range(len(s) - 2)} or {s}


def _similar(a: str, b: str) -> float:
    share = lambda x, y: len(x & y) / max(1, len(x | y))
    return max(share(_grams(a), _grams(b)), share(_words(a), _words(b)))


def _edit(a: str, b: str) -> float:
    if abs(len(a) - len(b)) > 6:
        return 0.0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        corner, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
    return 1 - row[-1] / max(1, len(a), len(b))


def _mostly(a: str, b: str) -> bool:
    small, big = sorted((_words(a, 2), _words(b, 2)), key=len)
    hits = sum(t in big or any(len(t) >= 5 <= len(u) and _edit(t, u) >= 0.8 for u in big) for t in small)
    return not small or hits / len(small) >= 0.7


def _fold(rows: list[dict]) -> list[dict]:
    """Records in order, merged greedily to a fixed point."""
    digits = lambda x: [c for c in x["n"] if c.isdigit()]

    def one_outlet(a: dict, b: dict) -> bool:
        if not a["n"] or not b["n"] or a["is_sub"] != b["is_sub"] or digits(a) != digits(b):
            return False
        short, long_ = sorted((a["n"], b["n"]), key=len)
        bare = not a["url"] or not b["url"]
        base = a["bk"] == b["bk"] and bare and (a["name"].isupper() or b["name"].isupper() or not a["address"].strip() or not b["address"].strip() or _agree(a["address"], b["address"]))
        near = _edit(a["n"], b["n"]) >= 0.8 or (long_.startswith(short) and len(short) >= 0.5 * len(long_))
        return base or (near and _agree(a["address"], b["address"]))

    at = 0
    while at < len(rows):
        for k in range(at + 1, len(rows)):
            if one_outlet(rows[at], rows[k]):
                a, b = rows[at], rows[k]
                if (b["url"] and not a["url"]) or (bool(a["url"]) == bool(b["url"]) and len(b["address"]) > len(a["address"])):
                    a, b = b, a
                if b["named"] and not a["named"]:
                    a["name"], a["named"], a["n"], a["bk"] = b["name"], True, b["n"], b["bk"]
                for c in ("phone", "url", "routing"):
                    a[c] = a[c] or b[c]
                rows = [x for x in rows if x is not b]
                at = -1  # a merge may make earlier records agree
                break
        at += 1
    return rows


def _fold_group(pdf: pd.DataFrame) -> pd.DataFrame:
    rows = pdf.sort_values("ord").fillna({c: "" for c in ("name", "address", "url", "phone", "n", "bk")}).to_dict("records")
    return pd.DataFrame(_fold(rows), columns=list(pdf.columns))[["bank", "ord", "name", "address", "url", "phone", "routing", "is_sub"]]


def near_names(records: DataFrame) -> DataFrame:
    """Pass 4: a bank's outlets of nearly the same name merge, greedily, to a fixed point.

    A merge hands on a name with its keys, so what merges is always joined by edges between
    the names that records came with: each connected part of the complete edges is
    folded for itself, which gives what a fold of the whole bank gives. Records
    without an edge or a second record of their name don't leave the JVM. Records of equal
    order come in any order; null names are empty, and merge with none.
    """
    r = records.select("bank", "ord", "name", "address", "url", "phone", "routing", "is_sub", squash(F.col("name")).alias("n"), branch_key(F.col("name")).alias("bk"), P.is_branch(F.col("name")).alias("named"))
    r = stage(r, "near-names")
    node = lambda n: F.concat_ws("|", F.coalesce("bank", F.lit("")), "sub", n)
    edges = candidate_edges(r).select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b"))
    parts = connected(edges)
    sub = F.coalesce(F.col("is_sub").cast("string"), F.lit(""))
    r = r.withColumn("sub", sub).withColumn("node", node(F.col("n"))).drop("sub").join(if_few(parts), "node", "left").withColumn("part", F.coalesce("part", "node"))
    r = stage(r.drop("node"), "near-parts")
    more = stage(r.where("n <> ''").groupBy("part").count().where("count > 1").select("part"), "near-more")
    fields = SCHEMA.replace(" string", "").replace(" long", "").replace(" boolean", "").split(", ")
    here = (F.col("n") != "") & F.col("part").isNotNull()
    folded = r.where(here).join(if_few(more), "part", "left_semi").groupBy("part").applyInPandas(_fold_group, SCHEMA)
    alone = r.where(here).join(if_few(more), "part", "left_anti").unionByName(r.where(~here))
    return alone.select(*fields).unionByName(folded)


def resolve(records: DataFrame) -> DataFrame:
    """All passes; what the first two leave, which is read twice, is staged."""
    first = stage(exact_duplicates(cleaned(records)), "no-duplicates")
    return near_names(same_name(clean_addresses(drop_translations(first))))
