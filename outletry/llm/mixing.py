"""Mixing sources to target weights (operator 8), in DataFrame functions only.

Every source is cut into permuted blocks by the hash of its documents. A source
that is to give T of its S words gives all blocks T // S times, and of one more
pass the first blocks that fit; the block where the pass ends is refined, and a
bounded zone of documents behind that point fills what is left, largest first.
The drawn blocks are then dealt to output shards by a splitting tree: at every
node the left half's quota of each source is a multivariate hypergeometric draw
from the node's quotas, so that every shard gets an exact number of blocks and
every source keeps its total. Each shard takes its own stretch of every source's
permuted blocks and orders its documents by a hash of their own.

Sources beyond `strata` share strata evenly, each of which has its quotas in the tree;
the permuted order of a stratum's blocks then draws every source's own, exact in sum.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import if_small, numbered, rows_of, stage, word_count


@dataclass(frozen=True)
class Mix:
    """weights: dealt to the sources in turn, sorted by code point, null last.

    most: no document is taken more often, no target is above so many times its
    source. block_bits: a level of blocks has 2**block_bits of them. zone: so many
    documents at least are tried to fill the end of a pass, most_zone: and blocks are
    refined until a source has at most so many in its last one. shards, seed: of the
    tree's output; each is cut by a hash into files of about `file_words` words, so files
    don't grow with the corpus. strata: so many rows the tree's plan on the driver has
    for a shard. urn: the most blocks that one draw is made from.
    """

    weights: tuple[float, ...] = (5, 2, 1)
    most: int = 3
    block_bits: int = 10
    zone: int = 64
    most_zone: int = 20_000
    shards: int = 64
    file_words: int = 4_000_000
    seed: int = 11
    strata: int = 4096
    urn: int = 500_000_000


def _key(source: Column) -> Column:
    """A join key that keeps null apart from every name."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def targets(sizes: DataFrame, at: Mix) -> DataFrame:
    """(key, source_size) to (key, source_size, target, whole, rest).

    Targets share the total by weight, but stop at `most` times the source. That is
    the level L where the sum of min(most * size, L * weight) meets the total: L starts from
    all sources, and as long as one is above its cap, those are capped and L shares out
    what they leave. Only sums go to the driver, and L only rises, so the rounds
    are few.
    """
    ranks = numbered(sizes.withColumn("none", F.col("key") == ""), ["none", "key"], "mix-ranks")
    w = F.get(F.array(*[F.lit(float(x)) for x in at.weights]), (F.col("no") % len(at.weights)).cast("int"))
    s = stage(ranks.select("key", "source_size", w.alias("weight"), (at.most * F.col("source_size")).alias("cap")), "mix-weights")
    total, level, free = s.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0], -1.0, None
    while True:
        above = F.col("cap") / F.col("weight") <= F.lit(level)
        capped, weight, n = s.agg(F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0)), F.sum(F.when(~above, F.col("weight"))), F.count(F.when(~above, True))).first()
        if n == free or not n:  # nothing more is capped
            break
        free, level = n, (total - capped) / weight
    cap = F.col("cap").cast("double")
    s = s.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")) if n else cap)
    words = F.least(F.round("target"), F.col("cap")).cast("long")
    size = F.greatest(F.col("source_size"), F.lit(1))
    return s.select("key", "source_size", "target", F.floor(words / size).cast("int").alias("whole"), (words % size).alias("rest"))


def _narrow(rows: DataFrame, place: str, want: DataFrame, at: Mix) -> DataFrame:
    """Where each source's pass ends: (key, first, last, left).

    rows: key, size and a place in the permuted order; want: key, left. The pass
    takes all places before `first`, which leaves `left` words to be found among the
    places from `first` to `last`, of `zone` documents or more.
    """
    by = Window.partitionBy("key").orderBy(place)
    b = rows.groupBy("key", place).agg(F.sum("size").alias("w"), F.count("*").alias("n"))  # 2**block_bits rows a source at most
    b = b.withColumns({"w_end": F.sum("w").over(by), "n_end": F.sum("n").over(by)}).join(want, "key")
    fits = F.col("w_end") <= F.col("left")
    every = Window.partitionBy("key")
    b = b.withColumns({"n_drawn": F.coalesce(F.max(F.when(fits, F.col("n_end"))).over(every), F.lit(0)), "w_drawn": F.coalesce(F.max(F.when(fits, F.col("w_end"))).over(every), F.lit(0))})
    b = b.where(~fits & (F.col("n_end") - F.col("n") - F.col("n_drawn") < at.zone))
    return b.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.min(F.col("left") - F.col("w_drawn")).alias("left"), F.sum("n").alias("n"))


def _fill(zone: DataFrame) -> DataFrame:
    """(key, uid): the documents of each zone that fit what is left, largest first."""
    found = F.sort_array(F.collect_list(F.struct(F.col("size"), F.col("h"), F.col("doc_id"), F.col("uid"))), asc=False)
    z = zone.groupBy("key", "left").agg(found.alias("found"))
    start = F.struct(F.col("left").alias("left"), F.array().cast("array<bigint>").alias("uids"))
    step = lambda a, x: F.when(x["size"] <= a["left"], F.struct((a["left"] - x["size"]).alias("left"), F.concat(a["uids"], F.array(x["uid"])).alias("uids"))).otherwise(a)
    return z.select(F.explode(F.aggregate("found", start, step)["uids"]).alias("uid"))


def mix(docs: DataFrame, at: Mix = Mix(), carry: bool = False) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, copies, taken, and ``row`` if `carry`.

    size is the number of words; null text has none, and such a document, like any
    of size 0, comes with its block and adds no words. Null is a source like others.
    Repeated rows are documents of their own, dispensed one by one; which of equal rows
    fills a gap makes no difference. An empty table gives an empty result. Extra
    columns are ignored (or carried).
    """
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    row = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if carry else []
    d = docs.select(*row, F.col("doc_id").cast("long").alias("doc_id"), _key(source).alias("key"), word_count(text).alias("size"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"))
    d = stage(d.withColumns({"uid": F.monotonically_increasing_id(), "h": F.xxhash64(F.lit(at.seed), F.coalesce("doc_id", F.lit(-1)), "size", F.col("key"), "mark")}), "mix")
    d = _apart(d, at)
    place = lambda bits: F.shiftrightunsigned("h", 64 - bits)
    plan = stage(targets(d.groupBy("key").agg(F.sum("size").alias("source_size")), at), "mix-plan")
    thin = d.select("key", "size", "h", "doc_id", "uid")
    # Blocks, then ever finer blocks of those where a pass ends, down to a few documents.
    bits, ends = at.block_bits, thin.withColumn("b", place(at.block_bits))
    end = stage(_narrow(ends, "b", plan.select("key", F.col("rest").alias("left")), at), "mix-ends")
    while True:
        ends = thin.withColumn("b", place(bits)).join(if_small(end), "key").where(F.col("b").between(F.col("first"), F.col("last")))
        crowd = end.where(F.col("n") > at.zone).select(F.max("n")).first()[0] or 0
        if bits >= 2 * at.block_bits and crowd <= at.most_zone or bits + at.block_bits > 62:
            break
        bits += at.block_bits
        fine = _narrow(ends.select("key", "size", place(bits).alias("b")), "b", end.select("key", "left"), at)
        end = stage(fine, "mix-ends")
    picks = stage(_fill(ends), "mix-picks")
    info = plan.join(end.select("key", F.col("first").alias("until")), "key", "left")
    d = d.join(if_small(stage(info, "mix-info")), "key").join(if_small(picks.withColumn("picked", F.lit(True))), "uid", "left")
    # No end in a source: all of it is within the rest, or there is no rest at all.
    drawn = F.when(F.col("until").isNull(), F.col("rest") > 0).otherwise((place(bits) < F.col("until")) | F.coalesce("picked", F.lit(False)))
    d = d.withColumns({"drawn": drawn.cast("int"), "b1": place(at.block_bits)})
    copies = F.least(F.col("whole") + F.col("drawn"), F.lit(at.most))
    return d.select(*["row"] * carry, "doc_id", "uid", "key", "h", "b1", "size", "source_size", "target", "whole", "drawn", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def _apart(d: DataFrame, at: Mix) -> DataFrame:
    """The staged rows, of which those that are equal get hashes of their own by their place among them."""
    same = d.groupBy("h").count().where("count > 1").select("h")
    same = stage(same, "mix-same")
    if same.isEmpty():
        return d
    equal = numbered(d.select("h", "uid").join(if_small(same), "h"), ["h", "uid"], "mix-equal")
    first = equal.groupBy("h").agg(F.min("no").alias("first"))
    own = equal.join(if_small(stage(first, "mix-first")), "h").where(F.col("no") > F.col("first"))
    own = stage(own.select("uid", F.xxhash64(F.lit(at.seed), "h", F.col("no") - F.col("first")).alias("new")), "mix-own")
    return d.join(if_small(own), "uid", "left").withColumn("h", F.coalesce("new", "h")).drop("new")


def split_tree(quotas: list[int], shards: int, seed: int, urn: int = 500_000_000) -> np.ndarray:
    """Exact quotas of `shards` shards: an array [shard, stratum] whose columns sum to `quotas`.

    Shards differ by one block at most in all they get.
    """
    total, rng = sum(quotas), np.random.default_rng(seed)
    ends = [total * k // shards for k in range(shards + 1)]
    out = np.zeros((shards, len(quotas)), np.int64)

    def draw(have: np.ndarray, n: int) -> np.ndarray:
        urns = -(-int(have.sum()) // urn)
        if urns <= 1:
            return rng.multivariate_hypergeometric(have, n, method="marginals")
        # Too many for one draw: equal urns, each giving its share.
        parts = [have // urns + ((np.arange(len(have)) + k) % urns < have % urns) for k in range(urns)]
        before = np.cumsum([0] + [int(p.sum()) for p in parts])
        cuts = [n * int(b) // int(before[-1]) for b in before]
        return sum((rng.multivariate_hypergeometric(p, cuts[k + 1] - cuts[k], method="marginals") for k, p in enumerate(parts)), np.zeros_like(have))

    def split(lo: int, hi: int, have: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = have
            return
        mid = (lo + hi) // 2
        left = draw(have, ends[mid] - ends[lo])
        split(lo, mid, left)
        split(mid, hi, have - left)

    if len(quotas):
        split(0, shards, np.asarray(quotas, np.int64))
    return out


def place(mixed: DataFrame, at: Mix = Mix()) -> DataFrame:
    """One row for every copy that the mix takes, with its shard and its key in there.

    mixed: what :func:`mix` returned, of which null ids, empty texts and repeated rows are
    placed like others, each copy for itself; ties of an order are broken by all of
    its columns. No rows give none. Units are (source, pass, block).
    """
    spark = mixed.sparkSession
    copies = mixed.where(F.col("copies") > 0).withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    units = copies.groupBy("key", "pass", "b1").count()
    keys = numbered(units.select("key").distinct(), ["key"], "mix-keys").select("key", (F.col("no") % at.strata).cast("int").alias("stratum"))
    sizes = if_small(stage(keys, "mix-strata"))
    units = stage(units.join(sizes.select("key", "stratum"), "key").drop("count"), "mix-units")
    quotas = {r["stratum"]: r["n"] for r in units.groupBy("stratum").agg(F.count("*").alias("n")).collect()}  # `strata` rows at most
    order = sorted(quotas)
    got = split_tree([quotas[s] for s in order], at.shards, at.seed, at.urn)
    ends = got.cumsum(0)
    plan = [{"stratum": s, "shard": k, "lo": int(ends[k, j] - got[k, j]), "hi": int(ends[k, j])} for j, s in enumerate(order) for k in range(at.shards) if got[k, j]]
    by = Window.partitionBy("stratum").orderBy("pass", F.xxhash64(F.lit(at.seed), "key", "pass", "b1"), "key", "b1")
    units = units.withColumn("no", F.row_number().over(by) - 1)
    ranges = rows_of(spark, plan, "stratum int, shard int, lo long, hi long")
    units = stage(units.join(ranges, "stratum").where((F.col("no") >= F.col("lo")) & (F.col("no") < F.col("hi"))).select("key", "pass", "b1", "shard"), "mix-dealt")
    return copies.join(units, ["key", "pass", "b1"]).withColumn("order", F.xxhash64(F.lit(at.seed + 1), "shard", "pass", "uid"))


def mixed_documents(docs: DataFrame, at: Mix = Mix()) -> DataFrame:
    """The rows that the mix takes, each as often as it takes it, with the columns of ``docs``.

    Partitions hold a shard, or a file of a large one, in the order of their keys.
    """
    mixed = mix(docs, at, carry=True)
    words = mixed.agg(F.coalesce(F.sum("taken"), F.lit(0))).first()[0]
    files = max(1, -(-words // (at.shards * at.file_words)))
    placed = place(mixed, at).select("row", "shard", "order", F.pmod("order", F.lit(files)).alias("file"))
    return placed.repartition(at.shards * files, "shard", "file").sortWithinPartitions("shard", "file", "order").select("row.*")
