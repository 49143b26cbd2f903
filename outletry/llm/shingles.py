"""N-gram Jaccard join by chosen paths (operator 10).

A document is the set of its five-word shingles, of which a random sample (the
smallest by a hash) goes with it. In each of several independent runs, a hash of the
path so far chooses about `draw` of a set's sampled shingles; two sets that choose the
same one go down the same path. A large bucket is split again by its own choice, so that
sets which only share a common passage part while similar ones stay together.
Splitting multiplies a bucket's pairs by draw times the share of shingles that its sets
have in common in the mean; it goes on while it saves more pairs than handing the
sets on costs. In the buckets that are left, whatever their size, all sets are
compared by fixed-size sketches, with a margin of five standard deviations, which links
what may be similar. Of each group so linked the whole sets are then fetched once and
every pair is verified exactly, in blocks.

A pair at similarity s chooses draw * s common shingles in the mean, so its paths are a
branching process, which lives on at any depth with the chance x of x = 1 - exp(-draw * s * x).
The runs follow from that chance and the recall wanted.

Equal sets are one class throughout, so copies are never expanded into pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import labels, large_groups, near_pairs, one_of_each, shared_groups, split_groups, spread, whole_groups
from .common import if_small, small_batches, stage
from .components import components


@dataclass(frozen=True)
class Join:
    """words: of a shingle. least: Jaccard similarity of a link. recall: the chance that a
    pair at `least` meets in a bucket, however deep; it sets the runs. draw: expected
    shingles that a set chooses of a path. sample: shingles that go with a set. leaf: a
    bucket is split if that saves each set so many comparisons. look: sets by which a bucket's
    density is told. deepest: levels after which buckets are compared as they are. margin: the sketch's estimate from which a
    pair may be similar. chunk, chunk_shingles: rows and shingles of a large group in a task."""

    words: int = 5
    least: float = 0.8
    recall: float = 0.9999
    draw: float = 2.0
    sample: int = 64
    leaf: int = 512
    look: int = 64
    deepest: int = 40
    margin: float = 0.5
    chunk: int = 1500
    chunk_shingles: int = 2_000_000
    seed: int = 20

    @property
    def survival(self) -> float:
        """The chance that a pair at `least` stays together in a run, at any depth."""
        x = 1.0
        for _ in range(200):
            x = 1 - math.exp(-self.draw * self.least * x)
        return x

    @property
    def runs(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.survival))


BINS = 64  # of a sketch
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; words are what blanks separate.

    A text of fewer words is one shingle of them all; one without words has none.
    """
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    n = np.array([len(s) for s in split], np.int64)
    flat = np.empty(int(n.sum()), object)
    flat[:] = [w for s in split for w in s]
    h = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    rolled = np.zeros(len(h), np.uint64)
    for k in range(words):
        rolled[: len(h) - k] += _mix(h[k:] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    rolled = _mix(rolled)
    out, at = [], 0
    for c in n.tolist():
        if c >= words:
            out.append(np.unique(rolled[at : at + c - words + 1]))
        elif c:
            short = hashlib.blake2b(h[at : at + c].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(short, np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def sketch(s: np.ndarray) -> np.ndarray:
    """The least value in each of BINS bins by one permutation; 65535: empty."""
    low = np.full(BINS, 1 << 32, np.uint64)
    np.minimum.at(low, (s >> np.uint64(58)).astype(np.int64), s & np.uint64(0xFFFFFFFF))
    return np.where(low < (1 << 32), (low % np.uint64(65535)), 65535).astype(np.uint16)


def sampled(s: np.ndarray, at: Join) -> np.ndarray:
    """The set's `sample` shingles that are smallest by a hash."""
    if len(s) <= at.sample:
        return s
    h = _mix(s ^ np.uint64(0x9E3779B97F4A7C15 * (2 * at.seed + 1) & 0xFFFFFFFFFFFFFFFF))
    return s[np.argpartition(h, at.sample)[: at.sample]]


def _mark(text) -> "F.Column":
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def describe(docs: DataFrame, at: Join) -> DataFrame:
    """Staged: uid, doc_id, mark of the text, digest of the set, its size, sketch and sample."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch["text"].to_pylist(), at.words)
            yield pa.RecordBatch.from_pydict({
                "uid": batch["uid"], "doc_id": batch["doc_id"], "mark": batch["mark"], "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                "size": pa.array([len(s) for s in sets], pa.int64()), "sketch": pa.array([sketch(s).tobytes() for s in sets], pa.binary()),
                "sample": pa.array([sampled(s, at).view(np.int64) for s in sets], pa.list_(pa.int64())),
            })

    d = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), _mark(F.col("text")).alias("mark"))
    return stage(d.mapInArrow(run, "uid long, doc_id long, mark long, digest binary, size long, sketch binary, sample array<long>"), "shingles")


def chosen(node, at: Join) -> "F.Column":
    """The sampled shingles that a path chooses, `draw` in the mean."""
    share = F.lit(at.draw) / F.size("sample")
    limit = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise((share * 2.0**64 - 2.0**63).cast("long"))
    return F.filter("sample", lambda t: F.xxhash64(node, t) <= limit)


def splits(large: DataFrame, paths: DataFrame, pool: DataFrame, at: Join) -> DataFrame:
    """(node): those of the large buckets (node, n) that are worth splitting.

    The share of sampled shingles that two sets have in common is told by about `look` sets of
    each. It decides how the work is done, not its result.
    """
    some = paths.join(large, "node").where(F.pmod(F.xxhash64("node", "uid"), F.col("n")) < at.look)
    some = some.select("node", "n", "uid").join(pool, "uid")
    # The shingles of a bucket's sets side by side, some thousand: a bucket is one row, whatever its size.
    told = some.groupBy("node", "n").agg(F.count("*").alias("m"), F.sort_array(F.flatten(F.collect_list("sample"))).alias("all"))
    # Equal shingles stand together; one with k before it meets k others, in two orders.
    none = F.struct(F.lit(None).cast("long").alias("t"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("met"))

    def count(s, t):
        k = F.when(s["t"] == t, s["k"] + 1).otherwise(F.lit(0).cast("long"))
        return F.struct(t.alias("t"), k.alias("k"), (s["met"] + 2 * k).alias("met"))

    told = told.select("node", "n", "m", F.size("all").alias("all"), F.aggregate("all", none, count)["met"].alias("met"))
    left = F.col("met") * at.draw / (F.greatest(F.col("m") - 1, F.lit(1)) * F.col("all"))  # of the pairs, after a split
    return told.where(F.col("n") * (1 - left) > at.leaf).select("node")


def leaves(classes: DataFrame, at: Join) -> DataFrame:
    """(node, uid), staged: the buckets at the ends of the paths, of two sets or more; one of those that hold the same sets.

    Sets that are too small to be similar to any but equal ones are left out.
    """
    classes = classes.where(F.col("size") >= math.floor(at.least / (1 - at.least) + 1e-9))
    pool = classes.select("uid", "sample")
    runs = pool.select("uid", "sample", F.explode(F.sequence(F.lit(0), F.lit(at.runs - 1))).alias("run"))
    first = F.xxhash64(F.lit(at.seed), "run")
    paths = runs.withColumn("node", first).select("uid", "node", F.explode(chosen(F.col("node"), at)).alias("token"))
    few = lambda df, n: F.broadcast(df) if n <= 400_000 else df  # noqa: E731  narrow rows, counted
    ends = []
    for level in range(at.deepest):
        paths = stage(paths.select(F.xxhash64("node", "token").alias("node"), "uid"), "paths")
        nodes = stage(shared_groups(paths, "node", "uid"), "path-sizes")
        n_nodes, n_large = nodes.agg(F.count("*"), F.count_if(F.col("n") > at.leaf)).first()
        split, n_split = None, 0
        if n_large and level + 1 < at.deepest:
            split = stage(splits(few(nodes.where(F.col("n") > at.leaf).select("node", "n"), n_large), paths, pool, at), "path-split")
            n_split = split.count()
        done = one_of_each(nodes.join(few(split, n_split), "node", "left_anti") if n_split else nodes, "node")
        ends.append(paths.join(few(done, n_nodes), "node", "left_semi"))
        if not n_split:
            break
        deeper = paths.join(few(split, n_split), "node", "left_semi")
        if level % 3 == 0:  # the sets that are still on their way
            deeper = stage(deeper, "path-deeper")
            pool = stage(pool.join(if_small(stage(deeper.select("uid").distinct(), "path-uids")), "uid", "left_semi"), "path-pool")
        paths = deeper.join(pool, "uid").select("uid", "node", F.explode(chosen(F.col("node"), at)).alias("token"))
    out = ends[0]
    for e in ends[1:]:
        out = out.unionByName(e)
    return stage(out, "path-ends")


def _maybe(a: np.ndarray, b: np.ndarray, margin: float) -> np.ndarray:
    """Whether sketches (rows of a and b) may be of similar sets; bins that are empty in both don't count."""
    same = np.count_nonzero(a == b, axis=-1)
    none_a, none_b = a == 65535, b == 65535
    if not none_a.any() or not none_b.any():
        return same >= margin * BINS
    empty = np.count_nonzero(none_a & none_b, axis=-1)
    return same - empty >= margin * (BINS - empty)


def candidates(buckets: DataFrame, at: Join) -> DataFrame:
    """(a, b) links between sets of a bucket that may be similar: stars, not all pairs."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "block"):
            n, group, uid = t.num_rows, t["block"].to_numpy(), t["uid"].to_numpy()
            sk = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint16).reshape(n, BINS)
            size = t["size"].to_numpy()
            lab = np.arange(n)
            for i, j in near_pairs(group):
                close = np.minimum(size[i], size[j]) >= at.least * np.maximum(size[i], size[j])
                i, j = i[close], j[close]
                ok = _maybe(sk[i], sk[j], at.margin)
                lab = labels(n, i[ok], j[ok], lab)
            for a, b in large_groups(group):
                lab = spread(n, lab, a, b, lambda i, j: _maybe(sk[i][:, None], sk[None, j], at.margin))
            x = np.flatnonzero(lab != np.arange(n))
            yield pa.RecordBatch.from_pydict({"a": pa.array(uid[x]), "b": pa.array(uid[lab[x]])})

    b = split_groups(buckets, "node", "uid", 4 * at.chunk)
    return b.select("block", "uid", "size", "sketch").repartition("block").sortWithinPartitions("block").mapInArrow(link, "a long, b long").distinct()


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a few thousand sets, by products of 0/1 columns."""
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    tokens, of = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    column, of = number[column[keep]], of[keep]
    order = np.argsort(column, kind="stable")
    column, of = column[order], of[order]
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [lo, lo + width])
        x = np.zeros((n, width), np.float32)
        x[of[a:b], column[a:b] - lo] = 1
        out += x @ x.T
    return out


def verified(groups: DataFrame, at: Join) -> DataFrame:
    """Exact links inside groups: (uid, links, to), a row for each set of a block.

    links: other documents at `least` or more among those the block compares, copies
    counted; to: a set it hangs on, so that the rows span the links' components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "block", 2000):
            n, group, uid, side, mult = t.num_rows, t["block"].to_numpy(), t["uid"].to_numpy(), t["side"].to_numpy(), t["copies"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in t["tokens"].to_pylist()]
            size = np.array([len(s) for s in sets], np.int64)
            links, lab = np.zeros(n, np.int64), np.arange(n)
            bounds = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True])
            found = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a <= 4:
                    for i in range(a, b):
                        for j in range(i + 1, b):
                            if min(size[i], size[j]) >= at.least * max(size[i], size[j]):
                                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                                if both / (size[i] + size[j] - both) >= at.least:
                                    found.append((np.array([i]), np.array([j])))
                    continue
                both = overlaps(sets[a:b])
                i, j = np.nonzero(np.triu(both / (size[a:b, None] + size[None, a:b] - both) >= at.least, 1))
                found.append((i + a, j + a))
            if found:
                i, j = (np.concatenate(x) for x in zip(*found, strict=True))
                ok = (side[i] == 0) | (side[i] != side[j])
                i, j = i[ok], j[ok]
                np.add.at(links, i, mult[j])
                np.add.at(links, j, mult[i])
                lab = labels(n, i, j)
            yield pa.RecordBatch.from_pydict({"uid": pa.array(uid), "links": pa.array(links), "to": pa.array(uid[lab])})

    return groups.select("block", "side", "uid", "copies", "tokens").repartition("block").sortWithinPartitions("block").mapInArrow(run, "uid long, links long, to long")


def fetch_sets(docs: DataFrame, wanted: DataFrame, at: Join) -> DataFrame:
    """wanted (uid, doc_id, digest, ...) with `tokens`, each set computed again from its text."""
    small_batches(docs.sparkSession)
    rest = [c for c in wanted.columns if c not in ("doc_id", "digest")]
    d = docs.select(F.col("doc_id").cast("long").alias("d"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    wanted = stage(wanted, "wanted")
    d = d.join(if_small(wanted), F.col("d").eqNullSafe(F.col("doc_id"))).select("text", "digest", *rest)
    # Where few sets are wanted, the texts stay where they are; else both sides are shuffled.
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields if f.name in rest) + ", tokens binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [s.tobytes() for s in shingle_sets(batch["text"].to_pylist(), at.words)]
            # Another text of the same id isn't the one that is wanted.
            ok = pa.array([hashlib.blake2b(r, digest_size=16).digest() == g for r, g in zip(raw, batch["digest"].to_pylist(), strict=True)], pa.bool_())
            cols = {c: batch[c] for c in rest} | {"tokens": pa.array(raw, pa.binary())}
            yield pa.RecordBatch.from_pydict(cols).filter(ok)

    return d.mapInArrow(run, schema)


def join(docs: DataFrame, at: Join = Join()) -> DataFrame:
    """One row a document: doc_id, class_id, copy_of, n_links.

    n_links: other documents with a similarity of `least` or more, equal sets included.
    class_id: the smallest doc_id that links reach. copy_of: the smallest with an equal
    set. A text without words has an empty set, which is similar to none: it is a
    class of its own, without links. Null text is empty. Repeated rows are documents
    of their own, equal to each other; null ids come first only where a class has
    no other. An empty table gives no rows; extra columns are ignored.
    """
    return _joined(docs, describe(docs, at), at).select("doc_id", "class_id", "copy_of", "n_links")


def _joined(docs: DataFrame, all_: DataFrame, at: Join) -> DataFrame:
    real = all_.where("size > 0")
    # Of equal sets, the row with the smallest id stands for all.
    classes = real.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("first"), F.count("*").alias("copies"))
    classes = stage(classes.select("digest", F.col("first.doc_id").alias("copy_of"), F.col("first.uid").alias("rep"), "copies"), "classes")
    heads = all_.join(classes.select(F.col("rep").alias("uid"), "copies"), "uid")
    ends = leaves(heads, at).join(heads.select("uid", "size", "sketch"), "uid")
    groups = stage(components(candidates(ends, at)), "shingle-groups")
    wanted = groups.withColumnRenamed("id", "uid").join(heads.select("uid", "doc_id", "digest", "copies", "size"), "uid")
    blocks = split_groups(wanted, "component", "uid", at.chunk, "size", at.chunk_shingles)
    sets = fetch_sets(docs, blocks.select("uid", "doc_id", "digest", "copies", "block", "side"), at).dropDuplicates(["uid", "block"])
    exact = stage(verified(sets, at), "shingle-links")
    links = exact.groupBy("uid").agg(F.sum("links").alias("links"))
    parts = components(exact.select(F.col("uid").alias("a"), F.col("to").alias("b"))).withColumnRenamed("id", "rep")
    named = classes.join(parts, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = F.min(F.struct(F.col("copy_of").isNull(), "copy_of", "rep"))
    names = named.groupBy("component").agg(least.alias("least")).select("component", F.col("least.copy_of").alias("class_id"), F.col("least.rep").alias("keeper"))
    named = named.join(names, "component").join(links.withColumnRenamed("uid", "rep"), "rep", "left")
    named = stage(named.select("digest", "keeper", "class_id", "copy_of", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "named")
    out = real.select("uid", "doc_id", "digest").join(named, "digest")
    empty = all_.where("size = 0").select("uid", "doc_id", F.col("uid").alias("keeper"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"), F.lit(0).cast("long").alias("n_links"))
    return out.select(*empty.columns).unionByName(empty)


def keep_one(docs: DataFrame, at: Join = Join()) -> DataFrame:
    """``docs`` with one document of each class: the row of its smallest doc_id.

    Rows are told apart by id and text; of rows that repeat both, one stays.
    """
    all_ = describe(docs, at)
    out = _joined(docs, all_, at)
    marked = stage(out.join(all_.select("uid", "mark"), "uid").select("doc_id", "mark", (F.col("uid") == F.col("keeper")).alias("keep")), "kept")
    ids = marked.groupBy("doc_id", "mark").agg(F.bool_or("keep").alias("keep"), F.count("*").alias("n"))
    ids = stage(ids.where("n > 1 or not keep"), "kept-ids")
    same = lambda t: [t["doc_id"].eqNullSafe(docs["doc_id"].cast("long")), t["mark"] == _mark(docs["text"])]
    rest = docs.join(if_small(ids), same(ids), "left_anti")  # the smaller side is what goes
    again = ids.where("n > 1 and keep")
    if again.isEmpty():
        return rest
    return rest.unionByName(docs.join(again, same(again), "left_semi").dropDuplicates(["doc_id", "text"]))
