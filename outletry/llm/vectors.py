"""Embedding near-duplicates by cross-polytope hashing (operator 5).

Each vector is turned by pseudo-random rotations (three rounds of random signs and a
fast Hadamard transform); the axis it then lies nearest to is its hash. Several hashes
make a bucket's key, several keys a vector's tables; probes add the keys that differ
where a vector lies nearly as close to another axis. As many tables are made as the
recall wants, by the share of made-up pairs at the least cosine that meet in one.
Equal vectors are one class. Only buckets of two classes or more, and one of those
that hold the same, get vectors; pairs there are verified by their exact cosine. A pair
that is linked joins its component; all links of a component are then counted
exactly, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import labels, large_groups, near_pairs, one_of_each, shared_groups, split_groups, spread, whole_groups
from .common import if_small, stage
from .components import components


@dataclass(frozen=True)
class Hashing:
    """least: cosine of a link. recall: the chance that a pair at `least` shares a bucket.
    probes: further keys of a table. bucket: how many other vectors a bucket should hold of a
    corpus without copies; it sets how many hashes make a key, most_tables: but not so many that
    more tables than this were needed. chunk: rows of a large group in a task."""

    least: float = 0.95
    recall: float = 0.9995
    probes: int = 3
    bucket: float = 0.25
    most_tables: int = 16
    chunk: int = 3000
    seed: int = 3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; their length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        x = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.concatenate([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x


def keys(x: np.ndarray, hashes: int, tables: int, at: Hashing) -> np.ndarray:
    """[row, table * probes] bucket keys of unit vectors, tables one after another."""
    n, dim = x.shape
    width = 1 << (dim - 1).bit_length() if dim > 1 else 1
    x = np.pad(x, ((0, 0), (0, width - dim)))
    rng = np.random.default_rng([at.seed, dim])
    out = []
    for table in range(tables):
        own, second, gap = [], [], []
        for _ in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], width))
            size = np.abs(y)
            order = np.argpartition(-size, 1, axis=1)[:, :2] if width > 1 else np.zeros((n, 2), int)
            value = np.take_along_axis(size, order, 1)
            swap = value[:, 1] > value[:, 0]
            order[swap], value[swap] = order[swap][:, ::-1], value[swap][:, ::-1]
            sign = np.take_along_axis(y, order, 1) < 0
            code = 2 * order + sign
            own.append(code[:, 0])
            second.append(code[:, 1])
            gap.append(value[:, 0] - value[:, 1])
        own, second, gap = np.stack(own, 1), np.stack(second, 1), np.stack(gap, 1)
        # Probes change the sets of hashes whose second axis loses least; set 0 changes none.
        sets = np.array([[(s >> k) & 1 for k in range(hashes)] for s in range(1 << hashes)], float)
        cheap = np.argsort(gap @ sets.T, axis=1, kind="stable")[:, : 1 + at.probes]
        for p in range(cheap.shape[1]):
            change = sets[cheap[:, p]] > 0
            code = np.where(change, second, own)
            key = np.full(n, (dim * 1009 + table) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, np.uint64)
            for k in range(hashes):
                key = (key ^ code[:, k].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            out.append(key)
    return np.stack(out, 1).view(np.int64)


def plan(n: int, dim: int, at: Hashing) -> tuple[int, int]:
    """How many hashes make a key, and how many tables the recall needs, for n vectors.

    Made-up pairs at `least` are hashed: of few dimensions, so many tables are taken that
    (nearly) all meet; of more, as many as the share that meets in one table asks for.
    """
    rng = np.random.default_rng([at.seed, dim, 1])
    pairs, tables = (2000, at.most_tables) if dim <= 32 else (400, 4)
    a, b = rng.normal(size=(2, pairs, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= np.einsum("ij,ij->i", a, b)[:, None] * a
    b /= np.maximum(np.linalg.norm(b, axis=1)[:, None], 1e-12)
    b = at.least * a + np.sqrt(1 - at.least**2) * b
    hashes = max(1, round(np.log(max(n, 1) / at.bucket + 1) / np.log(2 * max(dim, 2))))
    while True:
        x, y = (keys(v, hashes, tables, at).reshape(pairs, tables, -1) for v in (a, b))
        met = (x[..., None] == y[..., None, :]).any((2, 3))
        if dim <= 32:
            missed = 1 - np.logical_or.accumulate(met, 1).mean(0)
            need = int(np.argmax(missed <= 1 - at.recall)) + 2 if missed[-1] <= 1 - at.recall else at.most_tables + 1
        else:
            need = int(np.ceil(np.log(1 - at.recall) / np.log(1 - min(max(met.mean(), 1e-4), 1 - 1e-4)))) + 1
        if need <= at.most_tables or hashes == 1:
            return hashes, max(4, min(need, 4 * at.most_tables))
        hashes -= 1


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _usable(vectors: DataFrame) -> DataFrame:
    """Adds ok: neither null nor empty nor zero, and all its components finite."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return vectors.withColumn("ok", F.coalesce((F.size(v) > 0) & fine, F.lit(False)))


def _hashed(good: DataFrame, hashes: int, tables: int, at: Hashing) -> DataFrame:
    """(key, uid) of all vectors, staged with a row a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch["v"].value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(size):
                part = batch.filter(pa.array(size == dim))
                for c in range(0, part.num_rows, 2000):
                    rows = part.slice(c, 2000)
                    k = keys(_unit(rows["v"]), hashes, tables, at)
                    offsets = pa.array(np.arange(0, k.size + 1, k.shape[1]), pa.int32())
                    yield pa.RecordBatch.from_pydict({"uid": rows["uid"], "keys": pa.ListArray.from_arrays(offsets, pa.array(k.ravel()))})

    return stage(good.mapInArrow(run, "uid long, keys array<long>"), "vector-keys").select("uid", F.explode("keys").alias("key"))


def _units(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, padded to one length, and their own lengths."""
    dims = pa.compute.list_value_length(table["v"]).to_numpy()
    unit = np.zeros((table.num_rows, int(dims.max())))
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        unit[at, :d] = _unit(table["v"].take(pa.array(at)))
    return unit, dims


def _joined(table: pa.Table, least: float) -> np.ndarray:
    """Of whole groups: each row's label, equal for rows that links join."""
    unit, dims = _units(table)
    group, lab = table["block"].to_numpy(), np.arange(table.num_rows)
    for i, j in near_pairs(group):
        ok = (np.einsum("ij,ij->i", unit[i], unit[j]) >= least) & (dims[i] == dims[j])
        lab = labels(len(lab), i[ok], j[ok], lab)
    for a, b in large_groups(group):
        lab = spread(len(lab), lab, a, b, lambda i, j: (unit[i] @ unit[j].T >= least) & (dims[i][:, None] == dims[j]))
    return lab


def _links(table: pa.Table, least: float) -> np.ndarray:
    """Of whole groups: how many vectors each row links with; rows with side -1 are compared with those of side 1 alone."""
    unit, dims = _units(table)
    group, side, copies = table["block"].to_numpy(), table["side"].to_numpy(), table["copies"].to_numpy()
    links = np.zeros(table.num_rows, np.int64)

    def add(i: np.ndarray, j: np.ndarray) -> None:
        ok = (side[i] == 0) | (side[i] != side[j])
        np.add.at(links, i[ok], copies[j[ok]])
        np.add.at(links, j[ok], copies[i[ok]])

    for i, j in near_pairs(group):
        ok = (np.einsum("ij,ij->i", unit[i], unit[j]) >= least) & (dims[i] == dims[j])
        add(i[ok], j[ok])
    for a, b in large_groups(group):
        for c in range(a, b, 512):
            e = min(c + 512, b)
            i, j = np.nonzero((unit[c:e] @ unit[a:b].T >= least) & (dims[c:e, None] == dims[None, a:b]))
            keep = i + c < j + a
            add(i[keep] + c, j[keep] + a)
    return links


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", at: Hashing = Hashing()) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Vectors that are null, empty or zero, or have null or non-finite components, link
    with nothing; nor do vectors of different lengths. Repeated ids are vectors of
    their own; a component is named after its smallest id, and a null id alone after
    nothing. No rows give none. Extra columns are ignored.
    """
    kind = dict(vectors.dtypes)[column]
    own = F.col(column) if kind == "array<float>" else F.col(column).cast("array<double>")  # compared in double precision
    v = _usable(vectors.select(F.col(id_column).cast("long").alias("vec_id"), own.alias("v")))
    v = v.withColumns({"uid": F.monotonically_increasing_id(), "g": F.when(F.col("ok"), F.unhex(F.sha2(F.col("v").cast("string"), 256)))})
    v = stage(v, "vectors")
    good = v.where("ok")
    n, dim = good.agg(F.count("*"), F.max(F.size("v"))).first()
    hashes, tables = plan(n, dim or 2, at)
    # Of equal vectors, the row with the smallest id stands for all.
    first = F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "uid"))
    copied = good.groupBy("g").agg(first.alias("first"), F.count("*").alias("copies")).where("copies > 1")
    copied = stage(copied.select("g", F.col("first.uid").alias("rep"), "copies"), "vector-copies")
    others = good.select("uid", "g").join(if_small(copied.select("g", "rep")), "g").where("uid <> rep").select("uid")
    heads = good.select("uid", "v").join(if_small(stage(others, "vector-others")), "uid", "left_anti")
    hashed = _hashed(heads, hashes, tables, at)
    shared = if_small(stage(one_of_each(shared_groups(hashed, "key", "uid"), "key"), "vector-buckets"))
    buckets = stage(split_groups(hashed.join(shared, "key"), "key", "uid", at.chunk).select("block", "uid"), "vector-members")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "block"):
            uid = table["uid"].to_numpy()
            lab = _joined(table, at.least)
            x = np.flatnonzero(lab != np.arange(len(lab)))
            yield pa.RecordBatch.from_pydict({"a": pa.array(uid[x]), "b": pa.array(uid[lab[x]])})

    edges = buckets.join(good.select("uid", "v"), "uid").select("block", "uid", "v").repartition("block").sortWithinPartitions("block").mapInArrow(link, "a long, b long")
    parts = stage(components(edges), "vector-components")
    inside = parts.join(if_small(copied.select(F.col("rep").alias("id"), "copies")), "id", "left").select(F.col("id").alias("uid"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), "component")
    inside = split_groups(inside, "component", "uid", at.chunk).join(good.select("uid", "v"), "uid")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "block"):
            yield pa.RecordBatch.from_pydict({"uid": table["uid"].combine_chunks(), "links": pa.array(_links(table, at.least))})

    counted = inside.select("block", "side", "uid", "copies", "v").repartition("block").sortWithinPartitions("block").mapInArrow(count, "uid long, links long")
    counted = counted.groupBy("uid").agg(F.sum("links").alias("links"))
    # Rows that copies or links join to others: their class's row, part and links.
    linked = parts.withColumnRenamed("id", "uid").join(counted, "uid")
    rows = v.select("vec_id", "uid", "g").join(if_small(copied), "g", "left").drop("g").withColumn("head", F.coalesce("rep", "uid"))
    rows = rows.join(if_small(stage(linked.withColumnRenamed("uid", "head"), "vector-links")), "head", "left")
    rows = rows.withColumn("component", F.coalesce("component", "head"))
    names = rows.where("links is not null or copies > 1").groupBy("component").agg(F.min("vec_id").alias("name"))
    rows = rows.join(if_small(stage(names, "vector-names")), "component", "left").withColumn("component_id", F.coalesce("name", "vec_id"))
    total = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return rows.select("vec_id", total.cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
