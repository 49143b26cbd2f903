"""Connected components of a link graph, by rounds of joins (used by operators 5 and 10)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import labels
from .common import stage


def _with_least(rows: DataFrame, least: DataFrame) -> DataFrame:
    """`rows` joined to `least` on a; the rows of keys that very many share stay where they are.

    A key is common if it has over a thousandth of all rows: there are a thousand such
    keys at most, which are broadcast. The other keys are shuffled.
    """
    total = least.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = least.where(F.col("n") > max(8, total // 1000))
    rare = least.join(F.broadcast(common.select("a")), "a", "left_anti")
    few = rows.join(F.broadcast(common), "a")
    rest = rows.join(F.broadcast(common.select("a")), "a", "left_anti").join(rare, "a")
    return few.unionByName(rest)


def _in_one_task(edges: DataFrame) -> DataFrame:
    """(id, component) of few enough edges, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b["a"].to_numpy(), b["b"].to_numpy()) for b in batches if b.num_rows]
        if got:
            a, b = (np.concatenate(x) for x in zip(*got, strict=True))
            ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            lab = labels(len(ids), at[: len(a)], at[len(a) :])
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids), "component": pa.array(ids[lab])})

    return edges.coalesce(1).mapInArrow(run, "id long, component long")


def components(edges: DataFrame, rounds: int = 60, small: int = 1_000_000) -> DataFrame:
    """(a, b) long pairs to (id, component): each node's smallest reachable id.

    Up to `small` edges (some 16 MB) are joined in one task. More go round by round: every
    round links each node to the smallest of its neighbours (and itself), and
    then that one to the others, alternately over larger and all neighbours, until
    all edges are stars around their component's smallest node. Each round is written
    to the shared folder. A star has one edge a node, so the edges never grow beyond
    twice their number; joins carry two numbers a row, and the centres of large stars
    are broadcast instead of gathering their rows in a task.
    """
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a <> b")
    e = stage(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if e.count() <= small:
        return _in_one_task(e)
    for _ in range(rounds):
        # Larger neighbours of every node go to the smallest node that it knows.
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n")), "least")
        up = _with_least(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stage(up.where("a <> b").distinct(), "edges")
        # Smaller neighbours, and the node itself, go to the smallest of them.
        least = stage(e.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "least")
        down = _with_least(e, least)
        e2 = stage(down.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).where("a <> b").distinct(), "edges")
        centres = stage(e2.groupBy(F.col("b").alias("a")).agg(F.count("*").alias("n")), "centres")
        if e2.groupBy("a").count().where("count > 1").isEmpty() and e2.select("a").join(centres, "a", "left_semi").isEmpty():
            return e2.select(F.col("a").alias("id"), F.col("b").alias("component")).union(centres.select("a", "a"))
        e = e2
    raise RuntimeError(f"components have not settled in {rounds} rounds")


def forest(n: int, pairs) -> list[tuple[int, int]]:
    """A spanning forest of local pairs among n nodes: stars around each part's first node."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return [(x, r) for x in range(n) if (r := root(x)) != x]
