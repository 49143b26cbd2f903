"""Connected parts of a graph of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outletry.sources.staging import if_few, stage


def connected(edges: DataFrame) -> DataFrame:
    """(a, b) strings to (node, part): the smallest key that links reach, for every key with a link.

    Each round a key takes the smallest part of itself and its neighbours, and then that
    part's own, so chains halve; rounds end when nothing changes.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "part-edges")
    part = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("part")), "parts")
    n = part.count()
    while True:
        near = both.join(if_few(part.select(F.col("node").alias("b"), "part"), n=n), "b").groupBy(F.col("a").alias("node")).agg(F.min("part").alias("near"))
        nearer = if_few(part, n=n).join(near, "node").select("node", "part", F.least("part", "near").alias("near"))
        own = if_few(part.select(F.col("node").alias("near"), F.col("part").alias("further")), n=n)
        moved = stage(nearer.join(own, "near").select("node", "part", F.least("near", "further").alias("next")), "parts")
        if moved.where("next <> part").isEmpty():
            return moved.select("node", "part")
        part = moved.select("node", F.col("next").alias("part"))
