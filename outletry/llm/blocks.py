"""Whole groups in bounded tasks: splitting large groups into pairs of chunks, and local components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def split_groups(rows: DataFrame, group: str, uid: str, most: int, weight: str | None = None, most_weight: int = 0) -> DataFrame:
    """Rows with `block` (a long that names a group, or a pair of chunks of one) and `side`.

    A group over `most` rows (or `most_weight` in all) is dealt into chunks by the hash of
    `uid`; each row goes to every pair of chunks with its own. side is 0 in a group left
    whole and in a chunk paired with itself; else -1 for the lower chunk and 1 for
    the higher, of which only pairs across are to be compared. Thus every pair of a
    group meets exactly once, and no task holds more than two chunks.
    """
    size = [F.count("*").alias("n"), (F.sum(weight) if weight else F.lit(0)).alias("w")]
    parts = F.greatest(F.ceil(F.col("n") / most), F.ceil(F.col("w") / most_weight) if most_weight else F.lit(1)).cast("int")
    big = stage(rows.groupBy(group).agg(*size).withColumn("parts", parts).where("parts > 1").select(group, "parts"), "big-groups")
    if big.isEmpty():
        return rows.withColumns({"block": F.xxhash64(group), "side": F.lit(0)})
    r = rows.join(big, group, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    r = r.withColumn("own", F.pmod(F.xxhash64(F.lit(5), uid), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pair = [F.least("own", "other"), F.greatest("own", "other")]
    return r.withColumns({"block": F.xxhash64(group, *pair), "side": F.signum(F.col("own") - F.col("other")).cast("int")}).drop("own", "other", "parts")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int = 4000) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches sorted by `key`; large ones only where a group is."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1], "left"))  # the last group may go on
        last = held[-1][key][held[-1].num_rows - 1].as_py() if held else None
        if rows >= least and (cut > 0 or last != keys[-1]):
            head = batch.slice(0, cut)
            yield pa.Table.from_batches([*held, *([head] if cut else [])])
            held, rows = [batch.slice(cut)], batch.num_rows - cut
        else:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield pa.Table.from_batches(held)


def labels(n: int, i: np.ndarray, j: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The smallest node that each of n nodes reaches by the pairs (i, j), besides `start`'s links."""
    lab = np.arange(n) if start is None else start
    while True:
        new = lab.copy()
        m = np.minimum(lab[i], lab[j])
        np.minimum.at(new, i, m)
        np.minimum.at(new, j, m)
        np.minimum.at(new, lab, new)  # the old label follows its nodes
        new = new[new]
        if np.array_equal(new, lab):
            return lab
        lab = new


def near_pairs(group: np.ndarray, most: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of places in groups of up to `most` rows; `group` is sorted."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[starts, len(group)])
    small = np.repeat(sizes <= most, sizes)
    for off in range(1, int(min(most, sizes.max(initial=0)))):
        i = np.flatnonzero((group[off:] == group[:-off]) & small[off:])
        if not len(i):
            return
        yield i, i + off


def large_groups(group: np.ndarray, most: int = 64) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of the groups over `most` rows."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    ends = np.r_[starts[1:], len(group)]
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        if b - a > most:
            yield a, b


def spread(n: int, lab: np.ndarray, a: int, b: int, near) -> np.ndarray:
    """`lab` after all links among the places a to b, without asking for pairs that are joined already.

    near(i, j) gives the matrix of links between two arrays of places. Rows that are in one
    part are only compared with those outside of it, so a group that hangs together
    takes about as many comparisons as it has rows, and never more than all pairs.
    """
    todo = np.arange(a, b)
    while len(todo) > 1:
        todo = todo[np.argsort(lab[todo], kind="stable")]
        of, size = np.unique(lab[todo], return_counts=True)
        todo = todo[np.argsort(-size[np.searchsorted(of, lab[todo])], kind="stable")]
        one, rest = todo[:64], todo
        if lab[one[0]] == lab[one[-1]]:
            same = lab[todo] == lab[one[0]]
            one, rest = todo[same][:2048], todo[~same]
        step = max(256, (1 << 18) // len(one))
        for c in range(0, len(rest), step):
            i, j = np.nonzero(near(one, rest[c : c + step]))
            lab = labels(n, one[i], rest[c + j], lab)
        todo = todo[~np.isin(todo, one)]
    return lab


def shared_groups(rows: DataFrame, group: str, uid: str) -> DataFrame:
    """(group, n, x, m): the groups of two rows or more; equal n, x, m say that they hold the same uids."""
    mark = F.xxhash64(F.lit(9), uid)
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.min(uid).alias("m")).where("n > 1")


def one_of_each(groups: DataFrame, group: str) -> DataFrame:
    """(group): of groups that hold the same uids, one."""
    return groups.groupBy("n", "x", "m").agg(F.min(group).alias(group)).select(group)
