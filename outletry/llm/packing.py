"""Packing documents into sequences by cutting-stock column generation (operator 4).

A document of n ids gives n // size full pieces and a remainder, which is cut once
more if it is over half a sequence. How many such pieces there are of each length is a histogram of fewer than `size` numbers,
whatever the corpus: the driver solves the cutting-stock program over it. Patterns
(so many pieces of each length that fit a sequence) enter the linear program as
knapsack dynamic programming finds them worth it; the solution's whole parts are
used, and best fit packs the few pieces that are left. Then every piece is ranked
among those of its length, and its rank names the sequence and the place in there.
Ranks come from counts of (partition, length), so no length meets in one task.
"""

from __future__ import annotations

import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_and_text, small_batches, stage
from .tokens import encoder

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@dataclass(frozen=True)
class Pack:
    """size: of a sequence. longest: a remainder over it is cut there, as two pieces over
    half a sequence never fit together. end_id: ends each document. gap: the program stops when it
    is within this share of its bound. rounds: of pricing at most; the patterns found
    till then are feasible in any case. steady: how far the duals are smoothed."""

    size: int = 1024
    longest: int = 512
    end_id: int = 0
    tokenizer: str = "byte_bpe_50k.json"
    gap: float = 0.002
    rounds: int = 3000
    steady: float = 0.8


def best_pattern(lengths: np.ndarray, worth: np.ndarray, size: int) -> tuple[float, np.ndarray]:
    """The knapsack: how often to take each length (ascending) for the most worth within `size`."""
    best, took = np.zeros(size + 1), np.full(size + 1, -1)
    upto = np.searchsorted(lengths, np.arange(size + 1), "right")
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            values = best[c - lengths[:k]] + worth[:k]
            j = int(values.argmax())
            if values[j] > best[c]:
                best[c], took[c] = values[j], j
    pattern, c = np.zeros(len(lengths)), size
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= lengths[took[c]]
    return float(best[size]), pattern


def cutting_stock(lengths: np.ndarray, demand: np.ndarray, at: Pack) -> list[tuple[int, dict[int, int]]]:
    """Patterns with how many sequences use each, meeting the demand exactly.

    Returns [(sequences, {length: pieces in each})].
    """
    if not len(lengths):
        return []
    m = len(lengths)
    basis = np.diag((at.size // lengths).astype(float))  # a column is a pattern, or -1 for a length given more than asked
    cost, inverse = np.ones(m), np.diag(1.0 / np.diag(basis))
    x = demand / np.diag(basis)
    ideal = centre = lengths / at.size  # a piece's worth where nothing is wasted
    bound = demand @ ideal
    for _ in range(at.rounds):
        duals = np.einsum("i,ij->j", cost, inverse)  # not by BLAS, whose threads only wait for each other here
        least = int(duals.argmin())
        if duals[least] < -1e-9:
            column, price = -np.eye(m)[least], 0.0
        else:
            # Duals of a half-solved program swing; a mix with those of the best bound so far steadies them.
            for share in (at.steady, at.steady / 2, 0.0):
                worth = share * centre + (1 - share) * duals
                value, column = best_pattern(lengths, worth, at.size)
                if worth @ demand / value > bound:
                    bound, centre = worth @ demand / value, worth / value
                if duals @ column > 1 + 1e-9:
                    break
            price = 1.0
            if duals @ column <= 1 + 1e-9 or cost @ x - bound <= max(0.5, at.gap * bound):
                break
        step = np.einsum("ij,j->i", inverse, column)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        r = int(ratio.argmin())
        basis[:, r], cost[r], far = column, price, ratio[r]
        row = inverse[r] / step[r]
        inverse -= np.outer(step, row)
        inverse[r] = row
        x = np.maximum(x - far * step, 0)
        x[r] = far
    used: Counter = Counter()
    left = demand.astype(np.int64)
    for j in np.argsort(-x, kind="stable"):
        n = int(x[j] + 1e-7) if cost[j] else 0
        while n > 0:
            pattern = np.minimum(basis[:, j].astype(np.int64), left)  # without what is covered already
            inside = pattern > 0
            if not inside.any():
                break
            times = min(n, int((left[inside] // pattern[inside]).min()))
            used[tuple(pattern)] += times
            left -= times * pattern
            n -= times
    return [(n, {int(lengths[i]): int(p[i]) for i in range(m) if p[i]}) for p, n in used.items()] + best_fit({int(n): int(c) for n, c in zip(lengths, left, strict=True) if c}, at.size)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Best fit, longest first, of the few pieces that rounding leaves."""
    rooms: list[list[Counter]] = [[] for _ in range(size + 1)]
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            room = next((r for r in range(length, size + 1) if rooms[r]), None)
            bin_ = Counter() if room is None else rooms[room].pop()
            bin_[length] += 1
            rooms[(size if room is None else room) - length].append(bin_)
    return [(n, dict(p)) for p, n in Counter(tuple(sorted(b.items())) for room in rooms for b in room).items()]


def slots(patterns: list[tuple[int, dict[int, int]]], first: int = 0) -> np.ndarray:
    """Which ranks of a length go where: rows (length, first rank, first sequence, pieces each, first offset), sorted."""
    ranks, rows, sequence = Counter(), [], first
    for n, pattern in patterns:
        offset = 0
        for length, each in sorted(pattern.items(), reverse=True):
            rows.append((length, ranks[length], sequence, each, offset))
            ranks[length] += n * each
            offset += each * length
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, at: Pack, with_ids: bool = False) -> DataFrame:
    """All pieces with the task that made them and their rank among its pieces of that length, staged."""
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, end, part, seen = encoder(at.tokenizer), struct.pack("<I", at.end_id), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                raw = encode(text) + end
                n = len(raw) // 4
                cuts = [*range(0, n, at.size), n]
                if at.longest < cuts[-1] - cuts[-2] < at.size:
                    cuts.insert(-1, cuts[-2] + at.longest)
                for start, stop in zip(cuts, cuts[1:], strict=False):
                    ids = raw[4 * start : 4 * stop]
                    length = len(ids) // 4
                    rows.append((doc_id, start, length, zlib.crc32(ids), n, seen[length], ids))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) or [()] * 7
            got = {k: pa.array(c, pa.int64()) for k, c in zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank"), columns, strict=False)}
            got["part"] = pa.array([part] * len(rows), pa.int32())
            if with_ids:
                got["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in columns[6]], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_pydict(got)

    return stage(id_and_text(docs).mapInArrow(cut, f"{PIECE}, rank long, part int" + ", ids array<long>" * with_ids), "pieces")


def pack(docs: DataFrame, at: Pack = Pack(), with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and its offset in there.

    Null text is empty: one piece, the end id. A null doc_id is kept. Repeated rows are
    packed as often as they come. An empty table gives no rows. Extra columns are
    ignored. `with_ids` adds each piece's ids, of which a sequence is made by joining
    its pieces by offset.
    """
    cut = pieces(docs, at, with_ids)
    counts = cut.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stage(counts.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))), "piece-ranks")
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # `size` rows at most
    full = histogram.pop(at.size, 0)
    lengths = np.array(sorted(histogram), np.int64)
    patterns = cutting_stock(lengths, np.array([histogram[n] for n in lengths], float), at)
    table = slots([(full, {at.size: 1})] * bool(full) + patterns)
    keys = (table[:, 0] << 44) + table[:, 1]
    ranked = cut.join(bases.select("length", "part", "base"), ["length", "part"]).withColumn("rank", F.col("rank") + F.col("base"))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(zero_copy_only=False), batch["rank"].to_numpy(zero_copy_only=False)
            s = table[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            turn = rank - s[:, 1]
            out = {c: batch[c] for c in columns}
            out["sequence_id"] = pa.array(s[:, 2] + turn // s[:, 3])
            out["offset"] = pa.array(s[:, 4] + turn % s[:, 3] * length)
            yield pa.RecordBatch.from_pydict(out)

    return ranked.select(*columns, "rank").mapInArrow(assign, PIECE + ", ids array<long>" * with_ids + ", sequence_id long, offset long")
