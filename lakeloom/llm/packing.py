"""Packing of token pieces into as few sequences as possible.

The number of pieces of each length is all that the packing problem depends on. So the tasks
encode and count, the driver solves the configuration linear program over the histogram
(at most ``capacity`` entries whatever the size of the corpus), and the tasks place their
pieces by looking up length and rank in the resulting plan.

The program asks for the fewest sequences such that each length is covered as often as it
occurs. It is solved by multiplicative weights: each length's weight falls as it is covered, a
knapsack dynamic program finds the configuration with the most weight, and its share of the
solution grows. Shares are rounded down; what is left of the histogram goes, longest first, to
the sequence where it fits best, equal sequences at a time.

Null and empty texts hold the end id alone, equal doc_ids are separate rows, and an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lakeloom.llm.common import giving_back, staged
from lakeloom.llm.tokens import arrow_rows, encoded_batches

CAPACITY, ROUNDS = 1024, 1500
#: Share of a length's demand that one round may cover, and how fast its weight falls.
STEP, RATE = 0.5, 1.0
_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("nth", pa.int64())])
_PIECE_KINDS = "doc_id long, piece int, start long, length long, ids_crc32 long, nth long"
_PLACED = pa.schema([*list(_PIECES)[:5], ("sequence_id", pa.int64()), ("offset", pa.int64())])


def best_configuration(lengths: np.ndarray, values: np.ndarray, limits: np.ndarray, capacity: int) -> Counter:
    """Knapsack dynamic program: lengths, with repetition, of the most value within the capacity.

    A length taken more often than its limit is cut back to the limit.
    """
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = int(np.searchsorted(lengths, room, "right"))
        best[room] = best[room - 1]
        if fit:
            got = best[room - lengths[:fit]] + values[:fit]
            k = int(got.argmax())
            if got[k] > best[room]:
                best[room], choice[room] = got[k], k
    taken: Counter = Counter()
    room = capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        taken[int(choice[room])] += 1
        room -= int(lengths[choice[room]])
    return Counter({k: min(c, int(limits[k])) for k, c in taken.items() if limits[k] > 0})


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Configurations (how often each length occurs) and how many sequences use each; they cover the histogram exactly."""
    plan: list[tuple[dict[int, int], int]] = []
    if histogram.get(capacity):
        plan.append(({capacity: 1}, histogram[capacity]))
    lengths = np.array(sorted(k for k, n in histogram.items() if n and k < capacity), np.int64)
    if not len(lengths):
        return plan
    demand = np.array([histogram[int(k)] for k in lengths], np.int64)
    covered, shares = np.zeros(len(lengths)), Counter()
    for _ in range(rounds):
        ratio = covered / demand
        ids = np.flatnonzero(ratio < 1)
        if not len(ids):
            break
        # a length's weight starts as its size, so that full configurations win
        weights = np.exp(-RATE * ratio[ids]) * lengths[ids]
        found = {int(ids[k]): c for k, c in best_configuration(lengths[ids], weights, demand[ids], capacity).items()}
        step = min(max(STEP * demand[k], demand[k] - covered[k] if ratio[k] > 1 - STEP else 0) / c for k, c in found.items())
        for k, c in found.items():
            covered[k] += c * step
        shares[tuple(sorted(found.items()))] += step
    left = demand.copy()
    opened: list[tuple[dict[int, int], int]] = []
    for found, share in shares.most_common():
        times = min([int(share), *(int(left[k] // c) for k, c in found)])
        if times > 0:
            opened.append(({int(lengths[k]): c for k, c in found}, times))
            for k, c in found:
                left[k] -= c * times
    return plan + best_fit(opened, {int(lengths[k]): int(left[k]) for k in np.flatnonzero(left)}, capacity)


def best_fit(opened: list[tuple[dict[int, int], int]], left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Put the lengths left, longest first, where they fit best; equal sequences are handled together."""
    by_room: dict[int, list[tuple[dict[int, int], int]]] = {}
    for found, times in opened:
        by_room.setdefault(capacity - sum(k * c for k, c in found.items()), []).append((found, times))
    for length in sorted(left, reverse=True):
        n = left[length]
        room = length
        while n and room < capacity:
            while n and by_room.get(room):
                found, times = by_room[room].pop()
                used = min(times, n)
                if times > used:
                    by_room[room].append((found, times - used))
                more = {**found, length: found.get(length, 0) + 1}
                by_room.setdefault(room - length, []).append((more, used))
                n -= used
            room += 1
        fit = capacity // length
        for c in (fit, n % fit):
            times = n // c if c else 0
            if times:
                by_room.setdefault(capacity - c * length, []).append(({length: c}, times))
                n -= c * times
    return [one for rooms in by_room.values() for one in rooms]


def plan_table(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """By length, rows (first rank, first sequence, offset): ranks from there on go to consecutive sequences."""
    rows: dict[int, list] = {}
    used: Counter = Counter()
    sequence = 0
    for found, times in plan:
        offset = 0
        for length, c in found.items():
            for _ in range(c):
                rows.setdefault(length, []).append((used[length], sequence, offset))
                used[length] += times
                offset += length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def token_pieces(docs: DataFrame, tokenizer: str, *, lowers: bool, end: int, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece; ``nth`` counts the pieces of a length within the task ``part``."""

    def cut(batches):
        seen = np.zeros(capacity + 1, np.int64)
        for batch, ids, counts in encoded_batches(batches, tokenizer, lowers, end):
            ids = ids.astype("<u4")
            pieces = -(-counts // capacity)
            doc = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = counts - (pieces - 1) * capacity  # the first piece is the short one
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[doc], capacity)
            at = (np.cumsum(counts) - counts)[doc] + start
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            first = np.searchsorted(ranked, ranked)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - first
            nth += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            yield arrow_rows(_PIECES, doc_id=batch.column("doc_id").take(pa.array(doc)), piece=piece, start=start, length=length, ids_crc32=crc, nth=nth)

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(cut), _PIECE_KINDS)
    return rows.withColumn("part", F.spark_partition_id())


def pack(docs: DataFrame, tokenizer: str, *, lowers: bool, end: int, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there."""
    pieces = staged(token_pieces(docs, tokenizer, lowers=lowers, end=end, capacity=capacity), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    table = plan_table(solve(histogram, capacity))
    before = counts.select("part", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for one in np.unique(length):
                rows, mine = table[int(one)], length == one
                k = np.searchsorted(rows[:, 0], rank[mine], "right") - 1
                sequence[mine] = rows[k, 1] + rank[mine] - rows[k, 0]
                offset[mine] = rows[k, 2]
            yield arrow_rows(_PLACED, **{c: batch.column(c) for c in _PLACED.names[:5]}, sequence_id=sequence, offset=offset)

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
