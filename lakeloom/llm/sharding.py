"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered by key over the whole table. A keyed Feistel network permutes the smallest
power of two that holds all numbers; a result beyond the table is permuted again until it falls
inside (cycle walking), which makes it a permutation of exactly the row numbers. Permuted number
``p`` lies in shard ``p % shards`` at slot ``p div shards``: counts differ by one at most, and both
directions can be computed without a table. Only functions of Spark SQL are used, and only keys,
sizes and checksums are moved.

Null keys are numbered first; a null text has size 16 and the checksum of no bytes; equal rows are
told apart by their number only; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.llm.common import parts_for, staged

ROUNDS, WALKS, SEED = 6, 160, 20_240_229
ROWS_PER_PART = 1 << 20


def _network(value: str, bits: int, seed: int, inverse: bool) -> str:
    """SQL of the Feistel network on ``bits`` bits; the halves take turns, so their widths may differ."""
    low = bits - bits // 2
    widths = (bits // 2, low)
    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    steps = ", ".join(f"named_struct('nth', {i}, 'mask', {(1 << widths[i % 2]) - 1}L)" for i in order)
    mixed = "xxhash64({half}, r.nth, " + f"{seed}L) & r.mask"
    if inverse:
        step = f"named_struct('a', s.b ^ ({mixed.format(half='s.a')}), 'b', s.a)"
    else:
        step = f"named_struct('a', s.b, 'b', s.a ^ ({mixed.format(half='s.b')}))"
    start = f"named_struct('a', shiftright({value}, {low}), 'b', {value} & {(1 << low) - 1}L)"
    return f"aggregate(array({steps}), {start}, (s, r) -> {step}, s -> shiftleft(s.a, {low}) | s.b)"


def permuted(number: str, rows: int, seed: int = SEED, inverse: bool = False) -> Column:
    """A permutation of 0 .. rows - 1, or its inverse.

    A walk that is longer than WALKS steps (chance 2 ** -WALKS a row) fails instead of giving a wrong number.
    """
    bits = max(2, (rows - 1).bit_length())
    once = _network(number, bits, seed, inverse)
    again = _network("w", bits, seed, inverse)
    walked = f"aggregate(sequence(1, {WALKS}), {once}, (w, k) -> CASE WHEN w < {rows}L THEN w ELSE {again} END)"
    return F.expr(f"transform(array({walked}), p -> CASE WHEN p < {rows}L THEN p ELSE raise_error('cycle walk too long') END)[0]").cast("long")


def numbered(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with ``row_number`` from 0 in the order of the keys, without one task for all."""
    ranged = rows.repartitionByRange(parts_for(rows, ROWS_PER_PART), *keys).withColumn("part", F.spark_partition_id())
    held = staged(ranged, "numbered")
    counts = held.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each part
    nth = F.row_number().over(Window.partitionBy("part").orderBy(*keys)) - 1
    return held.withColumn("nth", nth).join(before, "part").withColumn("row_number", F.col("before") + F.col("nth")).drop("part", "nth", "before")


def shard(docs: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Every document with its size, checksum, shard and slot."""
    keys = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = numbered(keys, "doc_id", "size", "text_crc32")
    place = rows.withColumn("place", permuted("row_number", rows.count(), seed))
    return place.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def row_of(shard_column: str, slot: str, rows: int, shards: int, seed: int = SEED) -> Column:
    """The row number behind a shard and slot."""
    return permuted(f"(CAST({slot} AS LONG) * {shards} + {shard_column})", rows, seed, inverse=True)
