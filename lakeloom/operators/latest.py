"""One row per key: latest rows, survivors of duplicates, exact numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.session import scratch_dir


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` columns of every key.

    Each task keeps at most one row per key before the shuffle, so a key that
    holds much of the input costs no more than any other.
    """
    kept = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*kept), F.struct(*order)).alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col("row")[c].alias(c) for c in kept]).select(*rows.columns)


def first_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the least ``order`` columns of every key."""
    kept = [c for c in rows.columns if c not in keys]
    oldest = F.min_by(F.struct(*kept), F.struct(*order)).alias("row")
    return rows.groupBy(*keys).agg(oldest).select(*keys, *[F.col("row")[c].alias(c) for c in kept]).select(*rows.columns)


def drop_duplicates_on(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key. With ``order`` the survivor is the greatest, else any row."""
    if order is None:
        return rows.dropDuplicates(keys)
    return latest_by_key(rows, keys, order)


def best_per_attributes(rows: DataFrame, chosen: list[str]) -> DataFrame:
    """One row per distinct value of all columns but ``chosen``.

    It takes the greatest ``chosen`` columns, nulls last, so a matched row wins over
    an unmatched one. Copies collapse before the shuffle.
    """
    attributes = [c for c in rows.columns if c not in chosen]
    best = F.max(F.struct(*chosen)).alias("best")
    return (
        rows.groupBy(*attributes).agg(best).select(*attributes, *[F.col("best")[c].alias(c) for c in chosen]).select(*rows.columns)
    )


def number_rows(
    rows: DataFrame, keys: list[str], order: list[str], *, bucket: Column | None = None, into: str = "row_number"
) -> DataFrame:
    """Exact 1-based numbering within ``keys``, without gathering a key in one task.

    Rows are ranked inside slices of a key and shifted by the size of the slices before.
    By default the slices come from a range partitioning over keys and order, which
    splits a hot key and a hot moment alike; they are written to the scratch folder
    once, so that counting and ranking see the same slices. A caller that knows a
    bounded, non-decreasing ``bucket`` along the order (the block of a file) passes it
    instead and saves the write.
    """
    tagged = _range_slices(rows, keys, order) if bucket is None else rows.withColumn("_slice", bucket)
    ordering = order if bucket is not None else [*order, "_tie"]
    sizes = tagged.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")).alias("s")
    inside = Window.partitionBy(*keys, "_slice").orderBy(*ordering)
    ranked = tagged.withColumn("_rank", F.row_number().over(inside)).alias("r")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in [*keys, "_slice"]]
    return ranked.join(starts, same, "left").select(
        *[F.col(f"r.{c}") for c in rows.columns], (F.col("_start") + F.col("_rank")).alias(into)
    )


def _range_slices(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows with their range partition; ``_tie`` lets equal rows fall into different ones."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    path = scratch_dir(spark, "slices")
    (
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *keys, *order, "_tie")
        .withColumn("_slice", F.spark_partition_id())
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def assign_batches(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    bucket: Column | None = None,
    size: int = 100,
    into: str = "batch",
) -> DataFrame:
    """Consecutive batches of at most ``size`` rows per key, numbered from 0."""
    numbered = number_rows(rows, keys, order, bucket=bucket, into="_row")
    number = F.floor((F.col("_row") - 1) / size).cast("bigint")
    return numbered.select(*rows.columns, number.alias(into))
