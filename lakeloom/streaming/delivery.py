"""Delivery of numbered batches to a receiver, with a ledger of what it has taken."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from lakeloom.sinks.versions import _files

KEYS = ["file", "event_type", "batch"]
#: Batches that are sent in one job; the ledger grows by one folder a job.
ROUND = 10_000

LEDGER = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("event_type", T.StringType()), T.StructField("batch", T.LongType()),
    T.StructField("records", T.LongType()), T.StructField("error", T.StringType()),
])


class DeliveryFailed(RuntimeError):
    """Some batches were not taken; a repetition sends these and no others."""


def deliver_batches(records: DataFrame, send: Callable[[str, list[Row]], None], ledger: str, *, per_round: int = ROUND) -> int:
    """Call ``send(event_type, rows)`` for every batch of ``records`` that the ledger does not have; returns how many were sent.

    ``records`` has ``file``, ``event_type`` and ``batch``; a batch is small and goes to one task. A batch
    counts as taken when ``send`` returns; what it raises is kept in the ledger, the other batches go on,
    and at the end ``DeliveryFailed`` is raised. The results of a round are committed with its job: an
    executor or driver that dies before that repeats at most the batches of that round, so receivers see
    no batch again that an earlier round has reported, and any batch twice only after such a loss.
    """
    spark = records.sparkSession
    sent, failed, least = 0, 0, None
    names = records.columns

    def take(key, table):
        event_type, error = key[1].as_py(), None
        try:
            send(event_type, [Row(**row) for row in table.to_pylist()])
        except Exception as problem:  # the receiver's, kept for the report
            error = f"{type(problem).__name__}: {problem}"
        one = [[k.as_py()] for k in key] + [[table.num_rows], [error]]
        return pa.table({f.name: pa.array(v, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f, v in zip(LEDGER, one)})

    records = records.persist(StorageLevel.MEMORY_AND_DISK)  # numbered once, however many rounds there are
    try:
        total = _open(spark, records, ledger).agg(F.count_distinct(F.struct(*KEYS))).first()[0]
        rounds = max(1, -(-total // per_round))
        for nth in range(rounds):
            mine = _open(spark, records, ledger).where(F.pmod(F.xxhash64(*KEYS), F.lit(rounds)) == nth)
            folder = f"{ledger.rstrip('/')}/{uuid.uuid4().hex}"
            mine.select(*names).groupBy(*KEYS).applyInArrow(take, LEDGER).write.parquet(folder)
            done = spark.read.schema(LEDGER).parquet(folder).agg(F.count_if(F.col("error").isNull()), F.count_if(F.col("error").isNotNull()), F.min("error")).first()
            sent, failed, least = sent + done[0], failed + done[1], done[2] or least
    finally:
        records.unpersist()
    if failed:
        raise DeliveryFailed(f"{failed} batches were not taken, such as: {least}")
    return sent


def taken(spark: SparkSession, ledger: str) -> DataFrame:
    """The batches that were taken."""
    files, path = _files(spark, ledger)
    folders = [s.getPath().toString() for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []
    whole = [f for f in folders if files.exists(_files(spark, f"{f}/_SUCCESS")[1])]
    rows = spark.read.schema(LEDGER).parquet(*whole) if whole else spark.createDataFrame([], LEDGER)
    return rows.where(F.col("error").isNull()).select(*KEYS, "records")


def _open(spark: SparkSession, records: DataFrame, ledger: str) -> DataFrame:
    done = taken(spark, ledger).select(*KEYS).alias("d")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"d.{k}")) for k in KEYS]
    return records.alias("r").join(done, same, "left_anti")
