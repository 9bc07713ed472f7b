"""Replay of dead letters and incremental reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators.latest import assign_batches
from lakeloom.sinks.records import BATCH_SIZE
from lakeloom.sources.dead_letters import replay_records, stream_dead_letters
from lakeloom.sources.pointers import POINTER
from lakeloom.streaming.delivery import deliver_batches
from lakeloom.streaming.names import stream_name


def in_batches(records: DataFrame, *, size: int = BATCH_SIZE) -> DataFrame:
    """Replayed records with their batch within file and event type.

    The order is that of the file: by block, then by position in the block. A block is
    bounded by the split size of the reader.
    """
    placed = records.withColumn("_place", F.monotonically_increasing_id())
    return assign_batches(placed, ["file", "event_type"], ["_place"], bucket=F.col("block"), size=size).drop("_place")


def start_replay(
    spark: SparkSession,
    prefix: str,
    out: str,
    checkpoint: str,
    *,
    archive: str | None = None,
    name: str | None = None,
    deliver: Callable[[DataFrame, int], None] | None = None,
    send: Callable[[str, list[Row]], None] | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Replay every error file once.

    ``send`` gets the records of each file and event type in batches of 100, on the executors, each
    batch until it has taken it: ``ledger`` (by default ``<out>_sent``) remembers what was taken.

    The checkpoint remembers the files, so a restart adds nothing. With ``archive`` the
    files are moved there after their batch is committed, instead of being deleted.
    Letters that cannot be decoded are not delivered: ``<out>_rejected`` points to them.
    """
    stream = stream_name(checkpoint, name)
    options = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    letters = stream_dead_letters(spark, prefix, **options)

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = replay_records(batch).drop("payload").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            records = decoded.filter(F.col("data").isNotNull()).drop(POINTER)
            lost = decoded.filter(F.col("data").isNull()).select(
                POINTER, "file", "block", "feed", F.lit("payload: not base64 JSON").alias("error"), F.array(F.lit("payload: not base64 JSON")).alias("errors"))
            for rows, path in ((records, out), (lost, f"{out.rstrip('/')}_rejected")):
                (
                    rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id)})
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("stream", "batch_id", "feed")
                    .parquet(path)
                )
            if deliver is not None:
                deliver(records, batch_id)
            if send is not None:
                deliver_batches(in_batches(records), send, ledger or f"{out.rstrip('/')}_sent")
        finally:
            decoded.unpersist()

    return (
        letters.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .queryName(f"replay-{stream}")
        .trigger(availableNow=True)
        .start()
    )


def read_new(spark: SparkSession, path: str, schema, checkpoint: str, handle: Callable[[DataFrame, int], None], *, fmt: str = "parquet") -> StreamingQuery:
    """Hand only the files that no earlier run committed to ``handle``."""
    return (
        spark.readStream.schema(schema)
        .format(fmt)
        .load(path)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
