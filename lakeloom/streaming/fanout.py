"""Streaming fan-out of the event feed: typed, raw, adherence and latency sinks."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators.routing import adherence_subset, latency_rows, raw_tee, typed_feed
from lakeloom.sources.envelopes import decode_payload, envelope_columns
from lakeloom.sources.pointers import pointer_of
from lakeloom.streaming.names import stream_name

SINKS = ("typed", "raw", "adherence", "latency", "rejected")


def feeds(decoded: DataFrame, received, *, column: str = "body") -> dict[str, DataFrame]:
    """The five outputs of one set of decoded records.

    The raw tee keeps the other fields of the queue's record, as ``record``; rejects keep the pointer to it.
    """
    pointer = pointer_of(decoded)
    others = [c for c in decoded.columns if c not in (column, "payload", *pointer)]
    envelopes = envelope_columns(decoded, keep=[F.to_json("payload").alias("data"), *pointer])
    good = envelopes.filter(F.size("envelope_errors") == 0)
    typed = typed_feed(good).select("event_type", "pub_sub_event_id", "data")
    usable = decoded.filter(F.col("payload").isNotNull())
    return {
        "typed": typed,
        "raw": raw_tee(usable, keep=[F.struct(*others).alias("record")] if others else []),
        "adherence": adherence_subset(usable),
        "latency": latency_rows(good, received),
        "rejected": envelopes.filter(F.size("envelope_errors") > 0).select(
            *pointer, "event_type", "pub_sub_event_id", F.col("envelope_errors").alias("errors")
        ),
    }


def write_feeds(records: DataFrame, batch_id: int, root: str, *, stream: str, column: str = "body", received=None) -> None:
    """Write one micro-batch to all sinks.

    The records are decoded once and kept for the sinks. Every sink is partitioned by the
    stream's name and ``batch_id`` first and overwrites only the partitions it writes, so a
    batch that is repeated after a failure replaces itself.
    """
    received = F.current_timestamp() if received is None else received
    kept = decode_payload(records, column).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, rows in feeds(kept, received, column=column).items():
            partitions = ["stream", "batch_id", "event_type"] if name == "typed" else ["stream", "batch_id"]
            (
                rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id)})
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*partitions)
                .parquet(f"{root}/{name}")
            )
    finally:
        kept.unpersist()


def start_fanout(records: DataFrame, root: str, checkpoint: str, *, column: str = "body", received=None, name: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the fan-out of a record stream; many may run side by side into one root."""
    stream = stream_name(checkpoint, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_feeds(batch, batch_id, root, stream=stream, column=column, received=received)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).queryName(f"fanout-{stream}")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
