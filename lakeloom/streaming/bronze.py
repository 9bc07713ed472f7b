"""Streaming bronze mapping: one query per feed, one table per mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.operators.routing import quarantine_rows
from lakeloom.plans.bronze import REJECTED, by_table, map_table
from lakeloom.sources.envelopes import decode_envelopes
from lakeloom.sources.pointers import pointer_of
from lakeloom.streaming.names import stream_name


def write_bronze_batch(records: DataFrame, batch_id: int, root: str, *, stream: str, column: str, tables: list[str] | None, event_type: Column | None = None) -> None:
    """Map one micro-batch; the partitions of a stream's repeated batch replace themselves."""
    envelopes = decode_envelopes(records, column, keep=pointer_of(records), event_type=event_type)
    with by_table(envelopes, tables) as parts:
        if REJECTED in parts:
            _write(quarantine_rows(parts.pop(REJECTED)), stream, batch_id, f"{root}/_rejected/envelope")
        for name, rows in parts.items():
            map_table(
                rows,
                name,
                lambda good, name=name: _write(good, stream, batch_id, f"{root}/{name}", "event_type", "date_year", "date_month"),
                lambda bad, name=name: _write(bad, stream, batch_id, f"{root}/_rejected/{name}"),
            )


def _write(rows: DataFrame, stream: str, batch_id: int, path: str, *partitions: str) -> None:
    (
        rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions, "stream", "batch_id")
        .parquet(path)
    )


def start_bronze(
    records: DataFrame,
    root: str,
    checkpoint: str,
    *,
    column: str = "data",
    tables: list[str] | None = None,
    event_type: Column | None = None,
    name: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the mapping of a record stream.

    Name the ``tables`` that the feed can hold: a feed of one event type needs one. Rows of
    other tables go to the rejects. Many feeds may run side by side into one root.
    """
    stream = stream_name(checkpoint, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_bronze_batch(batch, batch_id, root, stream=stream, column=column, tables=tables, event_type=event_type)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).queryName(f"bronze-{stream}")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
