"""Record sinks: base64(JSON) output records and batches of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, functions as F

from lakeloom.functions.texts import encode_base64

BATCH_SIZE = 100


def output_records(rows: DataFrame, record_id: Column, *, drop: tuple[str, ...] = ()) -> DataFrame:
    """``recordId``, ``result`` and base64(JSON) ``data`` of every row."""
    kept = [c for c in rows.columns if c not in drop]
    return rows.select(
        record_id.alias("recordId"),
        F.lit("Ok").alias("result"),
        encode_base64(F.to_json(F.struct(*kept))).alias("data"),
    )


def send_batches(rows: DataFrame, send: Callable[[str, list[Row]], None], *, key: str = "event_type", size: int = BATCH_SIZE) -> None:
    """Call ``send(key, rows)`` on the executors with at most ``size`` rows of one key.

    Every partition sends its own batches, holding at most one open batch per key, so
    nothing is gathered. A retried task sends again: receivers must tolerate repeats.
    """

    def send_partition(partition) -> None:
        open_batches: dict[str, list[Row]] = {}
        for row in partition:
            batch = open_batches.setdefault(row[key], [])
            batch.append(row)
            if len(batch) == size:
                send(row[key], open_batches.pop(row[key]))
        for name, batch in open_batches.items():
            send(name, batch)

    rows.foreachPartition(send_partition)
