"""Every event once, however late it or its repeats come.

The ids that were let through are kept in a ledger, in partitions by the day of the event and a hash of
its id. A micro-batch is compared with those partitions only that its own events fall into, so the work
follows the batch and not the ledger's age; an event that is ten days late reads the partitions of
that day. Nothing expires.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeloom.sinks.versions import _files
from lakeloom.streaming.names import stream_name

BUCKETS = 16
#: Days of a batch that are named one by one when its part of the ledger is chosen; more are taken as a range.
NAMED_DAYS = 400


def keep_new(batch: DataFrame, batch_id: int, out: str, ledger: str, *, stream: str, key: str = "pub_sub_event_id", ts: str = "ts", buckets: int = BUCKETS) -> None:
    """Write the events of a micro-batch that the ledger does not have, then add them to the ledger.

    An event is known by its id and day; repeats carry the time of their first sending. Rows without an id
    repeat nothing and all pass. The ledger follows from what was written, and a batch that is repeated
    after a failure ignores its own entries, so it writes the same events again. One stream at a time
    may use a ledger.
    """
    spark, placed = batch.sparkSession, {"_day": _day(ts), "_bucket": _bucket(key, buckets)}
    rows = batch.withColumns(placed)
    once = rows.where(F.col(key).isNotNull()).dropDuplicates([key, "_day"])
    known = _known(spark, ledger, rows, stream, batch_id, key)
    if known is not None:
        once = once.join(known, [key, "_day"], "left_anti")
    new = once.unionByName(rows.where(F.col(key).isNull())).drop("_day", "_bucket")
    _write(new, stream, batch_id, out)
    place = f"{out.rstrip('/')}/stream={stream}/batch_id={batch_id}"
    files, path = _files(spark, place)
    if not files.exists(path):  # nothing was new
        return
    written = spark.read.schema(batch.schema).parquet(place)
    ids = written.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias(key), placed["_day"].alias("day"), placed["_bucket"].alias("bucket"))
    _write(ids, stream, batch_id, ledger, "day", "bucket")


def start_once(
    events: DataFrame,
    out: str,
    ledger: str,
    checkpoint: str,
    *,
    key: str = "pub_sub_event_id",
    ts: str = "ts",
    name: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start a stream that writes every event of ``events`` once."""
    stream = stream_name(checkpoint, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        keep_new(batch, batch_id, out, ledger, stream=stream, key=key, ts=ts)

    writer = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).queryName(f"once-{stream}")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def merge_ledger(spark: SparkSession, ledger: str, *, stream: str, before: int, key: str = "pub_sub_event_id") -> int:
    """Bring the entries of a stream's batches below ``before`` together; returns how many folders went.

    ``before`` must not be above the last committed batch. The ledger is a set: entries that are there
    twice, because a merge died half-way, change nothing.
    """
    entries = _entries(spark, ledger, key)
    if entries is None:
        return 0
    mark = -before - 1  # merged entries have negative numbers, so that no batch takes them for its own
    old = entries.where((F.col("stream") == stream) & (F.col("batch_id") < before) & (F.col("batch_id") != mark))
    places = old.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "")).distinct().toLocalIterator()
    folders = [r[0] for r in places]  # days by buckets by batches since the last merge
    if folders:
        _write(old.select(key, "day", "bucket").distinct().repartition("day", "bucket"), stream, mark, ledger, "day", "bucket")
        for folder in folders:
            files, path = _files(spark, folder)
            files.delete(path, True)
    return len(folders)


def _day(ts: str) -> Column:
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit("none"))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _entries(spark: SparkSession, ledger: str, key: str) -> DataFrame | None:
    files, path = _files(spark, ledger)
    if not files.exists(path) or not any("=" in s.getPath().getName() for s in files.listStatus(path)):
        return None
    return spark.read.schema(f"`{key}` string, day string, bucket int, stream string, batch_id long").parquet(ledger)


def _known(spark: SparkSession, ledger: str, rows: DataFrame, stream: str, batch_id: int, key: str) -> DataFrame | None:
    """Ids of the ledger in the partitions that rows of the batch fall into, without the batch's own."""
    entries = _entries(spark, ledger, key)
    if entries is None:
        return None
    places = rows.where(F.col(key).isNotNull()).groupBy("_day").agg(F.sort_array(F.collect_set("_bucket"))).collect()  # a row a day
    if not places:
        return None
    if len(places) <= NAMED_DAYS:
        there = F.lit(False)
        for day, own in places:
            there = there | ((F.col("day") == day) & F.col("bucket").isin(own))
    else:
        days = [day for day, _ in places]
        there = F.col("day").between(min(days), max(days))
    mine = (F.col("stream") == stream) & (F.col("batch_id") == batch_id)
    return entries.where(there & ~mine).select(F.col(key).cast(rows.schema[key].dataType).alias(key), F.col("day").alias("_day"))


def _write(rows: DataFrame, stream: str, batch_id: int, path: str, *first: str) -> None:
    (
        rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*first, "stream", "batch_id")
        .parquet(path)
    )
