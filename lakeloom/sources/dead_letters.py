"""Dead letters: NDJSON error files whose rows hold the failed payload as base64."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeloom.sources.envelopes import decode_payload
from lakeloom.sources.pointers import POINTER

SCHEMA = T.StructType([T.StructField("rawData", T.StringType())])

# Fixed value: what the delivery service appends to the name of a failed feed.
FAILED_SUFFIX = "processing-failed"


def failed_event(path: Column) -> Column:
    """Event name of an error file: its feed folder without the suffix, dated folders below it or not."""
    return F.regexp_extract(path, rf"([^/]+){FAILED_SUFFIX}/", 1)


def read_dead_letters(spark: SparkSession, prefix: str) -> DataFrame:
    """One row per error record: ``file``, ``block``, ``failed_event``, ``raw_data``. Blank lines drop out."""
    return _named(spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(prefix))


def stream_dead_letters(spark: SparkSession, prefix: str, **options: str) -> DataFrame:
    """The same as a file stream."""
    reader = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true")
    return _named(reader.options(**options).json(prefix))


def _named(rows: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return rows.select(
        path.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        failed_event(path).alias("failed_event"),
        F.col("rawData").alias("raw_data"),
        F.struct(path.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.lit(None).cast("string").alias("id"), F.xxhash64("rawData").alias("print")).alias(POINTER),
    )


def failed_events(letters: DataFrame) -> DataFrame:
    """The distinct names of failed feeds."""
    return letters.select("failed_event").distinct()


def records_per_file(letters: DataFrame) -> DataFrame:
    return letters.groupBy("file", "failed_event").agg(F.count(F.lit(1)).alias("records"))


def replay_records(letters: DataFrame) -> DataFrame:
    """Decoded payloads with the retry feed they go to."""
    decoded = decode_payload(letters, "raw_data")
    return decoded.select(
        "file",
        "block",
        "failed_event",
        F.try_variant_get("payload", "$.pubSubEvent", "string").alias("event_type"),
        F.concat(F.col("failed_event"), F.lit("-retry")).alias("feed"),
        F.to_json("payload").alias("data"),
        "payload",
        POINTER,
    )
