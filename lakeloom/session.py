"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What every job expects of its session.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # a stack trace per column call costs more than the column in large mappings
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, *, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def in_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are read and printed in UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path below the cluster's shared checkpoint folder.

    Only a local-mode session without such a folder may use a local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition rows that are about to multiply.

    Adaptive execution merges small partitions by the bytes it sees before an
    expansion, which would leave the expansion to a few tasks. A stated number of
    partitions is left alone, and joins and windows on the keys reuse it.
    """
    spark = rows.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(wanted, spark.sparkContext.defaultParallelism), *keys)


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="lakeloom-")
