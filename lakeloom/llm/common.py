"""Steps that several operators share."""

from __future__ import annotations

import contextlib
import functools
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeloom.session import scratch_dir


#: Rows and bytes of an Arrow batch in jobs that send whole texts to Python and back.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """Smaller Arrow batches: both sides of the Python workers keep buffers of the largest batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


#: Lists that want to know what is staged meanwhile.
_LISTS: list[list[tuple[str, str | None]]] = []


@contextlib.contextmanager
def recorded():
    """The folders, and the tables over them, that are staged inside the block."""
    made: list[tuple[str, str | None]] = []
    _LISTS.append(made)
    try:
        yield made
    finally:
        _LISTS[:] = [other for other in _LISTS if other is not made]


def note(path: str, table: str | None = None) -> None:
    for made in _LISTS:
        made.append((path, table))


def discard(spark: SparkSession, made: list[tuple[str, str | None]]) -> None:
    """Delete staged folders and tables; nothing may read them any more."""
    for path, table in made:
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def give_back() -> None:
    """Return memory that this process holds but does not use."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(run):
    """The task function ``run``, after which the worker returns memory that it holds but does not use.

    Workers are kept from stage to stage; what one stage needed would else stay with them.
    """

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the cluster's shared folder and read it back, which also cuts the lineage."""
    path = scratch_dir(df.sparkSession, label)
    note(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(rows: DataFrame, per_part: int) -> int:
    """Partitions so that each gets about ``per_part`` rows; the count reads no column."""
    spark = rows.sparkSession
    return max(spark.sparkContext.defaultParallelism, -(-rows.count() // per_part))


def fold_of(key: str, folds: int) -> Column:
    """crc32 of a key's text form modulo ``folds`` (null key: that of an empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def shared_files(path: str):
    """The file system of a shared path and the path inside it, for tasks."""
    from pyarrow import fs

    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def put_file(path: str, write) -> None:
    """Write a file under a name of this attempt, then move it to its place; a repeated task replaces it."""
    files, inner = shared_files(path)
    files.create_dir(os.path.dirname(inner), recursive=True)
    attempt = f"{os.path.dirname(inner)}/.{os.path.basename(inner)}-{uuid.uuid4().hex}"
    with files.open_output_stream(attempt) as out:
        write(out)
    files.move(attempt, inner)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
