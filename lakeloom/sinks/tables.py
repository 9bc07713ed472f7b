"""Table writers: partitions, full refresh, keyed upsert, stale partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.sinks import versions
from lakeloom.sinks.versions import MAX_RECORDS_PER_FILE, Version, replace


def write_partitions(rows: DataFrame, path: str, keys: list[str], *, fmt: str = "parquet") -> None:
    """Overwrite only the partitions present in ``rows``.

    The rebalance hint groups rows by partition and splits the large ones, so a
    partition that holds much of the data becomes several files written in parallel.
    """
    (
        rows.hint("rebalance", *keys)
        .write.mode("overwrite")
        .format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*keys)
        .save(path)
    )


def partitions_of(table: DataFrame, keys: list[str]) -> DataFrame:
    """Partition keys that exist; on partitioned files only the keys are read."""
    return table.select(*keys).distinct()


def stale_partitions(table: DataFrame, fresh: DataFrame, keys: list[str], *, year: int, month: int) -> DataFrame:
    """Partitions of the month that the table has and the new output does not."""
    of_month = table.filter((F.col("date_year") == year) & (F.col("date_month") == month))
    return partitions_of(of_month, keys).join(fresh.select(*keys).distinct(), keys, "left_anti")


def drop_partitions(spark: SparkSession, table: str, stale: DataFrame, keys: list[str]) -> int:
    """Remove stale partitions of a catalog table; returns how many.

    A separate step on purpose. Only partition keys reach the driver, one at a time.
    """
    dropped = 0
    for row in stale.select(*keys).toLocalIterator():
        spec = ", ".join(f"{k} = {_sql_literal(row[k])}" for k in keys)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        dropped += 1
    return dropped


def _sql_literal(value) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def full_refresh(rows: DataFrame, target: str, *, fmt: str = "parquet") -> None:
    """Replace a table's content; ``rows`` may read it. Partition columns and their types are kept.

    The new files lie beside the old ones and count once a pointer names them (``versions``), so
    nothing is moved and a job that dies at any point leaves the old content.
    """
    replace(rows, target, fmt=fmt)


def refresh_table(rows: DataFrame, table: str, *, fmt: str = "parquet") -> None:
    """Replace a catalog table; ``rows`` may read it.

    The rows are written to a folder of their own. A table with the same columns is then pointed to it,
    which is one call to the catalog, so there is no moment without the table; its old files stay until
    they are deleted by hand, as readers may still use them. Otherwise the table is created anew, or
    dropped and created.
    """
    spark = rows.sparkSession
    place = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}__{uuid.uuid4().hex}"
    rows.write.format(fmt).save(place)
    known = spark.table(table).schema if spark.catalog.tableExists(table) else None
    if known is not None and [(f.name, f.dataType) for f in known] == [(f.name, f.dataType) for f in rows.schema] and not _is_partitioned(spark, table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_sql_literal(place)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=place, source=fmt, schema=rows.schema)
    spark.catalog.refreshTable(table)


def _is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def upsert(target_path: str, stage: DataFrame, keys: list[str], *, fmt: str = "parquet") -> Version:
    """Delete the target rows that match the stage on all keys, insert all stage rows.

    Only partitions with a row to delete are written again.
    """
    return versions.upsert(target_path, stage, keys, fmt=fmt)
