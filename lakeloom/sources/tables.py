"""Table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.sinks.versions import read_table_path


def read_table(spark: SparkSession, name: str, *, database: str | None = None) -> DataFrame:
    """A catalog table."""
    return spark.read.table(f"{database}.{name}" if database else name)


def read_path(spark: SparkSession, path: str, *, fmt: str = "parquet") -> DataFrame:
    """A folder of files, or the current version of one that is written in versions."""
    return read_table_path(spark, path, fmt=fmt)


def read_month(table: DataFrame, year: int, month: int) -> DataFrame:
    """One month of a table partitioned by ``date_year`` and ``date_month``: a partition filter."""
    return table.filter((F.col("date_year") == year) & (F.col("date_month") == month))


def read_months(table: DataFrame, year: int, month: int, *, lookback_days: int = 0) -> DataFrame:
    """One month, with the month before it when a look-back reaches there."""
    if lookback_days <= 0:
        return read_month(table, year, month)
    before = (year - 1, 12) if month == 1 else (year, month - 1)
    this = (F.col("date_year") == year) & (F.col("date_month") == month)
    last = (F.col("date_year") == before[0]) & (F.col("date_month") == before[1])
    return table.filter(this | last)


def read_bronze(spark: SparkSession, root: str, table: str, *, event_types: list[str] | None = None) -> DataFrame:
    """The rows of one bronze table below ``root``; ``event_types`` is a partition filter."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/{table}")
    return rows if event_types is None else rows.filter(F.col("event_type").isin(event_types))


def read_warehouse(spark: SparkSession, table: str, *, url: str | None = None, path: str | None = None, **options: str) -> DataFrame:
    """A warehouse dimension: by JDBC when a URL is given, else a path, else the catalog."""
    if url:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    if path:
        return read_path(spark, path)
    return spark.read.table(table)


def sample(rows: DataFrame, n: int = 5) -> DataFrame:
    return rows.limit(n)
