"""Registration of queries with their SQL checks, and readers of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeloom.session import in_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the check on the same tables."""

    def add(fn: Callable[["Tables"], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(in_utc(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


class Tables:
    """The given tables of one scale."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def events(self) -> DataFrame:
        raw = self.spark.read.parquet(f"{self.sf_dir}/events.parquet")
        return raw.withColumn("ts", F.col("ts").cast("timestamp"))

    @property
    def orders(self) -> DataFrame:
        raw = self.spark.read.parquet(f"{self.sf_dir}/orders.parquet")
        return raw.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))


ISO_US = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SQL_ISO_US = "%Y-%m-%dT%H:%M:%S.%f"


def iso_us(column: str):
    return F.date_format(column, ISO_US)
