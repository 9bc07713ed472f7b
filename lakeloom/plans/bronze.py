"""Batch mapping of a feed to bronze tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, functions as F

from lakeloom.mapping.compiler import good_rows, map_events, rejected_rows
from lakeloom.mapping.registry import EVENT_TYPES, MAPPINGS
from lakeloom.operators.routing import quarantine_rows, table_of, with_routing_errors
from lakeloom.session import scratch_dir
from lakeloom.sinks.tables import write_partitions
from lakeloom.sinks.versions import _files
from lakeloom.sources.pointers import POINTER, pointer_of

MONTH = ["date_year", "date_month"]
TABLE, REJECTED = "_bronze_table", "_rejected"


def bronze_table(envelopes: DataFrame, name: str) -> DataFrame:
    """Good rows of one bronze table."""
    return good_rows(map_events(envelopes, MAPPINGS[name]))


def tables_present(envelopes: DataFrame, tables: list[str] | None = None) -> list[str]:
    """The bronze tables that a feed has rows for; at most one name per known event type is collected."""
    known = envelopes.filter(F.col("event_type").isin(list(EVENT_TYPES))).select("event_type").distinct()
    found = {EVENT_TYPES[row.event_type].name for row in known.collect()}
    return [name for name in (tables or list(MAPPINGS)) if name in found]


@contextmanager
def by_table(envelopes: DataFrame, tables: list[str] | None = None) -> Iterator[dict[str, DataFrame]]:
    """The envelopes of every bronze table that the feed has rows for, and under REJECTED those that cannot be used.

    The feed is decoded once, into files by table that go with the block. Each table then reads its own
    files, so a record is parsed once and read once more, however many tables there are.
    """
    spark = envelopes.sparkSession
    checked = with_routing_errors(envelopes, tables)
    name = F.when(F.size("envelope_errors") > 0, F.lit(REJECTED)).otherwise(table_of(F.col("event_type")))
    path = scratch_dir(spark, "feed")
    files, place = _files(spark, path)
    try:
        checked.withColumn(TABLE, name).write.partitionBy(TABLE).parquet(path)
        found = [s.getPath().getName() for s in files.listStatus(place) if s.isDirectory() and "=" in s.getPath().getName()]
        yield {f.split("=", 1)[1]: spark.read.schema(checked.schema).parquet(f"{path}/{f}") for f in sorted(found)}
    finally:
        files.delete(place, True)


def map_table(envelopes: DataFrame, name: str, write_good: Callable[[DataFrame], None], write_rejects: Callable[[DataFrame], None]) -> None:
    """Map one table's envelopes and write them; those that fail are mapped once more, only if there are any."""
    mapped = map_events(envelopes, MAPPINGS[name], keep=["event_type", *pointer_of(envelopes)])
    seen = Observation()
    write_good(good_rows(mapped.observe(seen, F.count_if(F.size("_errors") > 0).alias("rejected"))).drop(POINTER))
    if _any(seen, "rejected"):
        write_rejects(rejected_rows(mapped, keep=["event_type", *pointer_of(mapped)]))


def _any(seen: Observation, name: str) -> bool:
    """Whether an observed count is above zero. Adaptive execution drops the observation of a plan that turns out empty: then nothing is known."""
    try:
        return bool(seen.get[name])
    except (KeyError, Py4JJavaError):
        return True


def write_bronze(envelopes: DataFrame, root: str, *, run: str, tables: list[str] | None = None) -> None:
    """Write every bronze table of a decoded feed by month and run, and the rejects, with ``pointer`` if the feed has one.

    Rows keep their event type, as the first partition. Known types whose table is not among
    ``tables`` go to the rejects. A repeated ``run`` replaces its own rows and no others.
    """
    with by_table(envelopes, tables) as parts:
        if REJECTED in parts:
            write_partitions(quarantine_rows(parts.pop(REJECTED)).withColumn("run", F.lit(run)), f"{root}/_rejected/envelope", ["run"])
        for name, rows in parts.items():
            map_table(
                rows,
                name,
                lambda good, name=name: write_partitions(good.withColumn("run", F.lit(run)), f"{root}/{name}", ["event_type", *MONTH, "run"]),
                lambda bad, name=name: write_partitions(
                    bad.withColumns({"bronze_table": F.lit(name), "run": F.lit(run)}), f"{root}/_rejected/mapping", ["bronze_table", "run"]
                ),
            )
