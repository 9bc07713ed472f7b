"""Keyed joins and unions used by the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def union_streams(**streams: DataFrame) -> DataFrame:
    """Union by name of change streams, each row tagged with the ``change`` it came from."""
    tagged = [rows.withColumn("change", F.lit(name)) for name, rows in streams.items()]
    first, *others = tagged
    for other in others:
        first = first.unionByName(other)
    return first


def with_lookup(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", *, lookup_bytes: int | None = None) -> DataFrame:
    """Join a lookup; broadcast only when its stated size is small, else let Spark choose."""
    if lookup_bytes is not None and lookup_bytes <= BROADCAST_LIMIT_BYTES:
        lookup = F.broadcast(lookup)
    return rows.join(lookup, on, how)


def upserted(target: DataFrame, stage: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose keys the stage does not have, and all stage rows.

    Duplicates within the stage are kept. Null keys match nothing. The stage's keys
    are made distinct first, so a key with many copies is compared once.
    """
    replaced = stage.select(*keys).distinct()
    return target.join(replaced, keys, "left_anti").select(*target.columns).unionByName(stage.select(*target.columns))
