"""Current state of subgroups from their change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakeloom.functions.times import parse_any_ts
from lakeloom.operators.conform import ErrorBudget, conform_within, split_contract
from lakeloom.operators.joins import union_streams
from lakeloom.sinks.publish import Report, publish
from lakeloom.sources.tables import read_bronze

SCHEMA = T.StructType(
    [
        T.StructField("subgroup_id", T.StringType(), False),
        T.StructField("subgroup_name", T.StringType()),
        T.StructField("subgroup_display_name", T.StringType()),
        T.StructField("subgroup_type", T.StringType()),
        T.StructField("deleted", T.BooleanType(), False),
        T.StructField("ph_group_id", T.StringType(), False),
        T.StructField("created_datetime", T.TimestampType(), False),
        T.StructField("deleted_datetime", T.TimestampType()),
        T.StructField("datetime_modified", T.TimestampType()),
    ]
)


def current_state(
    changes: DataFrame,
    key: str,
    *,
    at: Column,
    order: list[str],
    carry: list[str],
) -> DataFrame:
    """Latest change per key with the dates of its creation and deletion.

    ``changes`` has a ``change`` column: created, updated or deleted. The latest row,
    the earliest creation and the latest deletion come out of one aggregation, so the
    change streams are shuffled once. A key that was ever deleted stays deleted.
    """
    stamped = changes.withColumn("_at", at)
    latest = F.max_by(F.struct("_at", *carry), F.struct("_at", *order)).alias("latest")
    created = F.min(F.when(F.col("change") == "created", F.col("_at"))).alias("created_datetime")
    deleted = F.max(F.when(F.col("change") == "deleted", F.col("_at"))).alias("deleted_datetime")
    ever = F.bool_or(F.col("change") == "deleted").alias("deleted")
    return (
        stamped.groupBy(key)
        .agg(latest, created, deleted, ever)
        .select(
            key,
            *[F.col("latest")[c].alias(c) for c in carry],
            "deleted",
            "created_datetime",
            "deleted_datetime",
            F.col("latest")["_at"].alias("datetime_modified"),
        )
    )


def dim_subgroup(created: DataFrame, updated: DataFrame, deleted: DataFrame, *, region: str) -> DataFrame:
    """One row per subgroup."""
    state = current_state(
        union_streams(created=created, updated=updated, deleted=deleted),
        "subgroup_id",
        at=parse_any_ts(F.col("call_time")),
        order=["pub_sub_event_id"],
        carry=["name", "display_name", "type", "group_id"],
    )
    return state.select(
        "subgroup_id",
        F.col("name").alias("subgroup_name"),
        F.col("display_name").alias("subgroup_display_name"),
        F.col("type").alias("subgroup_type"),
        "deleted",
        F.col("group_id").alias("ph_group_id"),
        "created_datetime",
        "deleted_datetime",
        "datetime_modified",
        F.lit(region).alias("region"),
    )


#: The table: the dimension's columns and the region it is from.
TABLE = T.StructType([*SCHEMA.fields, T.StructField("region", T.StringType())])


def checked(dimension: DataFrame, budget: ErrorBudget = ErrorBudget()) -> tuple[DataFrame, DataFrame]:
    """Conform to the schema within the budget, then split off rows that break the contract."""
    return split_contract(conform_within(dimension, TABLE, budget), TABLE)


def populate(
    created: DataFrame, updated: DataFrame, deleted: DataFrame, target: str, *, region: str, budget: ErrorBudget = ErrorBudget(), rejects: str | None = None
) -> Report:
    """The whole job: current state from the change events, upserted into the table by subgroup."""
    return publish(dim_subgroup(created, updated, deleted, region=region), target, TABLE, keys=["subgroup_id"], budget=budget, rejects=rejects)


def populate_from_bronze(spark: SparkSession, root: str, target: str, *, region: str, budget: ErrorBudget = ErrorBudget(), rejects: str | None = None) -> Report:
    """The job over the bronze table of subgroups, one event type, which is a partition, per change stream."""
    created, updated, deleted = (read_bronze(spark, root, "subgroup", event_types=[f"subgroup_{kind}"]) for kind in ("created", "updated", "deleted"))
    return populate(created, updated, deleted, target, region=region, budget=budget, rejects=rejects)
