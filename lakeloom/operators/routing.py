"""Routing of decoded envelopes: typed feeds, raw tee, adherence subset, latency, quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.nested import remove_first
from lakeloom.functions.times import ISO_US_FORMAT, iso_ms
from lakeloom.mapping.registry import EVENT_TYPES
from lakeloom.sources.pointers import pointer_of

REPLAY = "replay"

# The events whose payloads the adherence consumer wants.
ADHERENCE_TYPES = [
    "sensor_event_created",
    "sensor_event_updated",
    "sensor_event_deleted",
    "medication_created",
    "medication_updated",
    "medication_deleted",
    "datalake_message_created",
    "datalake_message_updated",
    "datalake_message_deleted",
]

DAY_MICROS = 86_400_000_000


def is_replay(args: Column | None = None) -> Column:
    args = F.col("args") if args is None else args
    return F.coalesce(F.array_contains(args, REPLAY), F.lit(False))


def typed_feed(envelopes: DataFrame) -> DataFrame:
    """What goes to the per-type feeds: everything that is not a replay."""
    return envelopes.filter(~is_replay())


def raw_payload(payload: Column) -> Column:
    """The payload as JSON text, its first ``replay`` argument removed, all else kept."""
    args = F.try_variant_get(payload, "$.pubSubArgs", "array<variant>")
    texts = F.try_variant_get(payload, "$.pubSubArgs", "array<string>")
    kept = F.parse_json(F.to_json(remove_first(args, texts, REPLAY)))
    keys = F.try_variant_get(payload, "$", "map<string,variant>")
    changed = F.transform_values(keys, lambda k, v: F.when(k == "pubSubArgs", kept).otherwise(v))
    return F.when(F.array_contains(texts, REPLAY), F.to_json(changed)).otherwise(F.to_json(payload))


def raw_tee(records: DataFrame, payload: str = "payload", *, keep=()) -> DataFrame:
    """Every record with its event type, arguments and decoded payload; replays included."""
    value = F.col(payload)
    args = F.try_variant_get(value, "$.pubSubArgs", "array<string>")
    return records.select(
        *keep,
        F.try_variant_get(value, "$.pubSubEvent", "string").alias("event_type"),
        remove_first(args, args, REPLAY).alias("args"),
        raw_payload(value).alias("payload_json"),
    )


def adherence_subset(records: DataFrame, payload: str = "payload") -> DataFrame:
    """``(id, message)`` of the adherence events that are not replays."""
    value = F.col(payload)
    event_type = F.try_variant_get(value, "$.pubSubEvent", "string")
    args = F.try_variant_get(value, "$.pubSubArgs", "array<string>")
    return records.filter(event_type.isin(ADHERENCE_TYPES) & ~is_replay(args)).select(
        F.try_variant_get(value, "$.pubSubEventId", "string").alias("id"),
        event_type.alias("event_type"),
        F.to_json(value).alias("message"),
    )


def latency_rows(envelopes: DataFrame, received: Column) -> DataFrame:
    """Seconds between an event and its reception, in full and without whole days."""
    micros = F.unix_micros(received.cast("timestamp")) - F.unix_micros(F.col("call_ts"))
    in_day = F.pmod(micros, F.lit(DAY_MICROS))
    return envelopes.select(
        "event_type",
        F.col("call_time_text").alias("created_datetime"),
        F.date_format(received.cast("timestamp"), ISO_US_FORMAT).alias("received_datetime"),
        (micros / F.lit(1_000_000)).alias("latency"),
        (F.floor(in_day / 1_000_000) + F.pmod(in_day, F.lit(1_000_000)) / F.lit(1_000_000)).alias("latency_in_day"),
    )


def known_type(event_type: Column | None = None) -> Column:
    event_type = F.col("event_type") if event_type is None else event_type
    return F.coalesce(event_type.isin(list(EVENT_TYPES)), F.lit(False))


def with_routing_errors(envelopes: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """Envelope errors plus ``unknown event type``, and ``table not listed`` for types of other tables than ``tables``."""
    extra = [F.when(~known_type(), F.lit("unknown event type"))]
    if tables is not None:
        listed = [t for t, m in EVENT_TYPES.items() if m.name in tables]
        extra.append(F.when(known_type() & ~F.col("event_type").isin(listed), F.lit("table not listed")))
    return envelopes.withColumn(
        "envelope_errors", F.concat(F.col("envelope_errors"), F.array_compact(F.array(*extra)))
    )


def split_quarantine(envelopes: DataFrame, tables: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Usable envelopes, and the ids and reasons of the others, with the pointers to their records if there are any."""
    checked = with_routing_errors(envelopes, tables)
    return checked.filter(F.size("envelope_errors") == 0), quarantine_rows(checked.filter(F.size("envelope_errors") > 0))


def quarantine_rows(failed: DataFrame) -> DataFrame:
    """Ids and reasons of envelopes that cannot be used."""
    return failed.select(
        *pointer_of(failed),
        "user_id",
        "group_id",
        iso_ms(F.col("call_ts")).alias("call_time"),
        "pub_sub_event_id",
        "event_type",
        F.col("envelope_errors").alias("errors"),
    )


def table_of(event_type: Column) -> Column:
    """The bronze table that an event type goes to; null for unknown types."""
    known = F.create_map(*[F.lit(x) for t, m in EVENT_TYPES.items() for x in (t, m.name)])
    return F.try_element_at(known, event_type)


def feed_counts(envelopes: DataFrame) -> DataFrame:
    """Rows per event type for every feed."""
    return envelopes.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(~is_replay()).alias("typed"),
        F.count_if(~is_replay() & F.col("event_type").isin(ADHERENCE_TYPES)).alias("adherence"),
        F.count(F.lit(1)).alias("latency"),
    )
