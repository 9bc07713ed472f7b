"""Event envelopes: base64(JSON) records decoded to fixed columns and a VARIANT payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.nested import compute_once, has_key
from lakeloom.functions.texts import decode_base64, stream_event_type
from lakeloom.functions.times import parse_any_ts

#: Columns every decoded envelope has, besides the columns of the record it came in.
ENVELOPE_COLUMNS = [
    "user_id",
    "group_id",
    "call_time_text",
    "call_ts",
    "event_type",
    "pub_sub_event_id",
    "args",
    "payload",
    "envelope_errors",
]

# Envelope keys that must be present.
REQUIRED_KEYS = ["userId", "groupId", "callTime", "pubSubEventId", "pubSubArgs", "body"]


def decode_payload(records: DataFrame, column: str = "data", *, into: str = "payload") -> DataFrame:
    """Add the decoded JSON as a VARIANT; null where the record is not base64(JSON)."""
    return compute_once(records, into, F.try_parse_json(decode_base64(F.col(column))))


def decode_envelopes(records: DataFrame, column: str = "data", *, keep=(), event_type: Column | None = None) -> DataFrame:
    """Decode base64(JSON) records to envelope columns.

    ``keep`` names record columns to carry along. ``event_type`` overrides the type
    written in the payload, for feeds whose name gives the type.
    """
    return envelope_columns(decode_payload(records, column), keep=keep, event_type=event_type)


def envelope_columns(records: DataFrame, *, payload: str = "payload", keep=(), event_type: Column | None = None) -> DataFrame:
    """Envelope columns of an already parsed payload."""
    value = F.col(payload)

    def text(key: str) -> Column:
        return F.try_variant_get(value, f"$.{key}", "string")

    call_time = text("callTime")
    call_ts = parse_any_ts(call_time)
    args = string_args(value)
    # the body is left where it is: taking it out of the payload would copy it
    body = F.try_variant_get(value, "$.body", "struct<_:string>")
    read = {key: text(key) for key in REQUIRED_KEYS} | {"pubSubArgs": args, "body": body}
    # a null column is cheap to see; the VARIANT is asked only then whether the key is missing
    problems = [F.when(value.isNull(), F.lit("payload: not base64 JSON"))]
    problems += [
        F.when(value.isNotNull() & read[key].isNull() & ~has_key(value, f"$.{key}"), F.lit(f"missing: {key}"))
        for key in REQUIRED_KEYS
    ]
    problems.append(F.when(call_ts.isNull() & has_key(value, "$.callTime"), F.lit("format: callTime")))
    return records.select(
        *keep,
        text("userId").alias("user_id"),
        text("groupId").alias("group_id"),
        call_time.alias("call_time_text"),
        call_ts.alias("call_ts"),
        (text("pubSubEvent") if event_type is None else event_type).alias("event_type"),
        text("pubSubEventId").alias("pub_sub_event_id"),
        args.alias("args"),
        value.alias("payload"),
        F.array_compact(F.array(*problems)).alias("envelope_errors"),
    )


def string_args(payload: Column, path: str = "$.pubSubArgs") -> Column:
    """The argument list with every non-null element as text."""
    return F.try_variant_get(payload, path, "array<string>")


def delivery_records(batches: DataFrame) -> DataFrame:
    """Rows of delivery batches: one per record, with the event type of the stream's name."""
    return batches.select(
        F.col("invocationId").alias("invocation_id"),
        stream_event_type(F.col("deliveryStreamArn")).alias("stream_event_type"),
        F.explode("records").alias("record"),
    ).select("invocation_id", "stream_event_type", F.col("record.recordId").alias("record_id"), F.col("record.data").alias("data"))
