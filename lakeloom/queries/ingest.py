"""Queries of the ingest side: envelopes, routing, dead letters, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.texts import encode_base64, stream_event_type
from lakeloom.functions.times import iso_ms, ts_literal
from lakeloom.mapping.registry import EVENT_TYPES
from lakeloom.operators.latest import assign_batches
from lakeloom.operators.routing import (
    adherence_subset,
    feed_counts,
    latency_rows,
    raw_tee,
    split_quarantine,
    typed_feed,
)
from lakeloom.queries.base import Tables, query
from lakeloom.queries.feed import call_time_json, envelope_json, pick, pick_sql
from lakeloom.session import scratch_dir
from lakeloom.sinks.records import output_records
from lakeloom.sources.dead_letters import failed_events, read_dead_letters, records_per_file, replay_records
from lakeloom.sources.envelopes import decode_envelopes, decode_payload, delivery_records
from lakeloom.streaming.replay import in_batches

TYPES = ["sensor_event_created", "medication_updated", "patient_login", "alert_deleted", "datalake_message_deleted"]
BODY = """concat('{"k":', get_json_object(props, '$.k'), ',"v":', event_id % 50, '}')"""

# Arguments: none, a replay marker, a marker in the middle, two markers.
ARGS = """CASE event_id % 4 WHEN 0 THEN concat('["a', event_id % 5, '"]') WHEN 1 THEN '["a","replay"]'
          WHEN 2 THEN '[7,"replay",null,"b"]' ELSE CASE WHEN event_id % 3 = 0 THEN '["replay","c","replay"]' ELSE '[]' END END"""
REPLAYED = "event_id % 4 IN (1, 2) OR (event_id % 4 = 3 AND event_id % 3 = 0)"


def feed_records(t: Tables, call_time: Column | None = None) -> DataFrame:
    text = envelope_json(pick(TYPES), F.expr(BODY), ARGS, call_time)
    return t.events.select("event_id", encode_base64(text).alias("body"))


def strict_call_time() -> Column:
    return F.concat(F.lit('"'), iso_ms(F.col("ts")), F.lit('"'))


KEPT_ARGS_SQL = """CASE event_id % 4 WHEN 0 THEN 'a' || (event_id % 5) WHEN 1 THEN 'a' WHEN 2 THEN '7|~|b'
    ELSE CASE WHEN event_id % 3 = 0 THEN 'c|replay' ELSE '' END END"""


@query(
    "decode_envelope",
    f"""
    SELECT event_id, 'u' || user_id AS user_id, 'g' || (user_id % 7) AS group_id,
           strftime(CASE WHEN event_id % 3 = 2 THEN date_trunc('second', ts) ELSE ts END, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS call_time,
           {pick_sql(TYPES)} AS event_type, 'p' || event_id AS pub_sub_event_id,
           CASE event_id % 4 WHEN 0 THEN 'a' || (event_id % 5) WHEN 1 THEN 'a|replay' WHEN 2 THEN '7|replay|~|b'
                ELSE CASE WHEN event_id % 3 = 0 THEN 'replay|c|replay' ELSE '' END END AS args,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(event_id % 50 AS INTEGER) AS v, 0 AS problems
    FROM events
    """,
)
def decode(t: Tables) -> DataFrame:
    return decode_envelopes(feed_records(t), "body", keep=["event_id"]).select(
        "event_id",
        "user_id",
        "group_id",
        iso_ms(F.col("call_ts")).alias("call_time"),
        "event_type",
        "pub_sub_event_id",
        F.array_join("args", "|", "~").alias("args"),
        F.try_variant_get("payload", "$.body.k", "int").alias("k"),
        F.try_variant_get("payload", "$.body.v", "int").alias("v"),
        F.size("envelope_errors").alias("problems"),
    )


@query(
    "replay_suppress",
    f"SELECT 'p' || event_id AS pub_sub_event_id, {pick_sql(TYPES)} AS event_type FROM events WHERE NOT ({REPLAYED})",
)
def suppressed(t: Tables) -> DataFrame:
    return typed_feed(decode_envelopes(feed_records(t), "body")).select("pub_sub_event_id", "event_type")


@query(
    "raw_tee",
    f"""
    SELECT event_id, {pick_sql(TYPES)} AS event_type, {KEPT_ARGS_SQL} AS args, '1' AS version,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           CASE event_id % 4 WHEN 0 THEN '["a' || (event_id % 5) || '"]' WHEN 1 THEN '["a"]' WHEN 2 THEN '[7,null,"b"]'
                ELSE CASE WHEN event_id % 3 = 0 THEN '["c","replay"]' ELSE '[]' END END AS args_json
    FROM events
    """,
)
def raw(t: Tables) -> DataFrame:
    tee = raw_tee(decode_payload(feed_records(t), "body"), keep=["event_id"])
    return tee.select(
        "event_id",
        "event_type",
        F.array_join("args", "|", "~").alias("args"),
        F.get_json_object("payload_json", "$.version").alias("version"),
        F.get_json_object("payload_json", "$.body.k").cast("int").alias("k"),
        F.get_json_object("payload_json", "$.pubSubArgs").alias("args_json"),
    )


@query(
    "adherence_subset",
    f"""
    SELECT 'p' || event_id AS id, {pick_sql(TYPES)} AS event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events WHERE event_id % 5 IN (0, 1, 4) AND NOT ({REPLAYED})
    """,
)
def adherence(t: Tables) -> DataFrame:
    return adherence_subset(decode_payload(feed_records(t), "body")).select(
        "id", "event_type", F.get_json_object("message", "$.body.k").cast("int").alias("k")
    )


RECEIVED = "2024-02-10T12:34:56.789012Z"


@query(
    "latency_metric",
    f"""
    WITH m AS (SELECT event_id, {pick_sql(TYPES)} AS event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_datetime,
        epoch_us(TIMESTAMP '2024-02-10 12:34:56.789012') - epoch_us(date_trunc('milliseconds', ts)) AS us FROM events)
    SELECT event_type, created_datetime, '2024-02-10T12:34:56.789012Z' AS received_datetime, us / 1000000.0::DOUBLE AS latency,
           (us % 86400000000) // 1000000 + (us % 1000000) / 1000000.0::DOUBLE AS latency_in_day
    FROM m
    """,
)
def latency(t: Tables) -> DataFrame:
    return latency_rows(decode_envelopes(feed_records(t, strict_call_time()), "body"), ts_literal(RECEIVED))


@query(
    "fanout_counts",
    f"""
    SELECT {pick_sql(TYPES)} AS event_type, count(*) AS raw, count(*) FILTER (NOT ({REPLAYED})) AS typed,
           count(*) FILTER (event_id % 5 IN (0, 1, 4) AND NOT ({REPLAYED})) AS adherence, count(*) AS latency
    FROM events GROUP BY ALL
    """,
)
def counts(t: Tables) -> DataFrame:
    return feed_counts(decode_envelopes(feed_records(t), "body"))


# Damaged records: not base64, not JSON, no body, bad call time, unknown type. One of
# the five types of the feed has no mapping, so it is unknown as well.


def damaged_records(t: Tables) -> DataFrame:
    text = envelope_json(pick(TYPES), F.expr(BODY), ARGS)
    e = F.col("event_id") % 11
    text = F.when(e == 1, F.lit("{not json")).when(e == 2, F.regexp_replace(text, '"body":', '"corpus":')).otherwise(text)
    text = F.when(e == 3, F.regexp_replace(text, r'"callTime":("[^"]*"|\d+)', '"callTime":"yesterday"')).otherwise(text)
    text = F.when(e == 4, F.regexp_replace(text, r'"pubSubEvent":"\w+"', '"pubSubEvent":"mystery"')).otherwise(text)
    data = F.when(e == 5, F.lit("###")).otherwise(encode_base64(text))
    return t.events.select("event_id", data.alias("body"))


@query(
    "quarantine_good",
    "SELECT 'p' || event_id AS pub_sub_event_id FROM events WHERE event_id % 11 NOT IN (1, 2, 3, 4, 5) AND event_id % 5 <> 4",
)
def quarantine_good(t: Tables) -> DataFrame:
    good, _ = split_quarantine(decode_envelopes(damaged_records(t), "body"))
    return good.select("pub_sub_event_id")


@query(
    "quarantine_bad",
    """
    SELECT CASE WHEN event_id % 11 NOT IN (1, 5) THEN 'p' || event_id END AS pub_sub_event_id,
           concat_ws(';', CASE WHEN event_id % 11 IN (1, 5) THEN 'payload: not base64 JSON' END,
                     CASE event_id % 11 WHEN 2 THEN 'missing: body' WHEN 3 THEN 'format: callTime' END,
                     CASE WHEN event_id % 11 IN (1, 4, 5) OR event_id % 5 = 4 THEN 'unknown event type' END) AS errors
    FROM events WHERE event_id % 11 IN (1, 2, 3, 4, 5) OR event_id % 5 = 4
    """,
)
def quarantine_bad(t: Tables) -> DataFrame:
    _, bad = split_quarantine(decode_envelopes(damaged_records(t), "body"))
    return bad.select("pub_sub_event_id", F.array_join("errors", ";").alias("errors"))


ALL_TYPES = sorted(EVENT_TYPES)


@query(
    "route_event_types",
    f"""
    SELECT {pick_sql([*ALL_TYPES, 'mystery'])} AS event_type, count(*) AS events FROM events
    WHERE event_id % {len(ALL_TYPES) + 1} <> {len(ALL_TYPES)} GROUP BY ALL
    """,
)
def routed(t: Tables) -> DataFrame:
    """Every known event type finds its mapping; unknown types are left to the quarantine."""
    text = envelope_json(pick([*ALL_TYPES, "mystery"]), F.expr(BODY), ARGS)
    records = t.events.select(encode_base64(text).alias("body"))
    good, _ = split_quarantine(decode_envelopes(records, "body"))
    return good.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query(
    "delivery_batches",
    """
    SELECT 'i' || o_orderkey AS invocation_id, replace(lower(o_orderpriority[3:]), ' ', '_') AS stream_event_type,
           'r' || n AS record_id, CASE n WHEN 1 THEN o_custkey ELSE o_orderkey END AS part
    FROM orders CROSS JOIN (SELECT unnest([1, 2]) AS n)
    """,
)
def batches(t: Tables) -> DataFrame:
    """Delivery batches of two nested records; the stream's name ends with the event type."""

    def record(name: str, key: str) -> Column:
        data = encode_base64(F.concat(F.lit('{"part":'), F.col(key), F.lit("}")))
        return F.struct(F.lit(name).alias("recordId"), data.alias("data"))

    priority = F.regexp_replace(F.lower(F.substring("o_orderpriority", 3, 100)), " ", "_")
    sent = t.orders.select(
        F.concat(F.lit("i"), "o_orderkey").alias("invocationId"),
        F.concat(F.lit("arn:x:y/stream-eu-"), priority).alias("deliveryStreamArn"),
        F.array(record("r1", "o_custkey"), record("r2", "o_orderkey")).alias("records"),
    )
    rows = decode_payload(delivery_records(sent))
    return rows.select(
        "invocation_id", "stream_event_type", "record_id", F.try_variant_get("payload", "$.part", "bigint").alias("part")
    )


@query(
    "output_records",
    """
    SELECT 'r' || event_id AS "recordId", 'Ok' AS result,
           base64(encode('{"event_id":' || event_id || ',"event_type":"' || event_type || '","ts":"'
               || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"}')) AS data
    FROM events
    """,
)
def encoded(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", iso_ms(F.col("ts")).alias("ts"))
    return output_records(rows, F.concat(F.lit("r"), "event_id"))


@query("stream_names", "SELECT event_id, event_type FROM events")
def stream_names(t: Tables) -> DataFrame:
    arn = F.concat(F.lit("arn:aws:firehose:eu:1:deliverystream/x-"), "event_type")
    return t.events.select("event_id", stream_event_type(arn).alias("event_type"))


@query(
    "send_batches",
    """
    SELECT event_id, event_type, CAST(date_trunc('day', ts) AS DATE)::VARCHAR AS day,
           (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 100 AS batch
    FROM events
    """,
)
def numbered_batches(t: Tables) -> DataFrame:
    """Batches of 100 per event type in time order, from slices of equal size."""
    rows = assign_batches(t.events, ["event_type"], ["ts", "event_id"], size=100)
    return rows.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "batch")


# Error files: one folder per failed feed, blank lines between the rows.


def error_files(t: Tables) -> str:
    """Write all events as error files; returns their root."""
    root = scratch_dir(t.spark, "errors")
    line = F.concat(F.lit('{"attempts":4,"rawData":"'), F.col("body"), F.lit('"}\n'))
    rows = t.events.select(
        F.concat(pick(TYPES), F.lit("processing-failed")).alias("failed"),
        encode_base64(envelope_json(pick(TYPES), F.expr(BODY), ARGS, call_time_json())).alias("body"),
    )
    # ``failed=<name>processing-failed`` folders; the name is what precedes the suffix
    rows.select("failed", line.alias("value")).write.partitionBy("failed").text(root)
    return root


FAILED_SQL = f"'failed=' || {pick_sql(TYPES)}"


@query(
    "dead_letter_replay",
    f"""
    SELECT {FAILED_SQL} AS failed_event, {pick_sql(TYPES)} AS event_type, {FAILED_SQL} || '-retry' AS feed,
           'p' || event_id AS id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events
    """,
)
def replayed(t: Tables) -> DataFrame:
    letters = read_dead_letters(t.spark, error_files(t))
    return replay_records(letters).select(
        "failed_event",
        "event_type",
        "feed",
        F.get_json_object("data", "$.pubSubEventId").alias("id"),
        F.get_json_object("data", "$.body.k").cast("int").alias("k"),
    )


@query(
    "dead_letter_counts",
    f"SELECT {FAILED_SQL} AS failed_event, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY ALL",
)
def letter_counts(t: Tables) -> DataFrame:
    per_file = records_per_file(read_dead_letters(t.spark, error_files(t)))
    return per_file.groupBy("failed_event").agg(F.sum("records").alias("records"))


@query("dead_letter_events", f"SELECT DISTINCT {FAILED_SQL} AS failed_event FROM events")
def letter_events(t: Tables) -> DataFrame:
    return failed_events(read_dead_letters(t.spark, error_files(t)))


@query(
    "dead_letter_batches",
    f"""
    SELECT {pick_sql(TYPES)} AS event_type, count(*) AS records, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS gaps
    FROM events GROUP BY ALL
    """,
)
def letter_batches(t: Tables) -> DataFrame:
    """Replay batches of 100 per file and type: none too large, only a file's last one short."""
    records = in_batches(replay_records(read_dead_letters(t.spark, error_files(t))).drop("payload"))
    sizes = records.groupBy("file", "event_type", "batch").agg(F.count(F.lit(1)).alias("size"))
    per_file = sizes.groupBy("file", "event_type").agg(
        F.sum("size").alias("records"),
        F.count_if(F.col("size") > 100).alias("overfull"),
        (F.max("batch") + 1 - F.ceil(F.sum("size") / 100)).alias("gap"),
    )
    return per_file.groupBy("event_type").agg(
        F.sum("records").alias("records"),
        F.sum("overfull").alias("overfull"),
        F.sum(F.abs("gap")).cast("bigint").alias("gaps"),
    )
