"""Queries of sinks, sources and streams: written below the scratch folder and read back."""

from __future__ import annotations

import json
import os
import uuid
import zlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from lakeloom.functions.nested import flatten_map, lon_lat, non_empty, remove_first, string_map, truthy
from lakeloom.functions.texts import csv_rows, encode_base64
from lakeloom.functions.times import Period, hour_of, ts_literal
from lakeloom.operators.joins import union_streams, upserted, with_lookup
from lakeloom.plans.bronze import write_bronze
from lakeloom.queries.base import Tables, query
from lakeloom.queries.bronze import shown
from lakeloom.queries.feed import pick_sql, records, sometimes as S, source_sql
from lakeloom.queries.ingest import (
    FAILED_SQL, KEPT_ARGS_SQL, REPLAYED, TYPES, damaged_records, error_files, feed_records, strict_call_time,
)
from lakeloom.session import scratch_dir
from lakeloom.sinks.tables import full_refresh, partitions_of, stale_partitions, upsert, write_partitions
from lakeloom.sinks.versions import replace
from lakeloom.sources.dead_letters import read_dead_letters
from lakeloom.sources.envelopes import decode_envelopes
from lakeloom.sources.landing import landing_path, read_landing
from lakeloom.sources.pointers import records_of, with_pointer
from lakeloom.sources.tables import read_bronze, read_month, read_months, read_path, read_table, read_warehouse
from lakeloom.streaming.bronze import start_bronze
from lakeloom.streaming.fanout import start_fanout
from lakeloom.streaming.names import stream_name
from lakeloom.streaming.once import merge_ledger, start_once
from lakeloom.streaming.replay import read_new, start_replay

CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

# Stage of the upsert: customers in debt are changed twice, rich ones come back under a new key.
STAGE_SQL = """
    SELECT c_custkey, c_name || '*' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT c_custkey, c_name || '**' AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT c_custkey + 100000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal > 9000
"""
UPSERT_SQL = f"""
    SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM ({STAGE_SQL}))
    UNION ALL SELECT * FROM ({STAGE_SQL})
"""


def _stage(t: Tables) -> DataFrame:
    debt = t.customer.filter(F.col("c_acctbal") < 0)
    rich = t.customer.filter(F.col("c_acctbal") > 9000)
    return (
        debt.withColumn("c_name", F.concat("c_name", F.lit("*")))
        .unionByName(debt.withColumn("c_name", F.concat("c_name", F.lit("**"))))
        .unionByName(rich.withColumn("c_custkey", F.col("c_custkey") + 100000000))
    )


@query("keyed_upsert", UPSERT_SQL)
def upsert_rows(t: Tables) -> DataFrame:
    return upserted(t.customer, _stage(t), ["c_custkey"])


@query("upsert_table", UPSERT_SQL)
def upsert_files(t: Tables) -> DataFrame:
    """The upsert written to a table, twice: the second time changes nothing."""
    path = scratch_dir(t.spark, "customer")
    t.customer.write.parquet(path)
    upsert(path, _stage(t), ["c_custkey"])
    upsert(path, _stage(t), ["c_custkey"])
    return read_path(t.spark, path)


@query("full_refresh", "SELECT s_suppkey, s_name, s_acctbal * 2 AS s_acctbal FROM supplier")
def refreshed(t: Tables) -> DataFrame:
    """A table replaced by a result computed from itself."""
    path = scratch_dir(t.spark, "supplier")
    t.supplier.select("s_suppkey", "s_name", "s_acctbal").write.parquet(path)
    old = t.spark.read.parquet(path)
    full_refresh(old.withColumn("s_acctbal", F.col("s_acctbal") * 2), path)
    return read_path(t.spark, path)


def _dated_orders(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderstatus").alias("group_id"),
        F.year(day).alias("date_year"),
        F.month(day).alias("date_month"),
        "o_totalprice",
    )


DATED_SQL = """(SELECT o_orderkey, o_orderstatus AS group_id, CAST(year(o_orderdate) AS INTEGER) AS date_year,
    CAST(month(o_orderdate) AS INTEGER) AS date_month, o_totalprice FROM orders)"""
PARTITIONS = ["group_id", "date_year", "date_month"]


@query(
    "partition_overwrite",
    f"""
    SELECT o_orderkey, o_totalprice, group_id, date_year, date_month FROM {DATED_SQL} WHERE NOT (date_year = 1996 AND group_id = 'F')
    UNION ALL
    SELECT o_orderkey, -o_totalprice, group_id, date_year, date_month FROM {DATED_SQL} WHERE date_year = 1996 AND group_id = 'F'
    """,
)
def overwritten(t: Tables) -> DataFrame:
    """All partitions written, then those of one year and group again."""
    path = scratch_dir(t.spark, "orders")
    rows = _dated_orders(t)
    write_partitions(rows, path, PARTITIONS)
    some = rows.filter((F.col("date_year") == 1996) & (F.col("group_id") == "F"))
    write_partitions(some.withColumn("o_totalprice", -F.col("o_totalprice")), path, PARTITIONS)
    return read_path(t.spark, path)


@query("read_month", f"SELECT * FROM {DATED_SQL} WHERE date_year = 1997 AND date_month = 5")
def one_month(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "orders")
    write_partitions(_dated_orders(t), path, PARTITIONS)
    return read_month(read_path(t.spark, path), 1997, 5)


@query(
    "read_month_with_lookback",
    f"SELECT * FROM {DATED_SQL} WHERE (date_year = 1997 AND date_month = 1) OR (date_year = 1996 AND date_month = 12)",
)
def two_months(t: Tables) -> DataFrame:
    return read_months(_dated_orders(t), 1997, 1, lookback_days=2)


@query(
    "stale_partitions",
    f"""
    SELECT DISTINCT group_id, date_year, date_month FROM {DATED_SQL} WHERE date_year = 1996 AND date_month = 3
    EXCEPT SELECT group_id, date_year, date_month FROM {DATED_SQL} WHERE group_id <> 'P'
    """,
)
def stale(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "orders")
    rows = _dated_orders(t)
    write_partitions(rows, path, PARTITIONS)
    fresh = rows.filter(F.col("group_id") != "P")
    return stale_partitions(read_path(t.spark, path), fresh, PARTITIONS, year=1996, month=3)


@query("table_partitions", f"SELECT DISTINCT group_id, date_year, date_month FROM {DATED_SQL}")
def existing_partitions(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "orders")
    write_partitions(_dated_orders(t), path, PARTITIONS)
    return partitions_of(read_path(t.spark, path), PARTITIONS)


@query(
    "period_bounds",
    """
    SELECT o_orderkey, o_orderdate >= TIMESTAMP '2000-02-01' AND o_orderdate <= TIMESTAMP '2000-02-29 23:59:59.999999' AS inside
    FROM orders
    """,
)
def period(t: Tables) -> DataFrame:
    month = Period.of(2000, 2)
    return t.orders.select("o_orderkey", F.col("o_orderdate").between(month.begin_col(), month.end_col()).alias("inside"))


@query(
    "landing_read",
    """
    SELECT n.n_nationkey, n.n_name, r.r_name, CAST(c_custkey AS BIGINT) AS c_custkey FROM nation n JOIN region r ON n_regionkey = r_regionkey
    JOIN customer ON c_nationkey = n_nationkey
    """,
)
def landing(t: Tables) -> DataFrame:
    """Parquet and CSV components of two systems, one of them below a level."""
    root = scratch_dir(t.spark, "landing")
    t.nation.write.parquet(landing_path(root, "crm", "nation"))
    t.region.write.option("header", "true").csv(landing_path(root, "erp", "region", level="l1", fmt="csv"))
    t.customer.select("c_custkey", "c_nationkey").write.option("header", "true").csv(landing_path(root, "crm", "customer", fmt="csv"))
    nation = read_landing(t.spark, root, "crm", "nation")
    region = read_landing(t.spark, root, "erp", "region", level="l1", fmt="csv")
    customer = read_landing(t.spark, root, "crm", "customer", fmt="csv", schema="c_custkey bigint, c_nationkey int")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name", "c_custkey")


@query("read_tables", "SELECT s_suppkey AS k, s_name AS name FROM supplier UNION ALL SELECT c_custkey, c_name FROM customer UNION ALL SELECT p_partkey, p_name FROM part")
def tables(t: Tables) -> DataFrame:
    """A catalog view, a bronze path and a warehouse path."""
    root = scratch_dir(t.spark, "bronze")
    t.customer.write.parquet(f"{root}/customer")
    t.part.write.parquet(f"{root}/part")
    t.supplier.createOrReplaceTempView("lakeloom_supplier")
    supplier = read_table(t.spark, "lakeloom_supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    customer = read_bronze(t.spark, root, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    part = read_warehouse(t.spark, "part", path=f"{root}/part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    return supplier.unionByName(customer).unionByName(part)


@query(
    "union_change_streams",
    """
    SELECT CASE event_type WHEN 'signup' THEN 'created' WHEN 'click' THEN 'updated' ELSE 'deleted' END AS change, event_id
    FROM events WHERE event_type IN ('signup', 'click', 'error')
    """,
)
def streams(t: Tables) -> DataFrame:
    def of(kind: str) -> DataFrame:
        return t.events.filter(F.col("event_type") == kind).select("event_id")

    return union_streams(created=of("signup"), updated=of("click"), deleted=of("error")).select("change", "event_id")


@query(
    "lookup_join",
    "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def lookups(t: Tables) -> DataFrame:
    """Small lookups whose size is known from their files."""
    nation = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    region = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    found = with_lookup(t.customer, nation, ["c_nationkey"], "inner", lookup_bytes=_file_bytes(nation))
    return with_lookup(found, region, ["n_regionkey"], "inner", lookup_bytes=_file_bytes(region)).select("c_custkey", "n_name", "r_name")


def _file_bytes(rows: DataFrame) -> int:
    sizes = rows.select("_metadata.file_path", "_metadata.file_size").distinct()
    return sizes.agg(F.sum("file_size")).first()[0] or 0


# Nested data: orders with arrays of lines, CSV in a field, free maps.


@query(
    "nested_flatten",
    """
    SELECT l_orderkey, l_linenumber, 'q' AS part, 'a' AS child, l_quantity AS amount, l_returnflag AS flag FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'q', 'b', l_tax, l_returnflag FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'p', 'a', l_extendedprice, l_linestatus FROM lineitem WHERE l_discount > 0.05
    """,
)
def nested(t: Tables) -> DataFrame:
    """Children inside parents inside rows, flattened with their parent's flag; some parents have none."""
    child = "struct<child:string,amount:double>"
    first = F.array(
        F.struct(F.lit("a").alias("child"), F.col("l_quantity").alias("amount")),
        F.struct(F.lit("b").alias("child"), F.col("l_tax").alias("amount")),
    )
    second = F.when(
        F.col("l_discount") > 0.05, F.array(F.struct(F.lit("a").alias("child"), F.col("l_extendedprice").alias("amount")))
    )
    parents = F.array(
        F.struct(F.lit("q").alias("part"), F.col("l_returnflag").alias("flag"), first.cast(f"array<{child}>").alias("children")),
        F.struct(F.lit("p").alias("part"), F.col("l_linestatus").alias("flag"), second.cast(f"array<{child}>").alias("children")),
    )
    flat = flatten_map(
        F.col("parents"),
        lambda p: F.transform(
            p["children"],
            lambda c: F.struct(
                p["part"].alias("part"), c["child"].alias("child"), c["amount"].alias("amount"), p["flag"].alias("flag")
            ),
        ),
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", parents.alias("parents"))
    return rows.select("l_orderkey", "l_linenumber", F.explode(flat).alias("line")).select("l_orderkey", "l_linenumber", "line.*")


@query(
    "csv_field",
    """
    SELECT l_orderkey, l_linenumber, n AS line, CASE n WHEN 1 THEN l_extendedprice WHEN 2 THEN l_quantity END AS price,
           CASE n WHEN 1 THEN l_returnflag || ', ' || l_linestatus WHEN 2 THEN 'say "' || l_returnflag || '"' ELSE '' END AS note
    FROM lineitem CROSS JOIN (SELECT CAST(unnest([1, 2, 3]) AS INTEGER) AS n)
    """,
)
def csv_field(t: Tables) -> DataFrame:
    """CSV text in a field, typed by its header: quoted commas and quotes, an empty and a short line."""
    text = F.concat(
        F.lit("note,line,price\r\n"),
        F.lit('"'), "l_returnflag", F.lit(", "), "l_linestatus", F.lit('",1,'), F.col("l_extendedprice").cast("string"),
        F.lit('\n\n"say ""'), "l_returnflag", F.lit('""",2,'), F.col("l_quantity").cast("string"),
        F.lit("\n,3"),
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.explode(csv_rows(text)).alias("row"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.col("row")["line"].try_cast("int").alias("line"),
        F.col("row")["price"].try_cast("double").alias("price"),
        F.col("row")["note"].alias("note"),
    )


@query(
    "custom_map",
    """
    SELECT event_id, 'type' AS key, event_type AS value FROM events WHERE event_id % 3 <> 1
    UNION ALL SELECT event_id, 'n', CAST(event_id AS VARCHAR) FROM events WHERE event_id % 3 <> 1
    """,
)
def custom_map(t: Tables) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 1, F.lit('{"custom":[1]}')).otherwise(
        F.concat(F.lit('{"custom":{"type":"'), "event_type", F.lit('","n":'), F.col("event_id"), F.lit("}}"))
    )
    value = t.events.select("event_id", F.parse_json(text).alias("v"))
    return value.select("event_id", F.explode(string_map(F.col("v"), "$.custom")))


@query(
    "array_functions",
    """
    SELECT p_partkey, CASE WHEN p_size > 25 THEN p_type || '|big' ELSE p_type END AS kept,
           CASE WHEN p_size % 2 = 0 THEN 'x|' || p_type ELSE p_type || '|y' END AS without_first,
           p_retailprice AS latitude, -p_retailprice AS longitude, p_size > 25 AS has_some
    FROM part
    """,
)
def arrays(t: Tables) -> DataFrame:
    labels = F.array(F.col("p_type"), F.lit(""), F.lit(None).cast("string"), F.when(F.col("p_size") > 25, F.lit("big")))
    pair = F.when(F.col("p_size") % 2 == 0, F.array(F.lit("x"), F.lit("drop"), F.col("p_type"))).otherwise(
        F.array(F.col("p_type"), F.lit("drop"), F.lit("y"))
    )
    latitude, longitude = lon_lat(F.array(-F.col("p_retailprice"), F.col("p_retailprice")))
    some = F.filter(F.array(F.col("p_size")), lambda n: n > 25)
    return t.part.select(
        "p_partkey",
        F.array_join(truthy(labels), "|").alias("kept"),
        F.array_join(remove_first(pair, pair, "drop"), "|").alias("without_first"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        non_empty(some).isNotNull().alias("has_some"),
    )


# Streams: the records are written in several files, then read as a stream until no file is left.


def _record_files(rows: DataFrame, label: str, files: int = 4) -> str:
    path = scratch_dir(rows.sparkSession, label)
    rows.repartition(files).write.parquet(path)
    return path


def _fanned_out(t: Tables) -> str:
    source = _record_files(feed_records(t, strict_call_time()), "records")
    root, checkpoint = scratch_dir(t.spark, "feeds"), scratch_dir(t.spark, "checkpoint")
    stream = t.spark.readStream.schema("event_id bigint, body string").option("maxFilesPerTrigger", 2).parquet(source)
    received = ts_literal("2024-02-10T12:34:56.789012Z")
    start_fanout(stream, root, checkpoint, received=received).awaitTermination()
    start_fanout(stream, root, checkpoint, received=received).awaitTermination()  # a restart adds nothing
    return root


@query(
    "stream_fanout_typed",
    f"SELECT 'p' || event_id AS pub_sub_event_id, {pick_sql(TYPES)} AS event_type FROM events WHERE NOT ({REPLAYED})",
)
def fanout_typed(t: Tables) -> DataFrame:
    return t.spark.read.parquet(f"{_fanned_out(t)}/typed").select("pub_sub_event_id", "event_type")


@query("stream_fanout_raw", f"SELECT {pick_sql(TYPES)} AS event_type, {KEPT_ARGS_SQL} AS args FROM events")
def fanout_raw(t: Tables) -> DataFrame:
    return t.spark.read.parquet(f"{_fanned_out(t)}/raw").select("event_type", F.array_join("args", "|", "~").alias("args"))


@query(
    "stream_fanout_counts",
    f"""
    SELECT 'typed' AS sink, count(*) AS records FROM events WHERE NOT ({REPLAYED})
    UNION ALL SELECT 'raw', count(*) FROM events
    UNION ALL SELECT 'adherence', count(*) FROM events WHERE event_id % 5 IN (0, 1, 4) AND NOT ({REPLAYED})
    UNION ALL SELECT 'latency', count(*) FROM events
    UNION ALL SELECT 'rejected', 0
    """,
)
def fanout_counts(t: Tables) -> DataFrame:
    root = _fanned_out(t)
    found = None
    for sink in ("typed", "raw", "adherence", "latency", "rejected"):
        one = t.spark.read.parquet(f"{root}/{sink}") if sink != "rejected" else t.spark.createDataFrame([], "x int")
        one = one.agg(F.count(F.lit(1)).alias("records")).select(F.lit(sink).alias("sink"), "records")
        found = one if found is None else found.unionByName(one)
    return found


SYNC_TYPES = ["sensor_first_sync", "sensor_synchronized"]
SYNC_BODY = {"mac": "'mac' || user_id", "mid": S(3, "'m' || event_id")}


@query(
    "stream_bronze",
    f"""
    SELECT user_id, group_id, call_time, pub_sub_event_id, mac, mid AS medication_id, date_year, date_month
    FROM {source_sql(SYNC_TYPES, SYNC_BODY)} WHERE mid IS NOT NULL OR x
    """,
)
def bronze_stream(t: Tables) -> DataFrame:
    """A feed of one mapping streamed to its bronze table; a restart adds nothing."""
    source = _record_files(records(t, SYNC_TYPES, SYNC_BODY), "records")
    root, checkpoint = scratch_dir(t.spark, "bronze"), scratch_dir(t.spark, "checkpoint")
    stream = t.spark.readStream.schema("event_id bigint, data string").option("maxFilesPerTrigger", 2).parquet(source)
    for _ in range(2):
        start_bronze(stream, root, checkpoint, tables=["sensor_sync"]).awaitTermination()
    return shown(t.spark.read.parquet(f"{root}/sensor_sync").drop("event_type", "stream", "batch_id"))


@query(
    "stream_bronze_two_feeds",
    f"""
    SELECT user_id, group_id, call_time, pub_sub_event_id, mac, mid AS medication_id, date_year, date_month
    FROM {source_sql(SYNC_TYPES, SYNC_BODY)} WHERE mid IS NOT NULL OR x
    """,
)
def bronze_two_feeds(t: Tables) -> DataFrame:
    """Two streams with checkpoints of their own fill one table; both are started again."""
    rows, root = records(t, SYNC_TYPES, SYNC_BODY), scratch_dir(t.spark, "bronze")
    feeds = [(_record_files(rows.filter(F.col("event_id") % 2 == n), "records"), scratch_dir(t.spark, "checkpoint")) for n in (0, 1)]
    for source, checkpoint in feeds * 2:
        stream = t.spark.readStream.schema("event_id bigint, data string").parquet(source)
        start_bronze(stream, root, checkpoint, tables=["sensor_sync"]).awaitTermination()
    return shown(t.spark.read.parquet(f"{root}/sensor_sync").drop("event_type", "stream", "batch_id"))


@query("upsert_partitioned", UPSERT_SQL.replace("customer", "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)"))
def upsert_partitioned(t: Tables) -> DataFrame:
    """A partitioned table stays partitioned; each segment is read by its own filter."""
    path = scratch_dir(t.spark, "customer")
    t.customer.select(*CUSTOMER).write.partitionBy("c_mktsegment").parquet(path)
    upsert(path, _stage(t).select(*CUSTOMER), ["c_custkey"])
    segments = [r.c_mktsegment for r in t.customer.select("c_mktsegment").distinct().collect()]
    parts = [read_path(t.spark, path).where(F.col("c_mktsegment") == s) for s in segments]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


# Partition values that look like numbers or hold characters that folder names cannot have.
CODE = "lpad(CAST(c_custkey % 7 AS VARCHAR), 2, '0') || CASE WHEN c_custkey % 7 = 3 THEN '/ä %=' ELSE '' END"


def _coded(t: Tables) -> DataFrame:
    code = F.concat(F.lpad((F.col("c_custkey") % 7).cast("string"), 2, "0"), F.when(F.col("c_custkey") % 7 == 3, "/ä %=").otherwise(""))
    return t.customer.select("c_custkey", "c_acctbal", F.when(F.col("c_custkey") % 7 < 6, code).alias("code"))


CODED_SQL = f"(SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 7 < 6 THEN {CODE} END AS code FROM customer)"


@query(
    "upsert_string_partition",
    f"""
    SELECT c_custkey, c_acctbal, code FROM {CODED_SQL} WHERE NOT (c_custkey % 7 = 2 AND c_acctbal < 0)
    UNION ALL SELECT c_custkey, 0.0, code FROM {CODED_SQL} WHERE c_custkey % 7 = 2 AND c_acctbal < 0
    UNION ALL SELECT -c_custkey, c_acctbal, code FROM {CODED_SQL} WHERE c_custkey % 70 = 5
    UNION ALL SELECT -c_custkey, c_acctbal, '007' FROM {CODED_SQL} WHERE c_custkey % 70 = 6
    """,
)
def string_partitions(t: Tables) -> DataFrame:
    """Texts like ``02`` stay texts, null stays null; rows changed, added to a partition, and in a new one."""
    path, rows = scratch_dir(t.spark, "coded"), _coded(t)
    full_refresh(rows.limit(0), path)
    replace(rows, path, keys=["code"])
    changed = rows.where("c_custkey % 7 = 2 and c_acctbal < 0").withColumn("c_acctbal", F.lit(0.0))
    added = rows.where("c_custkey % 70 = 5").withColumn("c_custkey", -F.col("c_custkey"))
    new = rows.where("c_custkey % 70 = 6").withColumn("c_custkey", -F.col("c_custkey")).withColumn("code", F.lit("007"))
    upsert(path, changed.unionByName(added).unionByName(new), ["c_custkey"])
    return read_path(t.spark, path)


@query(
    "upsert_scope",
    """
    SELECT c_mktsegment, CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 1 END AS BIGINT) AS folders,
           c_mktsegment = 'BUILDING' AS rewritten, count(*) + CASE c_mktsegment WHEN 'MACHINERY' THEN 1 ELSE 0 END AS n
    FROM customer GROUP BY c_mktsegment
    """,
)
def upsert_scope(t: Tables) -> DataFrame:
    """One changed row and one new row: of all partitions one is written again and one gets a file more."""
    path, rows = scratch_dir(t.spark, "customer"), t.customer.select(*CUSTOMER)
    first = replace(rows, path, keys=["c_mktsegment"])
    one = rows.where("c_mktsegment = 'BUILDING'").orderBy("c_custkey").limit(1)
    new = one.withColumn("c_custkey", F.lit(-1).cast(rows.schema["c_custkey"].dataType)).withColumn("c_mktsegment", F.lit("MACHINERY"))
    second = upsert(path, one.unionByName(new), ["c_custkey"])
    known = [(p.split("=")[1], len(own), own[0] != first.parts[p][0]) for p, own in second.parts.items()]
    folders = t.spark.createDataFrame(known, "c_mktsegment string, folders long, rewritten boolean")
    counts = read_path(t.spark, path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(folders, "c_mktsegment").select("c_mktsegment", "folders", "rewritten", "n")


@query(
    "stream_dead_letter_replay",
    f"""
    SELECT {FAILED_SQL} AS failed_event, {FAILED_SQL} || '-retry' AS feed, 'p' || event_id AS id FROM events
    """,
)
def replay_stream(t: Tables) -> DataFrame:
    out, checkpoint = scratch_dir(t.spark, "replayed"), scratch_dir(t.spark, "checkpoint")
    letters = error_files(t)
    for _ in range(2):
        start_replay(t.spark, letters, out, checkpoint).awaitTermination()
    return t.spark.read.parquet(out).select(
        "failed_event", "feed", F.get_json_object("data", "$.pubSubEventId").alias("id")
    )


@query("incremental_read", "SELECT o_orderkey, CAST(1 AS BIGINT) AS times FROM orders")
def incremental(t: Tables) -> DataFrame:
    """Files added between two runs are read once each."""
    source, out, checkpoint = (scratch_dir(t.spark, n) for n in ("orders", "seen", "checkpoint"))
    rows = t.orders.select("o_orderkey", "o_totalprice")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(out)

    for part in (F.col("o_totalprice") < 200000, F.col("o_totalprice") >= 200000):
        rows.filter(part).write.mode("append").parquet(source)
        read_new(t.spark, source, rows.schema, checkpoint, keep).awaitTermination()
    seen = t.spark.read.parquet(out)
    return seen.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))


@query(
    "stream_once_per_event",
    "SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN 'late' ELSE 'on time' END AS came FROM events",
)
def deduplicated(t: Tables) -> DataFrame:
    """Events of a month, then all of them again with the third that is late by up to that month, then all once more."""
    rows = t.events.select("event_id", "user_id", "ts")
    source, out, ledger, checkpoint = (scratch_dir(t.spark, n) for n in ("sent", "once", "ledger", "checkpoint"))

    def run() -> None:
        stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(source)
        start_once(stream, out, ledger, checkpoint, key="event_id").awaitTermination()

    for n, part in enumerate((rows.where("event_id % 3 <> 0"), rows.unionByName(rows), rows)):
        part.repartition(2 + n).write.mode("append").parquet(source)
        run()
    merge_ledger(t.spark, ledger, stream=stream_name(checkpoint), before=1, key="event_id")
    rows.limit(100).write.mode("append").parquet(source)
    run()
    first = F.when(F.col("event_id") % 3 == 0, "late").otherwise("on time")
    return t.spark.read.parquet(out).select("event_id", "user_id", first.alias("came"))


@query(
    "stream_replay_batches",
    f"SELECT {FAILED_SQL.replace('failed=', '')} AS event_type, CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS twice FROM events GROUP BY ALL",
)
def replayed_batches(t: Tables) -> DataFrame:
    """Batches of 100 per file and type to a receiver that breaks down half-way; the restart sends the rest and nothing twice."""
    letters = error_files(t)
    out, checkpoint, inbox = (scratch_dir(t.spark, n) for n in ("replayed", "checkpoint", "inbox"))
    place = inbox.removeprefix("file:")
    os.makedirs(place)

    def receiver(breaks: bool):
        def send(event_type: str, rows: list) -> None:
            if breaks and zlib.crc32(rows[0].data.encode()) % 2:
                raise ConnectionError("the receiver is away")
            with open(f"{place}/{uuid.uuid4().hex}", "w") as file:
                file.writelines(f"{event_type}\t{json.loads(r.data)['pubSubEventId']}\t{len(rows)}\n" for r in rows)

        return send

    for breaks in (True, False, False):
        query = start_replay(t.spark, letters, out, checkpoint, send=receiver(breaks))
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if not breaks or "DeliveryFailed" not in str(error):
                raise
    seen = t.spark.read.schema("event_type string, id string, size long").option("sep", "\t").csv(place)
    each = seen.groupBy("event_type", "id").agg(F.count(F.lit(1)).alias("times"), F.max("size").alias("size"))
    return each.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("size") > 100).alias("overfull"), F.count_if(F.col("times") > 1).alias("twice"))


@query(
    "hourly_counts",
    """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H') AS hour, event_type, count(*) AS events FROM events GROUP BY ALL
    """,
)
def hourly_counts(t: Tables) -> DataFrame:
    hour = F.date_format(hour_of(F.col("ts")), "yyyy-MM-dd'T'HH").alias("hour")
    return t.events.groupBy(hour, "event_type").agg(F.count(F.lit(1)).alias("events"))


# Rejects lead back to their records.

DAMAGED = "event_id % 11 IN (1, 2, 3, 5)"
REASON_SQL = """CASE event_id % 11 WHEN 2 THEN 'missing: body' WHEN 3 THEN 'format: callTime' ELSE 'payload: not base64 JSON' END"""


@query("rejects_to_records", f"SELECT event_id, {REASON_SQL} AS errors FROM events WHERE {DAMAGED}")
def rejects_to_records(t: Tables) -> DataFrame:
    """Rejects of a fan-out stream, joined with the files the stream was read from: every one finds its record."""
    source = _record_files(damaged_records(t), "records")
    root, checkpoint = scratch_dir(t.spark, "feeds"), scratch_dir(t.spark, "checkpoint")
    stream = with_pointer(t.spark.readStream.schema("event_id bigint, body string").parquet(source), "body")
    start_fanout(stream, root, checkpoint, received=ts_literal("2024-02-10T12:34:56.789012Z")).awaitTermination()
    rejects = t.spark.read.parquet(f"{root}/rejected")
    found = records_of(rejects, t.spark.read.parquet(source), "body")
    return found.select("event_id", F.array_join("errors", ";").alias("errors"))


@query("raw_tee_record", f"SELECT event_id, {pick_sql(TYPES)} AS event_type FROM events")
def raw_record(t: Tables) -> DataFrame:
    """The raw tee of a stream keeps the other fields of the queue's record."""
    return t.spark.read.parquet(f"{_fanned_out(t)}/raw").select("record.event_id", "event_type")


@query("bronze_rejects_to_records", f"SELECT event_id, 'missing: mid' AS errors FROM {source_sql(SYNC_TYPES, SYNC_BODY)} WHERE mid IS NULL AND NOT x")
def bronze_rejects_to_records(t: Tables) -> DataFrame:
    """The same for events that no mapping takes, with the queue's id instead of a file."""
    rows, root = records(t, SYNC_TYPES, SYNC_BODY), scratch_dir(t.spark, "bronze")
    pointed = with_pointer(rows, "data", record_id="event_id")
    write_bronze(decode_envelopes(pointed, keep=["pointer"]), root, run="r1", tables=["sensor_sync"])
    rejects = t.spark.read.parquet(f"{root}/_rejected/mapping")
    return records_of(rejects, rows, "data", record_id="event_id").select("event_id", F.array_join("errors", ";").alias("errors"))


@query(
    "dead_letter_rejects",
    "SELECT 'x' || event_id AS letter, 'payload: not base64 JSON' AS errors FROM events WHERE event_id % 13 = 5",
)
def dead_letter_rejects(t: Tables) -> DataFrame:
    """Letters that a replay could not decode, found again in their files."""
    letters, out, checkpoint = (scratch_dir(t.spark, n) for n in ("errors", "replayed", "checkpoint"))
    text = F.concat(F.lit('{"pubSubEvent":"act_created","n":'), "event_id", F.lit("}"))
    data = F.when(F.col("event_id") % 13 == 5, F.concat(F.lit("x"), "event_id")).otherwise(encode_base64(text))
    line = F.concat(F.lit('{"rawData":"'), data, F.lit('"}')).alias("value")
    t.events.select(line, F.lit("act_createdprocessing-failed").alias("f")).write.partitionBy("f").text(letters)
    start_replay(t.spark, letters, out, checkpoint).awaitTermination()
    rejects = t.spark.read.parquet(f"{out}_rejected")
    found = records_of(rejects, read_dead_letters(t.spark, letters), "raw_data")
    return found.select(F.col("raw_data").alias("letter"), F.array_join("errors", ";").alias("errors"))
