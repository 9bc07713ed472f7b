"""Whole jobs up to their tables and rejects: subgroups from changes and from bronze, members, publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeloom.functions.times import iso_ms, ts_literal
from lakeloom.operators.conform import ErrorBudget
from lakeloom.plans import dim_subgroup, member_match
from lakeloom.plans.bronze import write_bronze
from lakeloom.queries.base import ORACLES, SQL_ISO_US, Tables, iso_us, query
from lakeloom.queries.bronze import shown
from lakeloom.queries.curated import _changes
from lakeloom.queries.feed import CALL_TIMES, envelopes, pick_sql
from lakeloom.queries.matching import LOOSE_SCHEMA, LOOSE_SQL, MEMBER_RULES, _client_file, _dim_users, _loose
from lakeloom.session import scratch_dir
from lakeloom.sinks.publish import publish
from lakeloom.sources.tables import read_bronze, read_path

STAMPS = ("created_datetime", "deleted_datetime", "datetime_modified")
STAMP_SQL = ", ".join(f"strftime({c}, '{SQL_ISO_US}') AS {c}" for c in STAMPS)


def _state_sql(changes: str, tie: str, by: str = "subgroup_id") -> str:
    """State per subgroup (and run) of ``changes(subgroup_id, kind, at_ts, event_id, ...)``."""
    return f"""
    c AS ({changes}),
    latest AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY at_ts DESC, {tie} DESC) AS rn FROM c),
    dates AS (SELECT {by}, min(at_ts) FILTER (kind = 'created') AS created_datetime, max(at_ts) FILTER (kind = 'deleted') AS deleted_datetime FROM c GROUP BY ALL),
    state AS (SELECT *, deleted_datetime IS NOT NULL AS deleted, at_ts AS datetime_modified FROM latest JOIN dates USING ({by}) WHERE rn = 1)"""


CHANGES_SQL = """
    SELECT 's' || user_id AS subgroup_id, CASE event_type WHEN 'signup' THEN 'created' WHEN 'click' THEN 'updated' ELSE 'deleted' END AS kind,
           date_trunc('milliseconds', ts) AS at_ts, event_id, event_id % 2 AS run, 'name-' || event_id AS subgroup_name,
           'Name ' || event_id AS subgroup_display_name, CASE WHEN event_id % 5 <> 0 THEN event_type END AS subgroup_type,
           'g' || (user_id % 7) AS ph_group_id
    FROM events WHERE event_type IN ('signup', 'click', 'error') AND user_id % 3 <> event_id % 2
      AND NOT (event_type = 'signup' AND user_id % 5 = 0)"""
STATE_SQL = _state_sql(CHANGES_SQL, "event_id", "run, subgroup_id")
SUBGROUP = "subgroup_id, subgroup_name, subgroup_display_name, subgroup_type, deleted, ph_group_id"


def _populated(t: Tables) -> tuple[str, str]:
    """The job run for two halves of the changes, the second one upserted into the first one's table."""
    target, rejects = scratch_dir(t.spark, "dim_subgroup"), scratch_dir(t.spark, "rejects")
    for run in (0, 1):

        def half(kind: str) -> DataFrame:
            number = F.col("pub_sub_event_id").cast("long")
            user = F.substring("subgroup_id", 2, 20).cast("long")
            return _changes(t, kind).where((number % 2 == run) & (user % 3 != number % 2))

        created = half("signup").where("cast(substring(subgroup_id, 2, 20) as long) % 5 <> 0")  # of the others no creation is known
        dim_subgroup.populate(created, half("click"), half("error"), target, region="eu", rejects=rejects)
    return target, rejects


@query(
    "dim_subgroup_table",
    f"""
    WITH {STATE_SQL},
    good AS (SELECT * FROM state WHERE created_datetime IS NOT NULL),
    final AS (SELECT * FROM good WHERE run = 1 UNION ALL SELECT * FROM good WHERE run = 0 AND subgroup_id NOT IN (SELECT subgroup_id FROM good WHERE run = 1))
    SELECT {SUBGROUP}, {STAMP_SQL}, 'eu' AS region FROM final
    """,
)
def subgroup_table(t: Tables) -> DataFrame:
    return read_path(t.spark, _populated(t)[0]).withColumns({c: iso_us(c) for c in STAMPS})


@query(
    "dim_subgroup_rejects",
    f"WITH {STATE_SQL} SELECT subgroup_id, 'created_datetime' AS lacking, deleted FROM state WHERE run = 1 AND created_datetime IS NULL",
)
def subgroup_rejects(t: Tables) -> DataFrame:
    """Subgroups whose creation the last run has not seen."""
    found = read_path(t.spark, _populated(t)[1])
    return found.select("subgroup_id", F.array_join("_errors", ",").alias("lacking"), "deleted")


# From envelopes through bronze to the dimension. A type of another table comes along.
FED_TYPES = ["subgroup_created", "subgroup_updated", "subgroup_deleted", "act_created"]
FED_BODY = {"id": "'s' || user_id", "name": "'n' || event_id", "displayName": "'N' || event_id", "type": "'t'"}
FED_SQL = f"""
    SELECT 's' || user_id AS subgroup_id, replace({pick_sql(FED_TYPES)}, 'subgroup_', '') AS kind, {CALL_TIMES} AS at_ts, event_id,
           'n' || event_id AS subgroup_name, 'N' || event_id AS subgroup_display_name, 't' AS subgroup_type, 'g' || (user_id % 7) AS ph_group_id
    FROM events WHERE event_id % {len(FED_TYPES)} < 3"""


def _fed(t: Tables) -> str:
    root = scratch_dir(t.spark, "bronze")
    write_bronze(envelopes(t, FED_TYPES, FED_BODY), root, run="r1", tables=["subgroup"])
    return root


@query(
    "bronze_by_event_type",
    f"""
    SELECT subgroup_id, subgroup_name AS name, strftime(at_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS call_time, 'subgroup_' || kind AS event_type
    FROM ({FED_SQL}) WHERE kind IN ('updated', 'deleted')
    """,
)
def by_event_type(t: Tables) -> DataFrame:
    """Two of three event types of a bronze table, by the partitions they are in."""
    found = read_bronze(t.spark, _fed(t), "subgroup", event_types=["subgroup_updated", "subgroup_deleted"])
    return found.select("subgroup_id", "name", "call_time", "event_type")


@query(
    "bronze_unlisted_types",
    f"SELECT 'p' || event_id AS pub_sub_event_id, 'act_created' AS event_type, 'table not listed' AS error FROM events WHERE event_id % {len(FED_TYPES)} = 3",
)
def unlisted_types(t: Tables) -> DataFrame:
    """Known event types whose table was not asked for are rejected, with the reason."""
    found = t.spark.read.parquet(f"{_fed(t)}/_rejected/envelope")
    return found.select("pub_sub_event_id", "event_type", F.array_join("errors", ";").alias("error"))


@query(
    "bronze_to_dim_subgroup",
    f"WITH {_state_sql(FED_SQL, chr(39) + 'p' + chr(39) + ' || event_id')} SELECT {SUBGROUP}, {STAMP_SQL}, 'us' AS region FROM state WHERE created_datetime IS NOT NULL",
)
def dim_from_bronze(t: Tables) -> DataFrame:
    target = scratch_dir(t.spark, "dim_subgroup")
    dim_subgroup.populate_from_bronze(t.spark, _fed(t), target, region="us")
    return read_path(t.spark, target).withColumns({c: iso_us(c) for c in STAMPS})


# Member matching to its table. Files of one division come without a date of ingestion.


def _matched(t: Tables) -> tuple[str, str]:
    target, rejects = scratch_dir(t.spark, "members"), scratch_dir(t.spark, "rejects")
    undated = F.when(F.col("division") != "5-LOW", F.col("date_ingested"))
    files = [_client_file(t, v2).withColumn("date_ingested", undated) for v2 in (False, True)]
    for _ in range(2):
        member_match.populate(
            *files, _dim_users(t), target, MEMBER_RULES, today=F.lit("2024-06-01").cast("date"), now=ts_literal("2024-06-01T00:00:00Z"), rejects=rejects
        )
    return target, rejects


MEMBER_SQL = ORACLES["member_match"]
COMMON_SQL = """'2024-01-01' AS date_ingested, 'client' AS client_name, 'a@example.org' AS email, '1 Road' AS address_street_1,
    CAST(NULL AS VARCHAR) AS address_street_2, 'Town' AS address_city, 'CA' AS address_state_code, '12345' AS address_postal_code,
    '1' AS phone_number, 'm' AS medical_record_number, 'x' AS patient_gender, 'en' AS patient_language, 'c' AS diagnosis_code_1,
    'd' AS diagnosis_desc_1, 'r' AS rendering_provider, 'p' AS pcp_name, 'k' AS clinic_desc, CAST(NULL AS INTEGER) AS cerner_person_id,
    CAST(NULL AS VARCHAR) AS group_display_name, CAST(NULL AS VARCHAR) AS address_country_code"""


@query("member_match_table", f"SELECT *, {COMMON_SQL} FROM ({MEMBER_SQL}) WHERE division <> '5-LOW'")
def member_table(t: Tables) -> DataFrame:
    """All thirty columns, after the job ran twice."""
    dates = {c: F.date_format(c, "yyyy-MM-dd") for c in ("date_ingested", "date_of_birth", "date_of_service")}
    return read_path(t.spark, _matched(t)[0]).withColumns(dates | {"datetime_modified": iso_ms(F.col("datetime_modified"))})


@query(
    "member_match_rejects",
    f"SELECT first_name, last_name, market, uid, date_of_birth, date_of_service, disease, 'date_ingested' AS lacking FROM ({MEMBER_SQL}) WHERE division = '5-LOW'",
)
def member_rejects(t: Tables) -> DataFrame:
    found = read_path(t.spark, _matched(t)[1])
    dates = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("date_of_birth", "date_of_service")]
    return found.select("first_name", "last_name", "market", "uid", *dates, "disease", F.array_join("_errors", ",").alias("lacking"))


LIBERAL = ErrorBudget(stage=1 << 40, total=1 << 40)


@query("publish_table", f"SELECT * FROM ({LOOSE_SQL}) WHERE price IS NOT NULL")
def published(t: Tables) -> DataFrame:
    target = scratch_dir(t.spark, "published")
    publish(_loose(t), target, LOOSE_SCHEMA, budget=LIBERAL)
    return shown(read_path(t.spark, target)).withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


@query(
    "publish_counts",
    """
    SELECT 'rows' AS what, count(*) AS n FROM lineitem UNION ALL SELECT 'rejected', count(*) FILTER (l_discount = 0.1) FROM lineitem
    UNION ALL SELECT 'failed quantity', count(*) FILTER (l_linenumber = 7) FROM lineitem
    UNION ALL SELECT 'failed price', count(*) FILTER (l_discount = 0.1) FROM lineitem
    UNION ALL SELECT 'failed shipped', count(*) FILTER (l_returnflag = 'R') FROM lineitem
    UNION ALL SELECT 'failed returned', count(*) FILTER (l_linestatus <> 'O') FROM lineitem
    """,
)
def published_counts(t: Tables) -> DataFrame:
    """What the publication has counted while it wrote."""
    report = publish(_loose(t), scratch_dir(t.spark, "published"), LOOSE_SCHEMA, budget=LIBERAL)
    found = [("rows", report.rows), ("rejected", report.rejected), *((f"failed {c}", n) for c, n in report.failed.items())]
    return t.spark.createDataFrame(found, "what string, n long")
