"""Queries of the curation jobs: latest rows, spines, as-of locations, environment, dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.times import Period, clamp, hour_of, iso_ms, ts_literal
from lakeloom.operators.asof import asof_spans, point_timeline
from lakeloom.operators.conform import flatten_structs
from lakeloom.operators.environment import MEASURES, environmental_hours
from lakeloom.operators.latest import drop_duplicates_on, latest_by_key
from lakeloom.operators.spine import hour_spans, hour_spine
from lakeloom.plans.dim_subgroup import dim_subgroup
from lakeloom.plans.patient_hours import PARTITIONS, patient_hours, write as write_hours
from lakeloom.queries.base import SQL_ISO_US, Tables, iso_us, query
from lakeloom.session import scratch_dir
from lakeloom.sinks.tables import stale_partitions, upsert
from lakeloom.sources.tables import read_path

JANUARY = Period(2024, 1)
def now() -> Column:
    return ts_literal("2024-02-03T04:05:06Z")


@query(
    "latest_by_key",
    f"""
    SELECT user_id, event_id, strftime(ts, '{SQL_ISO_US}') AS ts, event_type, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
    """,
)
def latest(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", "ts", "event_type", "value")
    return latest_by_key(rows, ["user_id"], ["ts", "event_id"]).withColumn("ts", iso_us("ts"))


@query(
    "drop_duplicates_on_key",
    """
    SELECT user_id % 20 AS location_id, strftime(date_trunc('hour', ts), '%Y-%m-%dT%H') AS hour,
           max(event_id) AS event_id, arg_max(value, event_id) AS value
    FROM events GROUP BY ALL
    """,
)
def duplicates(t: Tables) -> DataFrame:
    rows = t.events.select(
        (F.col("user_id") % 20).alias("location_id"),
        F.date_format(hour_of(F.col("ts")), "yyyy-MM-dd'T'HH").alias("hour"),
        "event_id",
        "value",
    )
    return drop_duplicates_on(rows, ["location_id", "hour"], ["event_id"])


@query(
    "drop_exact_duplicates",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_quantity FROM lineitem",
)
def exact_duplicates(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity").dropDuplicates()


SPINE_SQL = """
    WITH users AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY user_id),
    spine AS (
        SELECT user_id, unnest(generate_series(
            greatest(date_trunc('hour', lo), TIMESTAMP '2024-01-01'),
            least(date_trunc('hour', hi), TIMESTAMP '2024-01-31 23:00:00'),
            INTERVAL 1 HOUR)) AS hour
        FROM users)
"""


def user_spans(t: Tables, carry: Column | None = None, name: str | None = None) -> DataFrame:
    parts = [F.min("ts").alias("lo"), F.max("ts").alias("hi")]
    if carry is not None:
        parts.append(carry.alias(name))
    users = t.events.groupBy("user_id").agg(*parts)
    return hour_spans(
        users,
        ["user_id"],
        start=F.col("lo"),
        end=F.col("hi"),
        now=now(),
        period=JANUARY,
        carry=[name] if name else [],
    )


@query("hour_spine", SPINE_SQL + "SELECT user_id, strftime(hour, '%Y-%m-%dT%H') AS hour FROM spine")
def spine(t: Tables) -> DataFrame:
    return hour_spine(user_spans(t)).select("user_id", F.date_format("hour", "yyyy-MM-dd'T'HH").alias("hour"))


@query(
    "asof_location",
    SPINE_SQL
    + """,
    points AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'view'),
    fallback AS (SELECT user_id, arg_min(event_id, ts) AS event_id, arg_min(value, ts) AS value FROM events GROUP BY user_id),
    found AS (
        SELECT s.user_id, s.hour, p.event_id, p.value,
               row_number() OVER (PARTITION BY s.user_id, s.hour ORDER BY p.ts DESC, p.event_id DESC) AS rn
        FROM spine s LEFT JOIN points p ON p.user_id = s.user_id
            AND p.ts > s.hour - INTERVAL 48 HOUR
            AND p.ts < s.hour + INTERVAL '59 minutes 59 seconds 999999 microseconds')
    SELECT f.user_id, strftime(f.hour, '%Y-%m-%dT%H') AS hour,
           coalesce(f.event_id, b.event_id) AS event_id,
           CASE WHEN f.event_id IS NULL THEN b.value ELSE f.value END AS value,
           CASE WHEN f.event_id IS NULL THEN 'geo_location_first' ELSE 'last_48_hours' END AS location_strategy
    FROM found f JOIN fallback b USING (user_id) WHERE rn = 1
    """,
)
def asof(t: Tables) -> DataFrame:
    spans = user_spans(t, F.min_by(F.struct("event_id", "value"), F.struct("ts", "event_id")), "first")
    views = t.events.filter(F.col("event_type") == "view")
    timeline = point_timeline(views, ["user_id"], F.col("ts"), carry=["event_id", "value"], tie=["event_id"])
    cut = asof_spans(spans, timeline, ["user_id"])
    recent = F.col("point").isNotNull()
    chosen = cut.select(
        "user_id",
        "first_hour",
        "last_hour",
        F.when(recent, F.col("point.event_id")).otherwise(F.col("first.event_id")).alias("event_id"),
        F.when(recent, F.col("point.value")).otherwise(F.col("first.value")).alias("value"),
        F.when(recent, F.lit("last_48_hours")).otherwise(F.lit("geo_location_first")).alias("location_strategy"),
    )
    return hour_spine(chosen).withColumn("hour", F.date_format("hour", "yyyy-MM-dd'T'HH"))


# Stand-ins for the third-party tables: clicks are weather, purchases are air quality.


def weather_rows(t: Tables) -> DataFrame:
    v = F.col("value")
    undated = F.col("event_id") % 3 == 0
    text = iso_us("ts")
    return t.events.filter(F.col("event_type") == "click").select(
        (F.col("user_id") % 20).cast("string").alias("guid"),
        F.when(~undated, text).alias("datetime"),
        text.alias("date_observation"),
        "event_id",

        F.floor(v).cast("string").alias("dew_point"),
        (F.col("event_id") % 40).alias("wind_speed"),
        (F.col("event_id") % 31).alias("heat_index"),
        (F.col("event_id") % 29).alias("wind_chill"),
        (F.col("event_id") % 360).alias("wind_direction"),
        v.alias("pressure"),
        (F.col("event_id") % 100).alias("relative_humidity"),
        (F.col("event_id") % 45).alias("temperature"),
        F.lit("n/a").alias("visibility"),
        *_month("ts"),
    )


def air_rows(t: Tables) -> DataFrame:
    v = F.col("value")
    return t.events.filter(F.col("event_type") == "purchase").select(
        (F.col("user_id") % 20).cast("string").alias("guid"),
        iso_us("ts").alias("datetime"),
        "event_id",
        v.alias("pm25_concentration"),
        v.cast("string").alias("pm10_concentration"),
        (v * 2).alias("o3_concentration"),
        (v * 4).alias("no2_concentration"),
        (v / 2).alias("co_concentration"),
        (v / 4).alias("so2_concentration"),
        (F.col("event_id") % 500).alias("breezometer_aqi"),
        *_month("ts"),
    )


def _month(ts: str) -> list[Column]:
    return [F.year(ts).alias("date_year"), F.month(ts).alias("date_month")]


ENV_SQL = """
    w AS (
        SELECT CAST(user_id % 20 AS VARCHAR) AS location_id, date_trunc('hour', ts) AS hour, event_id, value,
               row_number() OVER (PARTITION BY user_id % 20, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
        FROM events WHERE event_type = 'click'),
    a AS (
        SELECT CAST(user_id % 20 AS VARCHAR) AS location_id, date_trunc('hour', ts) AS hour, event_id, value,
               row_number() OVER (PARTITION BY user_id % 20, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
        FROM events WHERE event_type = 'purchase'),
    env AS (
        SELECT coalesce(w.location_id, a.location_id) AS location_id, coalesce(w.hour, a.hour) AS hour,
               a.value AS weather_pm25, a.value AS weather_pm10,
               CAST(floor(w.value) AS INTEGER) AS weather_dew_point, CAST(w.event_id % 40 AS INTEGER) AS weather_wind_speed,
               a.value * 2 AS weather_o3, a.value * 4 AS weather_no2,
               CAST(w.event_id % 31 AS INTEGER) AS weather_heat_index, CAST(w.event_id % 29 AS INTEGER) AS weather_wind_chill,
               a.value / 2 AS weather_co, CAST(w.event_id % 360 AS INTEGER) AS weather_wind_direction,
               a.value / 4 AS weather_so2, CAST(a.event_id % 500 AS INTEGER) AS weather_aqi,
               w.value AS weather_pressure, CAST(w.event_id % 100 AS INTEGER) AS weather_humidity,
               CAST(w.event_id % 45 AS INTEGER) AS weather_temperature, CAST(NULL AS INTEGER) AS weather_visibility
        FROM (SELECT * FROM w WHERE rn = 1) w
        FULL OUTER JOIN (SELECT * FROM a WHERE rn = 1) a ON w.location_id = a.location_id AND w.hour = a.hour)
"""


@query(
    "env_hours_full_outer",
    f"WITH {ENV_SQL} SELECT * REPLACE (strftime(hour, '%Y-%m-%dT%H') AS hour) FROM env",
)
def env_hours(t: Tables) -> DataFrame:
    env = environmental_hours(weather_rows(t), air_rows(t), order=["event_id"])
    return env.withColumn("hour", F.date_format("hour", "yyyy-MM-dd'T'HH"))


# Patients: one per user, created at the first event and deleted at the last one for
# every third user; users whose first value is high have no usable first location.


def _place(prefix: str, v: Column, e: Column) -> list[Column]:
    return [
        v.alias("latitude"),
        (-v).alias("longitude"),
        F.when(e % 2 == 0, v / 2).alias("precision"),
        F.struct(
            *[F.concat(F.lit(f"{prefix}-{n}-"), (e % 5).cast("string")).alias(n)
              for n in ("state_code", "postal_code", "city", "country", "formatted", "state_or_region", "street", "street2")]
        ).alias("address"),
        F.when(
            e % 3 == 0,
            F.struct(
                v.alias("latitude"),
                (v * 2).alias("longitude"),
                F.lit("poi").alias("type"),
                F.lit(f"{prefix}-place").alias("name"),
                F.lit("node").alias("element"),
                e.cast("bigint").alias("id"),
            ),
        ).alias("place"),
        F.struct(
            (e % 20).cast("string").alias("id"),
            F.lit("1").alias("version"),
            v.alias("latitude"),
            (-v).alias("longitude"),
            (v / 8).alias("distance"),
        ).alias("weather_coordinate"),
    ]


def patient_rows(t: Tables) -> DataFrame:
    first = F.min_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    users = t.events.groupBy("user_id").agg(
        F.min("ts").alias("lo"), F.max("ts").alias("hi"), first.alias("first")
    )
    v, e = F.col("first.value"), F.col("first.event_id")
    return users.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("g"), F.col("user_id") % 7).alias("group_id"),
        iso_ms(F.col("lo")).alias("date_created"),
        F.when(F.col("user_id") % 3 == 0, F.unix_millis("hi").cast("string")).alias("date_deleted"),
        F.lit(True).alias("has_geo_location_first"),
        F.struct(
            F.when(v < 100, v).alias("latitude"), *_place("first", v, e)[1:]
        ).alias("geo_location_first"),
    )


def point_rows(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "view").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(iso_us("ts"), F.lit("Z")).alias("date"),
        *_place("last", F.col("value"), F.col("event_id")),
        *_month("ts"),
    )


def _place_sql(prefix: str, v: str, e: str) -> str:
    address = ", ".join(
        f"'{prefix}-{n}-' || ({e} % 5) AS address_{n}"
        for n in ("state_code", "postal_code", "city", "country", "formatted", "state_or_region", "street", "street2")
    )
    has_place = f"CASE WHEN {e} % 3 = 0 THEN "
    return f"""{v} AS latitude, -{v} AS longitude, CASE WHEN {e} % 2 = 0 THEN {v} / 2 END AS "precision", {address},
        {has_place} {v} END AS place_latitude, {has_place} {v} * 2 END AS place_longitude,
        {has_place} 'poi' END AS place_type, {has_place} '{prefix}-place' END AS place_name,
        {has_place} 'node' END AS place_element, {has_place} {e} END AS place_id,
        CAST({e} % 20 AS VARCHAR) AS weather_coordinate_id, '1' AS weather_coordinate_version,
        {v} AS weather_coordinate_latitude, -{v} AS weather_coordinate_longitude, {v} / 8 AS weather_coordinate_distance"""


PATIENT_HOURS_SQL = f"""
    WITH users AS (
        SELECT user_id, min(ts) AS lo, max(ts) AS hi, arg_min(value, ts) AS v, arg_min(event_id, ts) AS e
        FROM events GROUP BY user_id),
    patients AS (SELECT * FROM users WHERE v < 100),
    spine AS (
        SELECT user_id, v, e, unnest(generate_series(
            greatest(date_trunc('hour', lo), TIMESTAMP '2024-01-01'),
            least(CASE WHEN user_id % 3 = 0 THEN date_trunc('hour', hi) ELSE TIMESTAMP '2024-02-03 04:00:00' END,
                  TIMESTAMP '2024-01-31 23:00:00'), INTERVAL 1 HOUR)) AS hour
        FROM patients),
    points AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'view'),
    found AS (
        SELECT s.user_id, s.hour, s.v AS first_v, s.e AS first_e, p.event_id, p.value,
               row_number() OVER (PARTITION BY s.user_id, s.hour ORDER BY p.ts DESC, p.event_id DESC) AS rn
        FROM spine s LEFT JOIN points p ON p.user_id = s.user_id
            AND p.ts > s.hour - INTERVAL 48 HOUR
            AND p.ts < s.hour + INTERVAL '59 minutes 59 seconds 999999 microseconds'),
    located AS (
        SELECT user_id, hour, 'last_48_hours' AS location_strategy, {_place_sql("last", "value", "event_id")}
        FROM found WHERE rn = 1 AND event_id IS NOT NULL
        UNION ALL BY NAME
        SELECT user_id, hour, 'geo_location_first' AS location_strategy, {_place_sql("first", "first_v", "first_e")}
        FROM found WHERE rn = 1 AND event_id IS NULL),
    {ENV_SQL}
    SELECT l.* EXCLUDE (hour, user_id), CAST(l.user_id AS VARCHAR) AS user_id, 'g' || (l.user_id % 7) AS group_id,
           strftime(l.hour, '%Y-%m-%dT%H:00:00.000Z') AS date,
           CAST(year(l.hour) AS INTEGER) AS date_year, CAST(month(l.hour) AS INTEGER) AS date_month,
           CAST(day(l.hour) AS INTEGER) AS date_day, CAST(hour(l.hour) AS INTEGER) AS date_hour,
           env.* EXCLUDE (location_id, hour)
    FROM located l LEFT JOIN env ON env.location_id = l.weather_coordinate_id AND env.hour = l.hour
"""


@query("patient_hours", PATIENT_HOURS_SQL)
def hours_of_patients(t: Tables) -> DataFrame:
    """Flagship: spine, as-of location, fallback, weather and air quality, flattened."""
    return patient_hours(
        patient_rows(t),
        point_rows(t),
        weather_rows(t),
        air_rows(t),
        period=JANUARY,
        now=now(),
        survivor=["event_id"],
    )


@query(
    "patient_hours_table",
    f"""
    SELECT group_id, date_year, date_month, date_day, location_strategy, count(*) AS hours,
           count(weather_pm25) AS with_air, count(weather_pressure) AS with_weather
    FROM ({PATIENT_HOURS_SQL}) WHERE group_id <> 'g3' GROUP BY ALL
    """,
)
def hours_table(t: Tables) -> DataFrame:
    """The job's output written by partition; a group that vanished is reported as stale and left out."""
    path = scratch_dir(t.spark, "patient-hours")
    rows = hours_of_patients(t)
    write_hours(rows, path)
    table = t.spark.read.parquet(path)
    fresh = table.filter(F.col("group_id") != "g3")
    stale = stale_partitions(table, fresh, PARTITIONS, year=JANUARY.year, month=JANUARY.month)
    kept = table.join(stale, PARTITIONS, "left_anti")
    return kept.groupBy("group_id", "date_year", "date_month", "date_day", "location_strategy").agg(
        F.count(F.lit(1)).alias("hours"),
        F.count("weather_pm25").alias("with_air"),
        F.count("weather_pressure").alias("with_weather"),
    )


@query(
    "struct_flatten",
    f"""
    SELECT o_orderkey, o_custkey AS customer_key, o_orderpriority AS customer_priority,
           o_totalprice AS amount_total, o_orderstatus AS amount_status,
           strftime(o_orderdate, '{SQL_ISO_US}') AS amount_day
    FROM orders
    """,
)
def flatten(t: Tables) -> DataFrame:
    nested = t.orders.select(
        F.struct(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("priority")).alias("customer"),
        "o_orderkey",
        F.struct(
            F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status"), iso_us("o_orderdate").alias("day")
        ).alias("amount"),
    )
    return flatten_structs(nested)


@query(
    "range_clamp",
    """
    SELECT o_orderkey,
           strftime(least(greatest(o_orderdate, TIMESTAMP '1996-02-01'), TIMESTAMP '1996-02-29 23:59:59.999999'),
                    '%Y-%m-%dT%H:%M:%S.%f') AS clamped,
           epoch(o_orderdate)::BIGINT AS seconds,
           CAST(year(o_orderdate) AS INTEGER) AS part_year, CAST(month(o_orderdate) AS INTEGER) AS part_month,
           CAST(day(o_orderdate) AS INTEGER) AS part_day, CAST(hour(o_orderdate) AS INTEGER) AS part_hour
    FROM orders
    """,
)
def clamped(t: Tables) -> DataFrame:
    from lakeloom.functions.times import time_parts, unix_seconds

    month = Period(1996, 2)
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_format(clamp(day, low=month.begin_col(), high=month.end_col()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("clamped"),
        unix_seconds(day).alias("seconds"),
        *time_parts(day, "part_"),
    )


# Change streams: signups create, clicks update, errors delete a user's subgroup.


def _changes(t: Tables, kind: str) -> DataFrame:
    return t.events.filter(F.col("event_type") == kind).select(
        F.concat(F.lit("s"), F.col("user_id")).alias("subgroup_id"),
        F.concat(F.lit("name-"), F.col("event_id")).alias("name"),
        F.concat(F.lit("Name "), F.col("event_id")).alias("display_name"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("type"),
        F.concat(F.lit("g"), F.col("user_id") % 7).alias("group_id"),
        F.when(F.col("event_id") % 2 == 0, F.unix_millis("ts").cast("string")).otherwise(iso_ms(F.col("ts"))).alias("call_time"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("pub_sub_event_id"),
    )


@query(
    "change_dim",
    """
    WITH c AS (
        SELECT 's' || user_id AS subgroup_id, event_id, event_type, user_id, date_trunc('milliseconds', ts) AS at_ts
        FROM events WHERE event_type IN ('signup', 'click', 'error')),
    latest AS (SELECT *, row_number() OVER (PARTITION BY subgroup_id ORDER BY at_ts DESC, event_id DESC) AS rn FROM c),
    dates AS (
        SELECT subgroup_id, min(at_ts) FILTER (event_type = 'signup') AS created, max(at_ts) FILTER (event_type = 'error') AS deleted
        FROM c GROUP BY subgroup_id)
    SELECT l.subgroup_id, 'name-' || event_id AS subgroup_name, 'Name ' || event_id AS subgroup_display_name,
           CASE WHEN event_id % 5 <> 0 THEN event_type END AS subgroup_type, d.deleted IS NOT NULL AS deleted,
           'g' || (user_id % 7) AS ph_group_id,
           strftime(d.created, '%Y-%m-%dT%H:%M:%S.%f') AS created_datetime,
           strftime(d.deleted, '%Y-%m-%dT%H:%M:%S.%f') AS deleted_datetime,
           strftime(l.at_ts, '%Y-%m-%dT%H:%M:%S.%f') AS datetime_modified, 'eu' AS region
    FROM latest l JOIN dates d USING (subgroup_id) WHERE rn = 1
    """,
)
def change_dim(t: Tables) -> DataFrame:
    dimension = dim_subgroup(_changes(t, "signup"), _changes(t, "click"), _changes(t, "error"), region="eu")
    stamps = ("created_datetime", "deleted_datetime", "datetime_modified")
    return dimension.withColumns({c: iso_us(c) for c in stamps})


@query(
    "change_dim_upsert",
    """
    WITH c AS (
        SELECT 's' || user_id AS subgroup_id, event_type, date_trunc('milliseconds', ts) AS at_ts FROM events),
    fresh AS (
        SELECT subgroup_id, true AS deleted, strftime(max(at_ts), '%Y-%m-%dT%H:%M:%S.%f') AS datetime_modified
        FROM c WHERE event_type = 'error' GROUP BY subgroup_id),
    old AS (
        SELECT subgroup_id, false AS deleted, strftime(max(at_ts), '%Y-%m-%dT%H:%M:%S.%f') AS datetime_modified
        FROM c WHERE event_type IN ('signup', 'click') GROUP BY subgroup_id)
    SELECT * FROM fresh UNION ALL SELECT * FROM old WHERE subgroup_id NOT IN (SELECT subgroup_id FROM fresh)
    """,
)
def change_dim_upsert(t: Tables) -> DataFrame:
    """A dimension of creations and updates, then the rows of later deletions upserted into it."""
    nothing = _changes(t, "none")
    path = scratch_dir(t.spark, "dim")
    old = dim_subgroup(_changes(t, "signup"), _changes(t, "click"), nothing, region="eu")
    old.write.parquet(path)
    fresh = dim_subgroup(nothing, nothing, _changes(t, "error"), region="eu")
    upsert(path, fresh, ["subgroup_id"])
    return read_path(t.spark, path).select("subgroup_id", "deleted", iso_us("datetime_modified").alias("datetime_modified"))
