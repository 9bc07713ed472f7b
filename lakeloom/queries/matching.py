"""Queries of the matching job and of conforming: names, dates, casts, contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from lakeloom.functions.texts import clean_name, strip_prefix
from lakeloom.functions.times import iso_ms, not_after, parse_any_ts, parse_us_date, ts_literal
from lakeloom.operators.conform import (
    cast_failures,
    conform,
    contract_errors,
    drop_empty_columns,
    select_trimmed,
    split_contract,
    truncate_to_width,
    union_versions,
    with_missing,
)
from lakeloom.operators.latest import best_per_attributes
from lakeloom.operators.people import match_decision, matched_flag, name_join, name_join_within
from lakeloom.plans.member_match import ADDED_IN_V2, MatchRules, match_members, submissions
from lakeloom.queries.base import SQL_ISO_US, Tables, query

# Submissions are customers whose names are partly written differently.
ALTERED = "CASE WHEN c_nationkey % 4 = 0 THEN lower(c_name) WHEN c_nationkey % 7 = 0 THEN NULL ELSE c_name END"


def _submitted(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("submission"),
        F.expr(ALTERED).alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
    )


def _users(t: Tables) -> DataFrame:
    return t.customer.select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("uid"),
        F.col("c_name").alias("first_name_user"),
        F.col("c_mktsegment").alias("last_name_user"),
    )


NAMES = [("first_name", "first_name_user"), ("last_name", "last_name_user")]
NAMES_SQL = f"""
    WITH s AS (SELECT c_custkey AS submission, {ALTERED} AS first_name, c_mktsegment AS last_name FROM customer),
    u AS (SELECT 'u' || c_custkey AS uid, c_name AS first_name_user, c_mktsegment AS last_name_user FROM customer)
"""


@query(
    "name_join_exact",
    NAMES_SQL
    + """
    SELECT s.*, u.* FROM s JOIN u
    ON levenshtein(first_name, first_name_user) < 1 AND levenshtein(last_name, last_name_user) < 1
    """,
)
def exact_names(t: Tables) -> DataFrame:
    return name_join(_submitted(t), _users(t), NAMES)


@query(
    "name_join_unmatched",
    NAMES_SQL
    + """
    SELECT s.* FROM s WHERE NOT EXISTS (
        SELECT 1 FROM u WHERE s.first_name = u.first_name_user AND s.last_name = u.last_name_user)
    """,
)
def unmatched_names(t: Tables) -> DataFrame:
    return name_join(_submitted(t), _users(t), NAMES, "left_anti")


@query(
    "name_join_flag",
    NAMES_SQL
    + """
    SELECT s.*, uid, u.uid IS NOT NULL AS matched FROM s LEFT JOIN u
    ON s.first_name = u.first_name_user AND s.last_name = u.last_name_user
    """,
)
def flagged_names(t: Tables) -> DataFrame:
    return matched_flag(_submitted(t), _users(t), NAMES).select("submission", "first_name", "last_name", "uid", "matched")


# Misspelt part names against the catalogue of names of the same brand.
MISSPELT = """CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 2)
    WHEN 2 THEN substr(p_name, 1, 2) || 'x' || substr(p_name, 3) ELSE 'zz' || p_name END"""


@query(
    "name_join_within_distance",
    f"""
    WITH s AS (SELECT p_partkey, p_brand, {MISSPELT} AS spelt FROM part),
    c AS (SELECT DISTINCT p_brand, p_name AS listed FROM part)
    SELECT p_partkey, s.p_brand, spelt, listed, CAST(levenshtein(spelt, listed) AS INTEGER) AS distance
    FROM s JOIN c ON s.p_brand = c.p_brand WHERE levenshtein(spelt, listed) <= 2
    """,
)
def close_part_names(t: Tables) -> DataFrame:
    spelt = t.part.select("p_partkey", "p_brand", F.expr(MISSPELT).alias("spelt"))
    listed = t.part.select("p_brand", F.col("p_name").alias("listed")).distinct()
    return name_join_within(spelt, listed, ("spelt", "listed"), distance=2, block=[("p_brand", "p_brand")])


@query(
    "match_decision",
    """
    SELECT o_orderkey, CASE WHEN o_orderdate = DATE '1996-01-01' + CAST(c_nationkey * 20 AS INTEGER)
                             AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN c_name END AS uid,
           CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                THEN o_orderpriority END AS promo
    FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def decision(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    born = F.col("o_orderdate").cast("date")
    expected = F.date_add(F.lit("1996-01-01").cast("date"), (F.col("c_nationkey") * 20).cast("int"))
    allowed = ["1-URGENT", "2-HIGH"]
    known = F.when(F.col("o_orderstatus") != "P", born)
    return rows.select(
        "o_orderkey",
        match_decision(born, expected, F.col("o_orderpriority"), allowed, F.col("c_name")).alias("uid"),
        match_decision(known, born, F.col("o_orderpriority"), allowed, F.col("o_orderpriority")).alias("promo"),
    )


@query(
    "match_dedup",
    """
    SELECT o_custkey, o_orderstatus, uid, promo FROM (
        SELECT o_custkey, o_orderstatus, uid, promo, row_number() OVER (
            PARTITION BY o_custkey, o_orderstatus ORDER BY uid DESC NULLS LAST, promo DESC NULLS LAST) AS rn
        FROM (SELECT *, CASE WHEN o_totalprice > 200000 THEN 'u' || (o_orderkey % 50) END AS uid,
                     CASE WHEN o_totalprice > 300000 THEN o_orderpriority END AS promo FROM orders))
    WHERE rn = 1
    """,
)
def dedup(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_totalprice") > 200000, F.concat(F.lit("u"), F.col("o_orderkey") % 50)).alias("uid"),
        F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority")).alias("promo"),
    )
    return best_per_attributes(rows, ["uid", "promo"])


# Member matching over orders of customers. Every expression below reads the same in both engines.
DISEASE = "CASE c_nationkey % 5 WHEN 0 THEN 'COPD' WHEN 1 THEN 'ASTHMA' WHEN 2 THEN 'copd' WHEN 3 THEN 'Asthma' ELSE 'OTHER' END"
FIRST = "CASE WHEN c_nationkey % 4 = 0 THEN c_name ELSE upper(c_name) END"
MEMBER_RULES = MatchRules(promotions=("promo0", "promo1", "promo2", "promo3", "promo4", "promo5"))


def _born(t: Tables) -> DataFrame:
    day = F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") % 30000).cast("int"))
    return t.customer.withColumn("born", day)


def _client_file(t: Tables, v2: bool) -> DataFrame:
    rows = _born(t).join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.filter((F.col("o_orderstatus") == "P") if v2 else (F.col("o_orderstatus") != "P"))
    long_form = F.col("c_nationkey") % 5 == 0
    blank = F.col("c_nationkey") % 6 == 5

    def text(day: str):
        return F.when(blank, F.lit("")).when(long_form, F.date_format(day, "M/d/yyyy")).otherwise(F.date_format(day, "M/d/yy"))

    constant = {
        "zip": "12345", "address-1": "1 Road", "address-2": None, "city": "Town", "email": "a@example.org",
        "phone nbr": "1", "state": "CA", "client name": "client", "medical_record_number": "m",
        "patient_gender": "x", "patient_language": "en", "diagnosis_code_1": "c", "diagnosis_desc_1": "d",
        "rendering_provider": "r", "pcp_name": "p", "clinic_desc": "k", "date_ingested": "2024-01-01",
    }
    out = rows.select(
        F.concat(F.lit(" "), F.expr(FIRST)).alias("mem_first_name"),
        F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("mem_last_name"),
        F.expr(DISEASE).alias("diagnosis"),
        F.col("o_orderpriority").alias("division"),
        F.lit("v2" if v2 else "v1").alias("market"),
        text("born").alias("patient_date_of_birth"),
        text("born").alias("date_of_service"),
        *[F.lit(v).cast("string").alias(k) for k, v in constant.items()],
    )
    return with_missing(out, ADDED_IN_V2) if v2 else out


def _dim_users(t: Tables) -> DataFrame:
    off = F.when(F.col("c_nationkey") % 9 == 0, F.date_add("born", 1)).otherwise(F.col("born"))
    one = _born(t).select(
        F.concat(F.lit("u"), F.col("c_custkey")).alias("uid"),
        off.alias("date_of_birth"),
        F.concat(F.lit("promo"), F.col("c_nationkey") % 8).alias("promo"),
        F.col("c_name").alias("first_name"),
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("last_name"),
    )
    again = one.withColumns({"uid": F.concat(F.lit("w"), "uid"), "promo": F.lit("promo5")})
    return one.unionByName(again.filter(F.col("first_name").endswith("7")))


@query(
    "member_match",
    f"""
    WITH born AS (SELECT *, DATE '1930-01-01' + CAST(c_custkey % 30000 AS INTEGER) AS born FROM customer),
    sub AS (
        SELECT {FIRST} AS first_name, c_mktsegment AS last_name,
               CASE WHEN o_orderstatus = 'P' AND {DISEASE} = 'COPD' THEN 'copd' ELSE {DISEASE} END AS disease,
               o_orderpriority AS division, CASE WHEN o_orderstatus = 'P' THEN 'v2' ELSE 'v1' END AS market,
               CASE WHEN c_nationkey % 6 = 5 THEN NULL
                    WHEN c_nationkey % 5 = 0 THEN CASE WHEN o_orderstatus <> 'P' THEN born END
                    WHEN c_nationkey % 5 = 4 THEN NULL
                    ELSE make_date(CASE WHEN year(born) % 100 >= 69 THEN 1900 ELSE 2000 END + year(born) % 100,
                                   month(born), day(born)) END AS served
        FROM born JOIN orders ON c_custkey = o_custkey),
    dated AS (
        SELECT *, CASE WHEN served > DATE '2024-06-01' THEN CAST(served - INTERVAL 100 YEAR AS DATE) ELSE served END AS dob FROM sub),
    users AS (
        SELECT 'u' || c_custkey AS uid, CASE WHEN c_nationkey % 9 = 0 THEN born + 1 ELSE born END AS dob_user,
               'promo' || (c_nationkey % 8) AS promo, upper(c_name) AS first_user, c_mktsegment AS last_user FROM born
        UNION ALL
        SELECT 'wu' || c_custkey, CASE WHEN c_nationkey % 9 = 0 THEN born + 1 ELSE born END, 'promo5',
               upper(c_name), c_mktsegment FROM born WHERE c_name LIKE '%7'),
    joined AS (
        SELECT d.*, CASE WHEN dob = dob_user AND promo IN ('promo0','promo1','promo2','promo3','promo4','promo5') THEN uid END AS uid,
               CASE WHEN dob = dob_user AND promo IN ('promo0','promo1','promo2','promo3','promo4','promo5') THEN promo END AS promo
        FROM dated d LEFT JOIN users ON levenshtein(first_name, first_user) < 1 AND levenshtein(last_name, last_user) < 1),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY first_name, last_name, disease, division, market, dob, served
                                     ORDER BY uid DESC NULLS LAST, promo DESC NULLS LAST) AS rn FROM joined)
    SELECT first_name, last_name, disease, division, market, strftime(dob, '%Y-%m-%d') AS date_of_birth,
           strftime(served, '%Y-%m-%d') AS date_of_service, uid, promo, '2024-06-01T00:00:00.000Z' AS datetime_modified
    FROM ranked WHERE rn = 1
    """.replace("levenshtein(first_name, first_user) < 1", "first_name = first_user").replace(
        "levenshtein(last_name, last_user) < 1", "last_name = last_user"
    ),
)
def members(t: Tables) -> DataFrame:
    """Submissions of two file versions matched to users by name, birth date and promotion."""
    today = F.lit("2024-06-01").cast("date")
    files = submissions(_client_file(t, False), _client_file(t, True))
    found = match_members(files, _dim_users(t), MEMBER_RULES, today=today, now=ts_literal("2024-06-01T00:00:00Z"))
    return found.select(
        "first_name",
        "last_name",
        "disease",
        "division",
        "market",
        F.date_format("date_of_birth", "yyyy-MM-dd").alias("date_of_birth"),
        F.date_format("date_of_service", "yyyy-MM-dd").alias("date_of_service"),
        "uid",
        "promo",
        iso_ms(F.col("datetime_modified")).alias("datetime_modified"),
    )


@query(
    "date_two_digit",
    """
    SELECT o_orderkey,
           strftime(CAST(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE
               CASE WHEN moved > DATE '2024-06-01' THEN moved - INTERVAL 100 YEAR ELSE moved END END AS DATE), '%Y-%m-%d') AS born
    FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate + INTERVAL 40 YEAR AS DATE)
                         ELSE TRY_CAST(printf('%04d-%02d-%02d', CASE WHEN y % 100 >= 69 THEN 1900 ELSE 2000 END + y % 100,
                                              month(o_orderdate), day(o_orderdate)) AS DATE) END AS moved
          FROM (SELECT *, year(o_orderdate) - (o_custkey % 60) AS y FROM orders))
    """,
)
def two_digit(t: Tables) -> DataFrame:
    """Short and long dates by tag. A leap day of a year that has none reads as null."""
    day = F.col("o_orderdate")
    year = F.year(day) - F.col("o_custkey") % 60
    short = F.concat(F.month(day), F.lit("/"), F.dayofmonth(day), F.lit("/"), F.lpad((year % 100).cast("string"), 2, "0"))
    long = F.date_format(F.add_months(day, 480), "M/d/yyyy")
    text = F.when(F.col("o_orderstatus") == "F", long).otherwise(short)
    parsed = parse_us_date(text, F.col("o_orderstatus"), four_digit_tags=["F"], two_digit_tags=["P"])
    return t.orders.select(
        "o_orderkey", F.date_format(not_after(parsed, F.lit("2024-06-01").cast("date")), "yyyy-MM-dd").alias("born")
    )


@query(
    "parse_any_ts",
    f"""
    SELECT event_id, strftime(CASE event_id % 9
        WHEN 0 THEN date_trunc('milliseconds', ts) WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('day', ts)
        WHEN 3 THEN date_trunc('second', ts) WHEN 4 THEN date_trunc('second', ts) - INTERVAL 5 HOUR
        WHEN 5 THEN date_trunc('minute', ts) WHEN 6 THEN date_trunc('second', ts)
        WHEN 7 THEN date_trunc('milliseconds', ts) END, '{SQL_ISO_US}') AS parsed,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS iso
    FROM events
    """,
)
def any_ts(t: Tables) -> DataFrame:
    seconds = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    forms = [
        iso_ms(F.col("ts")),
        F.concat(seconds, F.lit("Z")),
        F.date_format("ts", "yyyy-MM-dd"),
        seconds,
        F.concat(seconds, F.lit("+0500")),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"), F.lit("Z")),
        F.concat(seconds, F.lit("+00:00")),
        F.unix_millis("ts").cast("string"),
        F.lit("garbage"),
    ]
    text = F.element_at(F.array(*forms), (F.col("event_id") % 9 + 1).cast("int"))
    return t.events.select(
        "event_id",
        F.date_format(parse_any_ts(text), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("parsed"),
        iso_ms(F.col("ts")).alias("iso"),
    )


@query(
    "union_file_versions",
    """
    SELECT trim(' ' || s_name || ' ') AS name, CAST(s_nationkey AS VARCHAR) AS nation, CAST(NULL AS INTEGER) AS rank FROM supplier
    UNION ALL
    SELECT c_name, CAST(c_nationkey AS VARCHAR), CAST(c_custkey % 10 AS INTEGER) FROM customer
    """,
)
def file_versions(t: Tables) -> DataFrame:
    v1 = t.supplier.select(F.concat(F.lit(" "), "s_name", F.lit(" ")).alias("the name"), F.col("s_nationkey").alias("nation"))
    v2 = t.customer.select(
        F.col("c_nationkey").alias("nation"), F.col("c_name").alias("the name"), (F.col("c_custkey") % 10).cast("int").alias("rank")
    )
    both = union_versions(with_missing(v1, {"rank": "int"}), v2)
    return select_trimmed(both, {"the name": "name", "nation": "nation", "rank": "rank"}).withColumn(
        "rank", F.col("rank").try_cast("int")
    )


@query(
    "text_functions",
    """
    SELECT p_partkey, upper(trim(' ' || p_name || ' ')) AS cleaned, replace(p_brand, 'Brand', 'brand') AS tag,
           CAST(levenshtein(p_name, p_type) AS INTEGER) AS apart, substr(p_brand, 7) AS number,
           substr(p_name, 1, 5) AS cut
    FROM part
    """,
)
def texts(t: Tables) -> DataFrame:
    rows = t.part.select(
        "p_partkey",
        clean_name(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("cleaned"),
        F.regexp_replace("p_brand", "Brand", "brand").alias("tag"),
        F.levenshtein("p_name", "p_type").alias("apart"),
        strip_prefix(F.col("p_brand"), "Brand#").alias("number"),
        F.col("p_name").alias("cut"),
    )
    return truncate_to_width(rows, {"cut": 5})


LOOSE_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("shipped", T.DateType()),
        T.StructField("returned", T.BooleanType()),
    ]
)


def _loose(t: Tables) -> DataFrame:
    q = F.col("l_quantity").cast("int").cast("string")
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.when(F.col("l_linenumber") == 7, F.lit("many")).otherwise(q).alias("quantity"),
        F.when(F.col("l_discount") == 0.1, F.lit("-")).otherwise(F.col("l_extendedprice").cast("string")).alias("price"),
        F.when(F.col("l_returnflag") == "R", F.lit("soon")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("shipped"),
        F.when(F.col("l_linestatus") == "O", F.lit("true")).otherwise(F.lit("maybe")).alias("returned"),
    )


LOOSE_SQL = """
    SELECT l_orderkey, CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS quantity,
           CASE WHEN l_discount <> 0.1 THEN l_extendedprice END AS price,
           CASE WHEN l_returnflag <> 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END AS shipped,
           CASE WHEN l_linestatus = 'O' THEN true END AS returned
    FROM lineitem
"""


@query("conform_to_schema", LOOSE_SQL)
def conformed(t: Tables) -> DataFrame:
    return conform(_loose(t), LOOSE_SCHEMA).withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


@query(
    "conform_failures",
    """
    SELECT CAST(0 AS BIGINT) AS l_orderkey, count(*) FILTER (l_linenumber = 7) AS quantity, count(*) FILTER (l_discount = 0.1) AS price,
           count(*) FILTER (l_returnflag = 'R') AS shipped, count(*) FILTER (l_linestatus <> 'O') AS returned,
           CAST(count(*) FILTER (l_linenumber = 7) + count(*) FILTER (l_discount = 0.1) + count(*) FILTER (l_returnflag = 'R')
           + count(*) FILTER (l_linestatus <> 'O') AS BIGINT) AS total
    FROM lineitem
    """,
)
def failures(t: Tables) -> DataFrame:
    return cast_failures(_loose(t), LOOSE_SCHEMA)


@query("contract_kept", f"SELECT * FROM ({LOOSE_SQL}) WHERE price IS NOT NULL")
def contract(t: Tables) -> DataFrame:
    good, _ = split_contract(conform(_loose(t), LOOSE_SCHEMA), LOOSE_SCHEMA)
    return good.withColumn("shipped", F.date_format("shipped", "yyyy-MM-dd"))


@query("contract_broken", f"SELECT l_orderkey, 'price' AS lacking FROM ({LOOSE_SQL}) WHERE price IS NULL")
def contract_breaches(t: Tables) -> DataFrame:
    rows = conform(_loose(t), LOOSE_SCHEMA).withColumn("_errors", contract_errors(LOOSE_SCHEMA))
    return rows.filter(F.size("_errors") > 0).select("l_orderkey", F.array_join("_errors", ",").alias("lacking"))


@query("drop_empty_columns", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_custkey END AS sometimes FROM orders")
def empty_columns(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.col("o_custkey")).alias("sometimes"),
        F.when(F.col("o_totalprice") < 0, F.lit("x")).alias("never"),
    )
    return drop_empty_columns(rows)
