"""Members submitted by a client, matched to known users."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeloom.functions.texts import clean_name
from lakeloom.functions.times import not_after, parse_us_date
from lakeloom.operators.conform import ErrorBudget, select_trimmed, truncate_to_width, union_versions, with_missing
from lakeloom.sinks.publish import Report, publish

# Columns of the submitted files and their names in the output.
SUBMITTED = {
    "zip": "address_postal_code",
    "address-1": "address_street_1",
    "address-2": "address_street_2",
    "city": "address_city",
    "diagnosis": "disease",
    "email": "email",
    "mem_first_name": "first_name",
    "mem_last_name": "last_name",
    "phone nbr": "phone_number",
    "state": "address_state_code",
    "client name": "client_name",
    "division": "division",
    "market": "market",
    "medical_record_number": "medical_record_number",
    "patient_gender": "patient_gender",
    "patient_language": "patient_language",
    "patient_date_of_birth": "date_of_birth",
    "date_of_service": "date_of_service",
    "diagnosis_code_1": "diagnosis_code_1",
    "diagnosis_desc_1": "diagnosis_desc_1",
    "rendering_provider": "rendering_provider",
    "pcp_name": "pcp_name",
    "clinic_desc": "clinic_desc",
    "date_ingested": "date_ingested",
    "cerner_person_id": "cerner_person_id",
    "group_display_name": "group_display_name",
    "address_country_code": "address_country_code",
}
ADDED_IN_V2 = {"cerner_person_id": "int", "group_display_name": "string", "address_country_code": "string"}

# Columns of the output table in order, their types, and which must not be null.
TABLE = T.StructType(
    [
        T.StructField(name, {"date": T.DateType(), "timestamp": T.TimestampType(), "int": T.IntegerType()}.get(kind, T.StringType()), nullable)
        for name, kind, nullable in [
            ("uid", "string", True),
            ("promo", "string", True),
            ("date_ingested", "date", False),
            ("client_name", "string", True),
            ("first_name", "string", True),
            ("last_name", "string", True),
            ("email", "string", True),
            ("address_street_1", "string", True),
            ("address_street_2", "string", True),
            ("address_city", "string", True),
            ("address_state_code", "string", True),
            ("address_postal_code", "string", True),
            ("phone_number", "string", True),
            ("disease", "string", True),
            ("division", "string", True),
            ("market", "string", True),
            ("medical_record_number", "string", True),
            ("patient_gender", "string", True),
            ("patient_language", "string", True),
            ("date_of_birth", "date", True),
            ("date_of_service", "date", True),
            ("diagnosis_code_1", "string", True),
            ("diagnosis_desc_1", "string", True),
            ("rendering_provider", "string", True),
            ("pcp_name", "string", True),
            ("clinic_desc", "string", True),
            ("datetime_modified", "timestamp", False),
            ("cerner_person_id", "int", True),
            ("group_display_name", "string", True),
            ("address_country_code", "string", True),
        ]
    ]
)

# Which disease tags come with which date form.
FOUR_DIGIT_TAGS = ["COPD"]
TWO_DIGIT_TAGS = ["ASTHMA", "copd", "Asthma"]


@dataclass(frozen=True)
class MatchRules:
    """What differs from client to client."""

    promotions: tuple[str, ...]
    four_digit_tags: tuple[str, ...] = tuple(FOUR_DIGIT_TAGS)
    two_digit_tags: tuple[str, ...] = tuple(TWO_DIGIT_TAGS)
    normalize: str = "dim"  # "dim": only the users' names are upper-cased; "both": both sides
    widths: dict[str, int] = field(default_factory=dict)


def submissions(v1: DataFrame, v2: DataFrame) -> DataFrame:
    """Both file versions under the output names, trimmed; v2 writes its COPD tag in lower case."""
    v2 = v2.withColumn("diagnosis", F.regexp_replace("diagnosis", "COPD", "copd"))
    both = union_versions(with_missing(v1, ADDED_IN_V2), v2)
    named = select_trimmed(both, SUBMITTED)
    return named.withColumns(
        {
            "date_ingested": F.col("date_ingested").try_cast("date"),
            "cerner_person_id": F.col("cerner_person_id").try_cast("int"),
        }
    )


def with_dates(rows: DataFrame, rules: MatchRules, today: Column) -> DataFrame:
    """Read both dates by the row's tag; a birth date in the future is a century too late."""

    def read(name: str) -> Column:
        return parse_us_date(
            F.col(name), F.col("disease"), four_digit_tags=rules.four_digit_tags, two_digit_tags=rules.two_digit_tags
        )

    return rows.withColumns({"date_of_birth": not_after(read("date_of_birth"), today), "date_of_service": read("date_of_service")})


def user_candidates(users: DataFrame, rules: MatchRules) -> DataFrame:
    """Users that can match at all: one row per name and birth date, the best by (uid, promo).

    Only a user with an allowed promotion and the same birth date passes its id on,
    and of several the greatest id wins. Reducing the users to that before the join
    leaves at most one partner per submission, however common a name is.
    """
    return (
        users.select(
            clean_name(F.col("first_name")).alias("user_first_name"),
            clean_name(F.col("last_name")).alias("user_last_name"),
            F.col("date_of_birth").cast("date").alias("user_date_of_birth"),
            F.col("uid").cast("string").alias("uid"),
            F.col("promo").cast("string").alias("promo"),
        )
        .filter(F.col("promo").isin(list(rules.promotions)))
        .groupBy("user_first_name", "user_last_name", "user_date_of_birth")
        .agg(F.max(F.struct("uid", "promo")).alias("user"))
    )


def match_members(
    submitted: DataFrame, users: DataFrame, rules: MatchRules, *, today: Column, now: Column
) -> DataFrame:
    """One row per distinct submission, with the matched ``uid`` and ``promo`` or nulls.

    Copies of a submission collapse before the join, and a submission has at most one
    partner, so the join neither multiplies rows nor needs another duplicate removal.
    """
    rows = with_dates(submitted, rules, today).dropDuplicates()
    candidates = user_candidates(users, rules)

    def name(column: str) -> Column:
        return clean_name(rows[column]) if rules.normalize == "both" else rows[column]

    joined = rows.join(
        candidates,
        [
            name("first_name") == candidates["user_first_name"],
            name("last_name") == candidates["user_last_name"],
            rows["date_of_birth"] == candidates["user_date_of_birth"],
        ],
        "left",
    )
    matched = joined.select(
        *rows.columns,
        F.col("user.uid").alias("uid"),
        F.col("user.promo").alias("promo"),
        now.cast("timestamp").alias("datetime_modified"),
    )
    return truncate_to_width(matched, rules.widths) if rules.widths else matched


def populate(
    v1: DataFrame,
    v2: DataFrame,
    users: DataFrame,
    target: str,
    rules: MatchRules,
    *,
    today: Column,
    now: Column,
    budget: ErrorBudget = ErrorBudget(),
    rejects: str | None = None,
) -> Report:
    """The whole job: both file versions matched, brought to the table's columns, and the table replaced."""
    matched = match_members(submissions(v1, v2), users, rules, today=today, now=now)
    return publish(matched, target, TABLE, budget=budget, rejects=rejects)
