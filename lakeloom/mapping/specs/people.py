"""Bronze tables about people: providers, caregivers, patients, prospects, logins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeloom.functions.nested import has_key
from lakeloom.mapping.spec import (
    Body,
    Derived,
    Mapping,
    flagged,
    group,
    if_missing,
    listing,
    not_null,
    optional,
    required,
)
from lakeloom.mapping.specs.common import (
    EPOCH,
    channel,
    parsed_date,
    plain_address,
    profile_sections,
    user_group,
)

IDENTITY = [
    required("given_name"),
    required("time_zone"),
    required("family_name"),
    required("email"),
    required("language"),
    required("date_created", "createdDate"),
    required("role"),
]

DIGEST = group("digest", [required("digest_email", "email", "boolean")], shape="inline", rule="required")


def _preferences(body: Body) -> Column:
    sent = body["preferences"]
    return F.struct(
        sent["portalWelcomeDone"].alias("portal_welcome_done"),
        sent["weekendDigests"].alias("weekend_digests"),
        sent["patientsHidden"].alias("patients_hidden"),
        F.when(sent.isNotNull(), F.coalesce(sent["lastAnnouncement"], F.lit(""))).alias("last_announcement"),
    )


PROVIDER = Mapping(
    "provider",
    ("admin_created", "admin_deleted", "physician_created", "physician_deleted"),
    (
        *IDENTITY,
        user_group(rule="required"),
        Derived(
            "preferences",
            {
                "preferences": {
                    "portalWelcomeDone": "boolean",
                    "weekendDigests": "boolean",
                    "patientsHidden": "boolean",
                    "lastAnnouncement": "string",
                }
            },
            _preferences,
        ),
        group("notifications", [DIGEST], shape="filled", rule="required"),
        optional("phone"),
    ),
    keeps_args=True,
)

CAREGIVER = Mapping(
    "caregiver",
    ("caregiver_created", "caregiver_deleted"),
    (
        *IDENTITY,
        user_group(rule="required"),
        optional("phone"),
        group(
            "notifications",
            [
                DIGEST,
                channel("environmental", "environmental"),
                channel("quiet_sensor", "quietSensor"),
                channel("goal", "goal"),
                channel("rescue_usage", "rescueUsage"),
                channel("missed_dose", "missedDose"),
                channel("act_invite", "actInvite"),
                channel("notes", "notes"),
                channel("transition", "transition"),
                channel("at_risk", "atRisk"),
            ],
            shape="filled",
            rule="required",
        ),
        listing(
            "following",
            fields=[
                required("user_id", "id"),
                required("access_level"),
                required("given_name"),
                required("family_name"),
                required("role"),
                required("disease"),
            ],
        ),
        plain_address("mailing_address", "mailingAddress"),
    ),
)


def _conversion(body: Body) -> Column:
    converted = F.when(F.array_contains(body.args, "prospect"), body.call_time).otherwise(F.lit(EPOCH))
    return F.when(body.event_type.startswith("patient_created"), converted)


def _group_if_missing(body: Body) -> Column:
    there = has_key(body.variant, "$.body.group")
    return F.struct(
        F.when(there, body["group"]["name"]).otherwise(F.lit("-1")).alias("name"),
        F.when(there, body["group"]["displayName"]).otherwise(F.lit("-1")).alias("display_name"),
    )


def _group_incomplete(body: Body) -> Column:
    lacking = ~has_key(body.variant, "$.body.group.name") | ~has_key(body.variant, "$.body.group.displayName")
    return F.when(has_key(body.variant, "$.body.group") & lacking, F.lit("missing: group"))


GROUP_TYPE = {"group": {"name": "string", "displayName": "string"}}

PATIENT_FIELDS = (
    if_missing("given_name"),
    if_missing("time_zone"),
    if_missing("family_name"),
    if_missing("email"),
    if_missing("language"),
    if_missing("age", kind="int"),
    if_missing("birth_date"),
    if_missing("disease"),
    if_missing("baseline", kind="double"),
    not_null("role"),
    parsed_date("date_created", "createdDate"),
    Derived("group", GROUP_TYPE, _group_if_missing, _group_incomplete),
    flagged("phone"),
    *profile_sections(),
    flagged("unique_external_id"),
    Derived("prospect_conversion_datetime", {}, _conversion),
)

PATIENT = Mapping(
    "patient",
    (
        "medication_updated",
        "patient_created",
        "patient_deleted",
        "patient_followed",
        "patient_reactivated",
        "patient_unfollowed",
        "patient_updated",
        "sensor_created",
        "sensor_deleted",
    ),
    PATIENT_FIELDS,
)


def _changed_medication(body: Body) -> Column:
    first = F.get(body.args, F.lit(0))
    return F.when(first.startswith("{"), F.get_json_object(first, "$.mid")).otherwise(first)


MEDICATION = Mapping(
    "medication",
    ("medication_created", "medication_deleted"),
    (
        *PATIENT_FIELDS,
        Derived(
            "medication_changed",
            {},
            _changed_medication,
            check=lambda body: F.when(F.get(body.args, F.lit(0)).isNull(), F.lit("missing: pubSubArgs[0]")),
        ),
        Derived("medication_changed_date", {}, lambda body: body.call_time),
    ),
)

PATIENT_LOGIN = Mapping("patient_login", ("patient_login",))


def _group_or_default(body: Body) -> Column:
    there = body["group"].isNotNull()
    return F.struct(
        F.when(there, body["group"]["name"]).otherwise(F.lit("-1")).alias("name"),
        F.when(there, body["group"]["displayName"]).otherwise(F.lit("-1")).alias("display_name"),
    )


def _group_fields_missing(body: Body) -> Column:
    lacking = ~has_key(body.variant, "$.body.group.name") | ~has_key(body.variant, "$.body.group.displayName")
    return F.when(body["group"].isNotNull() & lacking, F.lit("missing: group"))


PROSPECT = Mapping(
    "prospect",
    ("prospect_created", "prospect_deleted", "prospect_updated"),
    (
        not_null("role"),
        parsed_date("date_created", "createdDate"),
        flagged("email"),
        flagged("phone"),
        flagged("unique_external_id"),
        flagged("oidcidtoken"),
        Derived("has_group", GROUP_TYPE, lambda body: body["group"].isNotNull()),
        Derived("group", GROUP_TYPE, _group_or_default, _group_fields_missing),
        flagged("given_name"),
        flagged("time_zone"),
        flagged("family_name"),
        flagged("language"),
        flagged("age", kind="int"),
        flagged("birth_date"),
        flagged("disease"),
        *profile_sections(),
    ),
)

MAPPINGS = [PROVIDER, CAREGIVER, PATIENT, MEDICATION, PATIENT_LOGIN, PROSPECT]
