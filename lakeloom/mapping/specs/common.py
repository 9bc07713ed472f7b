"""Sub-specifications shared by several bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeloom.functions.nested import has_key, holds_value, objects, some_lack
from lakeloom.functions.times import iso_ms, parse_any_ts
from lakeloom.mapping.spec import (
    SENTINELS,
    Body,
    Derived,
    Scope,
    ddl,
    flagged,
    group,
    if_null,
    listing,
    optional,
    required,
    with_defaults,
)

EPOCH = SENTINELS["datetime"]


def channel(name: str, source: str, **options):
    """One notification channel: ``<name>_email``, ``_sms`` and ``_push``."""
    return group(
        name,
        [required(f"{name}_{way}", way, "boolean") for way in ("email", "sms", "push")],
        source=source,
        shape="inline",
        **options,
    )


def user_group(**options):
    return group("group", [required("name"), required("display_name")], **options)


def plain_address(name: str, source: str):
    """Postal address, optional as a whole, with an empty string for a missing second line."""
    return group(
        name,
        [
            required("street"),
            required("city"),
            required("country"),
            optional("postal_code"),
            optional("state_or_region"),
            if_null("street2", default=""),
            optional("state_code"),
        ],
        source=source,
    )


def flagged_address():
    """Postal address of a patient or prospect: always a struct, with presence flags."""
    ways = ["street", "city", "country"]
    options = ["postal_code", "state_or_region", "street2", "state_code"]

    def line(name: str):
        def build(body: Body) -> Column:
            there = body["mailingAddress"].isNotNull()
            return F.when(there, body["mailingAddress"][name]).otherwise(F.lit("-1"))

        return build

    fields = [required(name) for name in ways] + [flagged(name) for name in options]

    def build(body: Body) -> Column:
        address = body["mailingAddress"]
        parts = [line(name)(body).alias(name) for name in ways]
        for f in fields[len(ways):]:
            parts += [c.alias(n) for n, c in f.columns(Scope(address, None))]
        return F.struct(*parts)

    checks = group("mailing_address", [required(name) for name in ways])
    return Derived(
        "mailing_address",
        checks.types() | {"mailingAddress": {f.sources[0]: "string" for f in fields}},
        build,
        check=lambda body: F.coalesce(*checks.errors(Scope(body.typed, body.variant))),
    )


def person_fields(*, disease: bool):
    fields = [
        flagged("user_id", "id"),
        flagged("access_level"),
        flagged("given_name"),
        flagged("family_name"),
        flagged("role"),
    ]
    return fields + [flagged("disease")] if disease else fields


def parsed_date(name: str, source: str):
    """A date that must be readable, re-formatted to ISO milliseconds."""

    def check(body: Body) -> Column:
        return (
            F.when(~has_key(body.variant, f"$.body.{source}"), F.lit(f"missing: {source}"))
            .when(parse_any_ts(body[source]).isNull(), F.lit(f"format: {source}"))
        )

    return Derived(name, {source: "string"}, lambda body: iso_ms(parse_any_ts(body[source])), check)


def measure(name: str):
    """A number, or an object holding it under ``value``, with a presence flag."""

    def number(body: Body) -> Column:
        value = body[name]
        return F.coalesce(F.try_variant_get(value, "$", "double"), F.try_variant_get(value, "$.value", "double"))

    def there(body: Body) -> Column:
        return holds_value(body.variant, f"$.body.{name}")

    return [
        Derived(f"has_{name}", {name: "variant"}, there),
        Derived(
            name,
            {name: "variant"},
            lambda body: F.coalesce(number(body), F.lit(SENTINELS["double"])),
            check=lambda body: F.when(there(body) & number(body).isNull(), F.lit(f"type: {name}")),
        ),
    ]


# Notification channels of patients and prospects. The missed-dose channel has no flag.


def notifications():
    names = {
        "notes": "notes",
        "missed_dose": "missedDose",
        "rescue_usage": "rescueUsage",
        "goal": "goal",
        "quiet_sensor": "quietSensor",
        "act_invite": "actInvite",
        "transition": "transition",
        "environmental": "environmental",
        "at_risk": "atRisk",
    }
    renamed = {"act_invite": "questionnaire"}
    unflagged = {"missed_dose"}
    three = {"email": "boolean", "sms": "boolean", "push": "boolean"}
    reads = {"digest": {"email": "boolean"}}
    reads |= {source: dict(three) for source in [*names.values(), *renamed.values()]}

    def build(body: Body) -> Column:
        sent = body["notifications"]
        digest = sent["digest"]
        parts = [
            digest.isNotNull().alias("has_digest"),
            F.when(digest.isNotNull(), digest["email"]).otherwise(F.lit(False)).alias("digest_email"),
        ]
        for name, source in names.items():
            way = sent[source]
            if name in renamed:
                way = F.coalesce(way, sent[renamed[name]])
            if name not in unflagged:
                parts.append(way.isNotNull().alias(f"has_{name}"))
            for kind in three:
                parts.append(F.when(way.isNotNull(), way[kind]).otherwise(F.lit(False)).alias(f"{name}_{kind}"))
        return F.struct(*parts)

    def check(body: Body) -> Column:
        sent = body["notifications"]
        found = [_missing_in(body.variant, sent["digest"], "digest", ["email"])]
        for name, source in names.items():
            found.append(_missing_in(body.variant, sent[source], source, three))
            if name in renamed:
                unused = F.when(sent[source].isNull(), sent[renamed[name]])
                found.append(_missing_in(body.variant, unused, renamed[name], three))
        return F.coalesce(*found)

    return Derived("notifications", {"notifications": reads}, build, check)


def _missing_in(variant: Column, way: Column, source: str, kinds) -> Column:
    lacking = [way[kind].isNull() & ~has_key(variant, f"$.body.notifications.{source}.{kind}") for kind in kinds]
    some = lacking[0]
    for one in lacking[1:]:
        some = some | one
    return F.when(way.isNotNull() & some, F.lit(f"missing: notifications.{source}"))


# Medications, dose times and sensors of the treatment plan.

SENSOR_FIELDS = [
    required("mac"),
    flagged("battery", ("battery", "batteryLevel"), "int"),
    flagged("data_link", kind="boolean"),
    flagged("first_sync_date", kind="datetime"),
    flagged("firmware_version"),
    flagged("force_silent", kind="boolean"),
    flagged("last_sync_date", kind="datetime"),
    flagged("model"),
    flagged("ready_date", kind="datetime"),
    flagged("silent", kind="boolean"),
]


def _sensor_type() -> dict:
    out: dict = {}
    for f in SENSOR_FIELDS:
        out |= f.types()
    return out


PLAN = {
    "plan": {
        "medications": [
            {
                "medication": {"id": "string", "type": "string"},
                "dataLink": "boolean",
                "effectivePeriod": {"start": "string", "end": "string"},
                "status": "string",
                "usageList": [{"hour": "int", "minute": "int", "doses": "int", "unitDoses": "int"}],
                "sensors": [_sensor_type()],
            }
        ]
    }
}


def _plan(body: Body) -> Column:
    items = body["plan"]["medications"]
    return F.when(F.size(items) > 0, items)


def _children(body: Body, source: str, build) -> Column:
    """Children of all medications in one array; null when there are none at all."""
    per_medication = F.transform(
        _plan(body), lambda m: F.coalesce(F.transform(m[source], lambda child: build(m, child)), F.array())
    )
    everything = F.flatten(per_medication)
    return F.when(F.size(everything) > 0, everything)


def _medication(m: Column) -> Column:
    period = m["effectivePeriod"]
    there = period.isNotNull()
    return F.struct(
        m["medication"]["id"].alias("medication_id"),
        m["dataLink"].isNotNull().alias("has_data_link"),
        F.coalesce(m["dataLink"], F.lit(False)).alias("data_link"),
        there.alias("has_effective_period_start"),
        F.when(there, period["start"]).otherwise(F.lit(EPOCH)).alias("effective_period_start"),
        there.alias("has_effective_period_end"),
        F.coalesce(period["end"], F.lit(EPOCH)).alias("effective_period_end"),
        m["status"].isNotNull().alias("has_status"),
        F.coalesce(m["status"], F.lit("-1")).alias("status"),
    )


def _dose_time(m: Column, use: Column) -> Column:
    return F.struct(
        m["medication"]["id"].alias("medication_id"),
        use["hour"].alias("hour"),
        use["minute"].alias("minute"),
        F.coalesce(use["doses"], use["unitDoses"]).alias("doses"),
    )


def _sensor(m: Column, sensor: Column, fields=None) -> Column:
    kind = m["medication"]["type"]
    parts = [c.alias(n) for f in (fields or SENSOR_FIELDS) for n, c in f.columns(Scope(sensor, None))]
    return F.struct(
        parts[0],
        m["medication"]["id"].alias("medication_id"),
        kind.isNotNull().alias("has_medication_type"),
        F.coalesce(kind, F.lit("-1")).alias("medication_type"),
        *parts[1:],
    )


def _blank_medication() -> Column:
    nothing = F.lit(None).cast(ddl(PLAN["plan"]["medications"][0]))
    return _medication(nothing).withField("medication_id", F.lit("-1"))


def _blank_sensor() -> Column:
    nothing = F.lit(None).cast(ddl(PLAN["plan"]["medications"][0]))
    sensor = F.lit(None).cast(ddl(_sensor_type()))
    blank = _sensor(nothing, sensor, [with_defaults(f) for f in SENSOR_FIELDS])
    return blank.withField("medication_id", F.lit("-1"))


def _blank_dose_time() -> Column:
    return F.struct(
        F.lit("-1").alias("medication_id"),
        F.lit(-1).alias("hour"),
        F.lit(-1).alias("minute"),
        F.lit(-1).alias("doses"),
    )


def _plan_check(body: Body) -> Column:
    def suspect(m: Column) -> Column:
        doses = F.exists(m["usageList"], lambda u: u["hour"].isNull() | u["minute"].isNull())
        sensors = F.exists(m["sensors"], lambda s: s["mac"].isNull())
        return m["medication"]["id"].isNull() | F.coalesce(doses, F.lit(False)) | F.coalesce(sensors, F.lit(False))

    def lacking(m: Column) -> Column:
        return (
            ~has_key(m, "$.medication.id")
            | some_lack(m, "$.usageList", "hour", "minute")
            | some_lack(m, "$.sensors", "mac")
        )

    medications = objects(body.variant, "$.body.plan.medications")
    return F.when(
        F.exists(_plan(body), suspect) & F.exists(medications, lacking), F.lit("missing: plan.medications[]")
    )


def plan_sections():
    def section(name: str, items, blank):
        return [
            Derived(f"has_{name}", PLAN, lambda body: items(body).isNotNull()),
            Derived(name, PLAN, lambda body: F.coalesce(items(body), F.array(blank()))),
        ]

    return [
        Derived("has_medications", PLAN, lambda body: _plan(body).isNotNull(), check=_plan_check),
        Derived(
            "medications",
            PLAN,
            lambda body: F.coalesce(F.transform(_plan(body), _medication), F.array(_blank_medication())),
        ),
        *section("usage_list", lambda body: _children(body, "usageList", _dose_time), _blank_dose_time),
        *section("sensors", lambda body: _children(body, "sensors", _sensor), _blank_sensor),
    ]


def first_last_fields(*, first_by_key: bool):
    """First and last dates, over all and per kind of medication."""
    names = ["first", "first_controller", "first_rescue", "last", "last_controller", "last_rescue"]
    fields = [flagged(name, kind="datetime") for name in names]
    if first_by_key:
        fields[0] = first_sync()
    return fields


def first_sync():
    """First synchronization: its flag tests the key only, so a JSON null stays null."""
    return _FirstSync()


class _FirstSync:
    rule = "optional"

    def types(self) -> dict:
        return {"first": "string"}

    def columns(self, scope: Scope):
        there = scope.has_key("first")
        return [("has_first", there), ("first", F.when(there, scope.typed["first"]).otherwise(F.lit(EPOCH)))]

    def errors(self, scope: Scope):
        return []


class SyncCount:
    """Sync counter: whether it is there depends on ``sync``, its value is ``total``."""

    rule = "optional"

    def types(self) -> dict:
        return {"sync": "string", "total": "cut"}

    def columns(self, scope: Scope):
        there = scope.typed["sync"].isNotNull()
        return [("has_count", there), ("count", F.when(there, scope.typed["total"]).otherwise(F.lit(-1)))]

    def errors(self, scope: Scope):
        return [F.when(scope.typed["sync"].isNotNull() & scope.typed["total"].isNull(), F.lit("missing: sync.total"))]


def activity_sections():
    """Event and synchronization summaries of a patient or prospect."""
    return [
        group(
            "event",
            [*first_last_fields(first_by_key=False), flagged("count_rescue", "totalRescue", "cut")],
            shape="filled",
            flag=True,
        ),
        group("sync", [*first_last_fields(first_by_key=True), SyncCount()], shape="filled", flag=True),
    ]


def profile_sections():
    """Everything patients and prospects have in common after their basic fields."""
    return [
        listing("followers", fields=person_fields(disease=False), empty="default"),
        listing("following", fields=person_fields(disease=True), empty="default"),
        notifications(),
        *plan_sections(),
        flagged_address(),
        flagged("gender"),
        *measure("height"),
        listing(
            "medical_ids",
            ("medicalIds", "externalIds"),
            [required("key"), required("value")],
            empty="default",
            flag=True,
        ),
        group(
            "hub",
            [flagged("id"), flagged("external_id"), flagged("type"), flagged("region")],
            shape="filled",
            flag=True,
        ),
        *measure("weight"),
        flagged("race"),
        group(
            "clinical_trial",
            [flagged("id", "clinicalTrialId"), flagged("arm_id", "clinicalTrialArmId"), flagged("status")],
            shape="filled",
            flag=True,
        ),
        *activity_sections(),
        flagged("is_fake_birth_date", kind="boolean"),
        flagged("is_fake_name", kind="boolean"),
        flagged("is_phone_mobile", kind="boolean"),
        listing(
            "active_sponsorship_quotes",
            fields=[required("id", "quoteId"), required("name", "sponsorName")],
            empty="default",
            flag=True,
        ),
        listing("triggers", empty="default", flag=True),
        Derived(
            "hispanic",
            {"hispanic": "string"},
            lambda body: F.when(body["hispanic"] == "null", F.lit("no answer")).otherwise(body["hispanic"]),
        ),
    ]
