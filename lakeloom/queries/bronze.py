"""One query per bronze mapping, over envelopes made of all events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from lakeloom.mapping.compiler import good_rows, map_events
from lakeloom.mapping.registry import MAPPINGS
from lakeloom.operators.conform import flatten_structs
from lakeloom.queries.base import Tables, query
from lakeloom.queries.feed import DEFAULT_ARGS, ENVELOPE_SQL, Arr, Obj, envelopes, sometimes as S, source_sql

EPOCH = "'1970-01-01T00:00:00.000Z'"
ARGS_SQL = """'["a' || (event_id % 5) || '",null,"7"]' AS pub_sub_args"""


def shown(rows: DataFrame) -> DataFrame:
    """Structs flattened one level, arrays and maps as JSON text, for comparison."""
    flat = flatten_structs(rows)
    keep_nulls = {"ignoreNullFields": "false"}
    return flat.select(
        *[
            F.to_json(f"`{f.name}`", keep_nulls).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.MapType))
            else F.col(f"`{f.name}`")
            for f in flat.schema
        ]
    )


def mapped(name: str, body: dict, columns: list[str], *, where: str = "true", args: str = DEFAULT_ARGS, envelope: str = ENVELOPE_SQL):
    """Register ``map_<name>``: the body to send, the columns to expect, the rows that are good."""
    types = MAPPINGS[name].event_types
    lines = ",\n".join([envelope, *columns])
    sql = f"SELECT {lines}\nFROM {source_sql(types, body)}\nWHERE {where}"

    @query(f"map_{name}", sql)
    def run(t: Tables) -> DataFrame:
        return shown(good_rows(map_events(envelopes(t, types, body, args), MAPPINGS[name])))

    return run


# SQL for the rules of absent values; a path is a column of the source.


def same(alias: str, path: str, kind: str | None = None) -> str:
    value = f'CAST("{path}" AS {kind})' if kind else f'"{path}"'
    return f"{value} AS {alias}"


def missing_only(alias: str, path: str, default: str, kind: str = "VARCHAR") -> str:
    return f'CAST(CASE WHEN "{path}" IS NOT NULL THEN "{path}" WHEN x THEN NULL ELSE {default} END AS {kind}) AS {alias}'


def or_default(alias: str, path: str, default: str, kind: str = "VARCHAR") -> str:
    return f'CAST(coalesce("{path}", {default}) AS {kind}) AS {alias}'


def with_flag(alias: str, path: str, default: str, kind: str = "VARCHAR", prefix: str = "") -> list[str]:
    return [f'"{path}" IS NOT NULL AS {prefix}has_{alias}', or_default(f"{prefix}{alias}", path, default, kind)]


def element(prefix: str, fields: list[tuple]) -> str:
    """Struct literal of (name, expression) pairs; a third item makes it flagged with that default."""
    parts = []
    for name, key, *default in fields:
        value = f'"{prefix}.{key}"' if key[0] not in "'-(" and not key[0].isdigit() else key
        if default:
            parts.append(f"'has_{name}': {value} IS NOT NULL")
            parts.append(f"'{name}': coalesce({value}, {default[0]})")
        else:
            parts.append(f"'{name}': {value}")
    return "{" + ", ".join(parts) + "}"


def json_list(alias: str, items: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    """JSON text of the elements whose marker holds."""
    some = " OR ".join(cond for cond, _ in items)
    listed = ", ".join(f"CASE WHEN {cond} THEN {value} END" for cond, value in items)
    return (
        f"CASE WHEN {some} THEN CAST(to_json(list_filter([{listed}], lambda z: z IS NOT NULL)) AS VARCHAR) "
        f"ELSE {otherwise} END AS {alias}"
    )


def json_text(value: str) -> str:
    return f"CAST(to_json([{value}]) AS VARCHAR)"


def has_required(*paths: str) -> str:
    """Rows where none of the required paths is missing (a JSON null is there)."""
    return " AND ".join(f'("{p}" IS NOT NULL OR x)' for p in paths)


# Small mappings.

mapped("patient_login", {}, [])
mapped(
    "datalake_message",
    {"type": S(1, "'t' || user_id"), "date": S(2, "'2024-01-01'")},
    [same("type", "type"), same("date", "date")],
)
mapped(
    "external_id",
    {"domain": S(0, "'d' || (user_id % 3)"), "key": "'k' || event_id", "value": S(1, "'v'"), "cardinality": "'one'"},
    [same("domain", "domain"), same('"key"', "key"), same('"value"', "value"), same("cardinality", "cardinality")],
    where=has_required("domain", "value"),
)
mapped(
    "sensor_sync",
    {"mac": "'mac' || user_id", "mid": S(3, "'m' || event_id")},
    [same("mac", "mac"), same("medication_id", "mid")],
    where=has_required("mid"),
)
mapped(
    "subgroup",
    {
        "id": S(0, "'s' || user_id"),
        "name": S(1, "'n' || user_id"),
        "displayName": S(2, "'N' || user_id"),
        "type": S(3, "'t'"),
        "externalIds": Arr(["'x' || event_id", "'y'"], ["event_id % 3 = 0", "event_id % 6 = 0"]),
    },
    [
        missing_only("subgroup_id", "id", "'-1'"),
        missing_only("name", "name", "'-1'"),
        missing_only("display_name", "displayName", "'-1'"),
        missing_only("type", "type", "'-1'"),
        json_list(
            "subgroup_external_ids",
            [('"externalIds.0"', '"externalIds.0.value"'), ('"externalIds.1"', '"externalIds.1.value"')],
            "CASE WHEN event_id % 4 <> 1 THEN '[]' END",
        ),
    ],
)
mapped(
    "patient_subgroup",
    {"subgroups": Arr(["'s' || user_id"], ["event_id % 3 = 0"])},
    [
        ARGS_SQL,
        json_list("subgroups", [('"subgroups.0"', '"subgroups.0.value"')], "CASE WHEN event_id % 4 <> 1 THEN '[]' END"),
        "'a' || (event_id % 5) AS subgroup_modified",
    ],
)
mapped(
    "act",
    {
        "answeredByUid": S(1, "'u' || event_id"),
        "score": S(2, "event_id % 25 + 0.5"),
        "ans": "concat('@@[', event_id % 5, ',3]@@')",
        "dateR": "'2024-01-02'",
        "dateS": S(3, "'2024-01-03'"),
        "type": "'act'",
    },
    [
        same("answered_by_user_id", "answeredByUid"),
        same("score", "score", "DOUBLE"),
        "'[' || (event_id % 5) || ',3]' AS answers",
        same("date_received", "dateR"),
        same("date_saved", "dateS"),
        same("type", "type"),
    ],
    where=has_required("score", "dateS"),
)
mapped(
    "cat",
    {
        "answeredByUid": S(0, "'u' || event_id"),
        "score": S(1, "event_id % 40 + 0.5"),
        "ans": S(2, "concat('@@{`q1`:', event_id % 5, '}@@')"),
        "dateR": S(3, "'2024-01-02'"),
        "dateC": "'2024-01-03'",
    },
    [
        same("answered_by_user_id", "answeredByUid"),
        same("score", "score", "DOUBLE"),
        """CASE WHEN "ans" IS NOT NULL THEN '{"q1":' || (event_id % 5) || '}' END AS answers""",
        same("date_received", "dateR"),
        same("date_created", "dateC"),
    ],
    where=has_required("score", "ans", "dateR"),
)
mapped(
    "patient_score",
    {"baseline": S(0, "value"), "dateR": S(1, "'2024-01-02'"), "score": S(2, "value / 2"), "disease": S(3, "'asthma'")},
    [
        missing_only("baseline", "baseline", "-1.0", "DOUBLE"),
        same("date", "dateR"),
        same("score", "score"),
        or_default("disease", "disease", "'-1'"),
    ],
    where='"dateR" IS NOT NULL AND "score" IS NOT NULL',
)

# People.

IDENTITY = {
    "givenName": "'gn' || user_id",
    "timeZone": "'tz' || (event_id % 3)",
    "familyName": S(0, "'fn' || user_id"),
    "email": "'e' || user_id",
    "language": S(1, "'en'"),
    "createdDate": "'2020-01-0' || (event_id % 9 + 1)",
    "role": "'role'",
    "group": Obj({"name": "'n' || (user_id % 5)", "displayName": S(2, "'N'")}),
    "phone": S(2, "'555-' || user_id"),
}
IDENTITY_SQL = [
    same("given_name", "givenName"),
    same("time_zone", "timeZone"),
    same("family_name", "familyName"),
    same("email", "email"),
    same("language", "language"),
    same("date_created", "createdDate"),
    same("role", "role"),
    same("group_name", "group.name"),
    same("group_display_name", "group.displayName"),
    same("phone", "phone"),
]
IDENTITY_GOOD = has_required("familyName", "language", "group.displayName")

mapped(
    "provider",
    IDENTITY
    | {
        "preferences": Obj(
            {
                "portalWelcomeDone": S(0, "event_id % 3 = 0"),
                "weekendDigests": S(1, "true"),
                "patientsHidden": S(2, "false"),
                "lastAnnouncement": S(3, "'ann' || event_id"),
            },
            "event_id % 5 <> 0",
        ),
        "notifications": Obj({"digest": Obj({"email": "event_id % 2 = 1"})}),
    },
    IDENTITY_SQL
    + [
        ARGS_SQL,
        same("preferences_portal_welcome_done", "preferences.portalWelcomeDone"),
        same("preferences_weekend_digests", "preferences.weekendDigests"),
        same("preferences_patients_hidden", "preferences.patientsHidden"),
        """CASE WHEN "preferences" THEN coalesce("preferences.lastAnnouncement", '') END AS preferences_last_announcement""",
        same("notifications_digest_email", "notifications.digest.email"),
    ],
    where=IDENTITY_GOOD,
)

CHANNELS = {
    "environmental": "environmental",
    "quiet_sensor": "quietSensor",
    "goal": "goal",
    "rescue_usage": "rescueUsage",
    "missed_dose": "missedDose",
    "act_invite": "actInvite",
    "notes": "notes",
    "transition": "transition",
    "at_risk": "atRisk",
}


def ways(n: int, when: str) -> Obj:
    return Obj({"email": f"(event_id + {n}) % 2 = 0", "sms": f"(event_id + {n}) % 3 = 0", "push": "true"}, when)


def person(n: int) -> dict:
    return {
        "id": f"'f{n}-' || user_id",
        "accessLevel": S(n, "'full'"),
        "givenName": S(n + 1, "'gn'"),
        "familyName": "'fn'",
        "role": S(n + 2, "'parent'"),
        "disease": S(n + 3, "'copd'"),
    }


PEOPLE_WHEN = ["event_id % 3 <> 0", "event_id % 6 = 1"]
PERSON = [
    ("user_id", "id"),
    ("access_level", "accessLevel"),
    ("given_name", "givenName"),
    ("family_name", "familyName"),
    ("role", "role"),
    ("disease", "disease"),
]
ADDRESS = {
    "street": "'st' || user_id",
    "city": "'ci'",
    "country": "'co'",
    "postalCode": S(0, "'pc'"),
    "stateOrRegion": S(1, "'sr'"),
    "street2": S(2, "'s2'"),
    "stateCode": S(3, "'sc'"),
}


def plain_address_sql(alias: str, path: str) -> list[str]:
    return [
        same(f"{alias}_street", f"{path}.street"),
        same(f"{alias}_city", f"{path}.city"),
        same(f"{alias}_country", f"{path}.country"),
        same(f"{alias}_postal_code", f"{path}.postalCode"),
        same(f"{alias}_state_or_region", f"{path}.stateOrRegion"),
        f"""CASE WHEN "{path}" THEN coalesce("{path}.street2", '') END AS {alias}_street2""",
        same(f"{alias}_state_code", f"{path}.stateCode"),
    ]


mapped(
    "caregiver",
    IDENTITY
    | {
        "notifications": Obj(
            {"digest": Obj({"email": "event_id % 2 = 1"})}
            | {source: ways(i, f"(event_id + {i}) % 3 = 0") for i, source in enumerate(CHANNELS.values())}
        ),
        "following": Arr(
            [person(0) | {k: f"'{k}'" for k in ("accessLevel", "givenName", "role")}, person(1)], PEOPLE_WHEN
        ),
        "mailingAddress": Obj(ADDRESS, "event_id % 3 <> 2"),
    },
    IDENTITY_SQL
    + [same("notifications_digest_email", "notifications.digest.email")]
    + [
        same(f"notifications_{name}_{way}", f"notifications.{source}.{way}")
        for name, source in CHANNELS.items()
        for way in ("email", "sms", "push")
    ]
    + [json_list("following", [(f'"following.{i}"', element(f"following.{i}", PERSON)) for i in (0, 1)])]
    + plain_address_sql("mailing_address", "mailingAddress"),
    where=IDENTITY_GOOD
    + """ AND (x OR NOT "following.0" OR "following.0.disease" IS NOT NULL)
          AND (x OR NOT "following.1" OR ("following.1.accessLevel" IS NOT NULL AND "following.1.givenName" IS NOT NULL
               AND "following.1.role" IS NOT NULL AND "following.1.disease" IS NOT NULL))""",
)


def sensor(n: int) -> dict:
    return {
        "mac": f"'mac{n}-' || user_id",
        "battery": S(n, "event_id % 100"),
        "batteryLevel": S(n + 1, "50"),
        "dataLink": S(n + 2, "true"),
        "firstSyncDate": S(n + 3, "'2020-02-01'"),
        "firmwareVersion": S(n, "'1.2'"),
        "forceSilent": S(n + 1, "true"),
        "lastSyncDate": S(n + 2, "'2020-03-01'"),
        "model": S(n + 3, "'m'"),
        "readyDate": S(n, "'2020-04-01'"),
        "silent": S(n + 1, "event_id % 3 = 0"),
    }


def plan_medication(n: int) -> dict:
    return {
        "medication": Obj({"id": f"'m{n}-' || (event_id % 9)", "type": S(n, "'rescue'")}),
        "dataLink": S(n + 1, "true"),
        "effectivePeriod": Obj({"start": "'2020-01-01'", "end": S(n + 2, "'2021-01-01'")}, f"(event_id + {n}) % 3 = 0"),
        "status": S(n + 3, "'active'"),
        "usageList": Arr(
            [{"hour": "8", "minute": "event_id % 60", "doses": S(n, "2"), "unitDoses": S(n + 1, "1")}],
            [f"(event_id + {n}) % 2 = 0"],
        ),
        "sensors": Arr([sensor(n), sensor(n + 1)], [f"(event_id + {n}) % 3 = 1", f"(event_id + {n}) % 6 = 1"]),
    }


DATES = ["first", "firstController", "firstRescue", "last", "lastController", "lastRescue"]
SNAKE = {"first": "first", "firstController": "first_controller", "firstRescue": "first_rescue", "last": "last",
         "lastController": "last_controller", "lastRescue": "last_rescue"}

PROFILE_BODY = {
    "role": "'patient'",
    "createdDate": "'2020-01-0' || (event_id % 9 + 1)",
    "givenName": S(0, "'gn' || user_id"),
    "timeZone": S(1, "'tz'"),
    "familyName": S(2, "'fn'"),
    "email": S(3, "'e' || user_id"),
    "language": S(0, "'en'"),
    "age": S(1, "event_id % 90"),
    "birthDate": S(2, "'1980-01-01'"),
    "disease": S(3, "'asthma'"),
    "phone": S(0, "user_id"),
    "followers": Arr([person(0), person(1)], PEOPLE_WHEN),
    "following": Arr([person(1), person(2)], PEOPLE_WHEN),
    "notifications": Obj(
        {"digest": Obj({"email": "event_id % 2 = 0"}, "event_id % 3 = 0")}
        | {s: ways(i, f"(event_id + {i}) % 4 = 0") for i, s in enumerate(CHANNELS.values())}
        | {"questionnaire": ways(9, "event_id % 5 = 1")},
        "event_id % 7 <> 0",
    ),
    "plan": Obj(
        {"medications": Arr([plan_medication(0), plan_medication(1)], ["event_id % 5 <> 0", "event_id % 5 = 2"])},
        "event_id % 8 <> 3",
    ),
    "mailingAddress": Obj(ADDRESS, "event_id % 3 <> 2"),
    "gender": S(0, "'f'"),
    "height": "CASE event_id % 3 WHEN 0 THEN concat('@@', event_id % 200, '@@') WHEN 1 THEN concat('@@{`value`:', event_id % 150, '.5}@@') END",
    "weight": "CASE event_id % 3 WHEN 1 THEN concat('@@', event_id % 200, '@@') WHEN 2 THEN concat('@@{`value`:`', event_id % 150, '`}@@') END",
    "medicalIds": Arr([{"key": "'k'", "value": "'v' || event_id"}, {"key": "'l'", "value": "'w'"}], ["event_id % 4 = 0", "event_id % 8 = 0"]),
    "externalIds": Arr([{"key": "'x'", "value": "'e' || event_id"}], ["event_id % 4 <> 3"]),
    "hub": Obj({"id": S(0, "'h'"), "externalId": S(1, "'he'"), "type": S(2, "'ht'"), "region": S(3, "'hr'")}, "event_id % 3 = 0"),
    "race": S(1, "'r'"),
    "clinicalTrial": Obj({"clinicalTrialId": S(0, "'ct'"), "clinicalTrialArmId": S(1, "'ca'"), "status": S(2, "'cs'")}, "event_id % 3 = 1"),
    "event": Obj({d: S(i, f"'2020-0{i + 1}-01'") for i, d in enumerate(DATES)} | {"totalRescue": S(2, "event_id % 30")}, "event_id % 3 <> 0"),
    "sync": Obj(
        {d: S(i, f"'2021-0{i + 1}-01'") for i, d in enumerate(DATES)} | {"sync": S(1, "1"), "total": "event_id % 40"}, "event_id % 4 <> 2"
    ),
    "isFakeBirthDate": S(0, "true"),
    "isFakeName": S(1, "event_id % 3 = 0"),
    "isPhoneMobile": S(2, "true"),
    "activeSponsorshipQuotes": Arr([{"quoteId": "'q' || event_id", "sponsorName": "'sp'"}], ["event_id % 3 = 0"]),
    "triggers": Arr(["'t' || (event_id % 3)", "'u'"], ["event_id % 3 = 1", "event_id % 6 = 1"]),
    "uniqueExternalId": S(3, "'ux' || user_id"),
    "hispanic": "CASE event_id % 8 WHEN 0 THEN 'null' WHEN 1 THEN 'yes' WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE 'no' END",
}

FLAGGED_PERSON = [(name, key, "'-1'") for name, key in PERSON]
BLANK_PERSON = ", ".join(f"'has_{n}': false, '{n}': '-1'" for n, _ in PERSON)
BLANK_FOLLOWER = ", ".join(f"'has_{n}': false, '{n}': '-1'" for n, _ in PERSON[:-1])
SENSOR = [
    ("data_link", "dataLink", "false"),
    ("first_sync_date", "firstSyncDate", EPOCH),
    ("firmware_version", "firmwareVersion", "'-1'"),
    ("force_silent", "forceSilent", "false"),
    ("last_sync_date", "lastSyncDate", EPOCH),
    ("model", "model", "'-1'"),
    ("ready_date", "readyDate", EPOCH),
    ("silent", "silent", "false"),
]


def sensor_sql(med: str, path: str) -> str:
    kind, power = f'"{med}.medication.type"', f'coalesce("{path}.battery", "{path}.batteryLevel")'
    rest = element(path, SENSOR)[1:-1]
    return (
        f"""{{'mac': "{path}.mac", 'medication_id': "{med}.medication.id", 'has_medication_type': {kind} IS NOT NULL,
        'medication_type': coalesce({kind}, '-1'), 'has_battery': {power} IS NOT NULL, 'battery': coalesce({power}, -1), {rest}}}"""
    )


BLANK_SENSOR = (
    "{'mac': '-1', 'medication_id': '-1', 'has_medication_type': false, 'medication_type': '-1', 'has_battery': false, 'battery': -1, "
    + ", ".join(f"'has_{n}': false, '{n}': {d}" for n, _, d in SENSOR)
    + "}"
)


def medication_sql(path: str) -> str:
    return f"""{{'medication_id': "{path}.medication.id", 'has_data_link': "{path}.dataLink" IS NOT NULL,
        'data_link': coalesce("{path}.dataLink", false), 'has_effective_period_start': "{path}.effectivePeriod",
        'effective_period_start': CASE WHEN "{path}.effectivePeriod" THEN "{path}.effectivePeriod.start" ELSE {EPOCH} END,
        'has_effective_period_end': "{path}.effectivePeriod",
        'effective_period_end': coalesce("{path}.effectivePeriod.end", {EPOCH}),
        'has_status': "{path}.status" IS NOT NULL, 'status': coalesce("{path}.status", '-1')}}"""


BLANK_MEDICATION = f"""{{'medication_id': '-1', 'has_data_link': false, 'data_link': false, 'has_effective_period_start': false,
    'effective_period_start': {EPOCH}, 'has_effective_period_end': false, 'effective_period_end': {EPOCH},
    'has_status': false, 'status': '-1'}}"""


def dose_sql(med: str) -> str:
    use = f"{med}.usageList.0"
    return f"""{{'medication_id': "{med}.medication.id", 'hour': "{use}.hour", 'minute': "{use}.minute",
        'doses': coalesce("{use}.doses", "{use}.unitDoses")}}"""


BLANK_DOSE = "{'medication_id': '-1', 'hour': -1, 'minute': -1, 'doses': -1}"
MEDS = ["plan.medications.0", "plan.medications.1"]


def channel_sql() -> list[str]:
    out = ['"notifications.digest" AS notifications_has_digest', 'coalesce("notifications.digest.email", false) AS notifications_digest_email']
    for name, source in CHANNELS.items():
        sent = f'"notifications.{source}"'
        value = f'"notifications.{source}.{{way}}"'
        if name == "act_invite":
            sent = '("notifications.actInvite" OR "notifications.questionnaire")'
            value = 'CASE WHEN "notifications.actInvite" THEN "notifications.actInvite.{way}" ELSE "notifications.questionnaire.{way}" END'
        if name != "missed_dose":
            out.append(f"{sent} AS notifications_has_{name}")
        out += [f"coalesce({value.format(way=way)}, false) AS notifications_{name}_{way}" for way in ("email", "sms", "push")]
    return out


def any_of(*paths: str) -> str:
    return "(" + " OR ".join(f'"{p}"' for p in paths) + ")"


def first_sync_sql() -> list[str]:
    there = '("sync" AND ("sync.first" IS NOT NULL OR x))'
    return [
        f"{there} AS sync_has_first",
        f'CASE WHEN {there} THEN "sync.first" ELSE {EPOCH} END AS sync_first',
    ]


DOSES = [f"{m}.usageList.0" for m in MEDS]
SENSORS = [f"{m}.sensors.{i}" for m in MEDS for i in (0, 1)]

PROFILE_SQL = [
    json_list("followers", [(f'"followers.{i}"', element(f"followers.{i}", FLAGGED_PERSON[:-1])) for i in (0, 1)], json_text("{" + BLANK_FOLLOWER + "}")),
    json_list("following", [(f'"following.{i}"', element(f"following.{i}", FLAGGED_PERSON)) for i in (0, 1)], json_text("{" + BLANK_PERSON + "}")),
    *channel_sql(),
    f"{any_of(*MEDS)} AS has_medications",
    json_list("medications", [(f'"{m}"', medication_sql(m)) for m in MEDS], json_text(BLANK_MEDICATION)),
    f"{any_of(*DOSES)} AS has_usage_list",
    json_list("usage_list", [(f'"{m}.usageList.0"', dose_sql(m)) for m in MEDS], json_text(BLANK_DOSE)),
    f"{any_of(*SENSORS)} AS has_sensors",
    json_list("sensors", [(f'"{s}"', sensor_sql(s.split(".sensors")[0], s)) for s in SENSORS], json_text(BLANK_SENSOR)),
    *[f'CASE WHEN "mailingAddress" THEN "mailingAddress.{n}" ELSE \'-1\' END AS mailing_address_{n}' for n in ("street", "city", "country")],
    *with_flag("postal_code", "mailingAddress.postalCode", "'-1'", prefix="mailing_address_"),
    *with_flag("state_or_region", "mailingAddress.stateOrRegion", "'-1'", prefix="mailing_address_"),
    *with_flag("street2", "mailingAddress.street2", "'-1'", prefix="mailing_address_"),
    *with_flag("state_code", "mailingAddress.stateCode", "'-1'", prefix="mailing_address_"),
    *with_flag("gender", "gender", "'-1'"),
    "event_id % 3 IN (0, 1) AS has_height",
    "CAST(CASE event_id % 3 WHEN 0 THEN event_id % 200 WHEN 1 THEN event_id % 150 + 0.5 ELSE -1.0 END AS DOUBLE) AS height",
    "event_id % 3 IN (1, 2) AS has_weight",
    "CAST(CASE event_id % 3 WHEN 1 THEN event_id % 200 WHEN 2 THEN event_id % 150 ELSE -1.0 END AS DOUBLE) AS weight",
    f"{any_of('medicalIds.0', 'medicalIds.1', 'externalIds.0')} AS has_medical_ids",
    json_list(
        "medical_ids",
        [(f'"medicalIds.{i}"', element(f"medicalIds.{i}", [("key", "key"), ("value", "value")])) for i in (0, 1)]
        + [('("externalIds.0" AND NOT "medicalIds.0" AND NOT "medicalIds.1")', element("externalIds.0", [("key", "key"), ("value", "value")]))],
        json_text("{'key': '-1', 'value': '-1'}"),
    ),
    '"hub" AS has_hub',
    *[c for n, k in (("id", "id"), ("external_id", "externalId"), ("type", "type"), ("region", "region")) for c in with_flag(n, f"hub.{k}", "'-1'", prefix="hub_")],
    *with_flag("race", "race", "'-1'"),
    '"clinicalTrial" AS has_clinical_trial',
    *[c for n, k in (("id", "clinicalTrialId"), ("arm_id", "clinicalTrialArmId"), ("status", "status")) for c in with_flag(n, f"clinicalTrial.{k}", "'-1'", prefix="clinical_trial_")],
    '"event" AS has_event',
    *[c for d in DATES for c in with_flag(SNAKE[d], f"event.{d}", EPOCH, prefix="event_")],
    *with_flag("count_rescue", "event.totalRescue", "-1", "INTEGER", prefix="event_"),
    '"sync" AS has_sync',
    *first_sync_sql(),
    *[c for d in DATES[1:] for c in with_flag(SNAKE[d], f"sync.{d}", EPOCH, prefix="sync_")],
    '"sync.sync" IS NOT NULL AS sync_has_count',
    'CAST(CASE WHEN "sync.sync" IS NOT NULL THEN "sync.total" ELSE -1 END AS INTEGER) AS sync_count',
    *with_flag("is_fake_birth_date", "isFakeBirthDate", "false", "BOOLEAN"),
    *with_flag("is_fake_name", "isFakeName", "false", "BOOLEAN"),
    *with_flag("is_phone_mobile", "isPhoneMobile", "false", "BOOLEAN"),
    '"activeSponsorshipQuotes.0" AS has_active_sponsorship_quotes',
    json_list(
        "active_sponsorship_quotes",
        [('"activeSponsorshipQuotes.0"', element("activeSponsorshipQuotes.0", [("id", "quoteId"), ("name", "sponsorName")]))],
        json_text("{'id': '-1', 'name': '-1'}"),
    ),
    f"{any_of('triggers.0', 'triggers.1')} AS has_triggers",
    json_list("triggers", [(f'"triggers.{i}"', f'"triggers.{i}.value"') for i in (0, 1)], "'[\"-1\"]'"),
    "CASE WHEN hispanic = 'null' THEN 'no answer' ELSE hispanic END AS hispanic",
]

PATIENT_BODY = PROFILE_BODY | {
    "baseline": S(1, "value"),
    "group": "CASE WHEN event_id % 3 <> 0 THEN concat('@@{`name`:`n`,`displayName`:`N', user_id, '`}@@') ELSE '@@null@@' END",
}
PATIENT_SQL = [
    missing_only("given_name", "givenName", "'-1'"),
    missing_only("time_zone", "timeZone", "'-1'"),
    missing_only("family_name", "familyName", "'-1'"),
    missing_only("email", "email", "'-1'"),
    missing_only("language", "language", "'-1'"),
    missing_only("age", "age", "-1", "INTEGER"),
    missing_only("birth_date", "birthDate", "'-1'"),
    missing_only("disease", "disease", "'-1'"),
    missing_only("baseline", "baseline", "-1.0", "DOUBLE"),
    same("role", "role"),
    '"createdDate" || \'T00:00:00.000Z\' AS date_created',
    "'n' AS group_name",
    "'N' || user_number AS group_display_name",
    *with_flag("phone", "phone", "'-1'"),
    *PROFILE_SQL,
    *with_flag("unique_external_id", "uniqueExternalId", "'-1'"),
]
PROSPECT_ARGS = """CASE WHEN event_id % 4 = 1 THEN '["prospect"]' ELSE '["a"]' END"""

mapped(
    "patient",
    PATIENT_BODY,
    PATIENT_SQL
    + [
        f"""CASE WHEN event_type = 'patient_created' THEN CASE WHEN event_id % 4 = 1 THEN call_time ELSE {EPOCH} END
            END AS prospect_conversion_datetime"""
    ],
    where="event_id % 3 <> 0",
    args=PROSPECT_ARGS,
)
MID_ARGS = """CASE event_id % 4 WHEN 0 THEN concat('["m', event_id, '"]') WHEN 1 THEN concat('[{"mid":"o', event_id, '"},"x"]')
              WHEN 2 THEN '[]' ELSE '[12]' END"""
mapped(
    "medication",
    PATIENT_BODY,
    PATIENT_SQL
    + [
        "CAST(NULL AS VARCHAR) AS prospect_conversion_datetime",
        "CASE event_id % 4 WHEN 0 THEN 'm' || event_id WHEN 1 THEN 'o' || event_id ELSE '12' END AS medication_changed",
        "call_time AS medication_changed_date",
    ],
    where="event_id % 3 <> 0 AND event_id % 4 <> 2",
    args=MID_ARGS,
)
mapped(
    "prospect",
    PROFILE_BODY
    | {
        "oidcidtoken": S(1, "'oi' || user_id"),
        "role": S(2, "'prospect'"),
        "group": Obj({"name": "'n' || (user_id % 5)", "displayName": "'N'"}, "event_id % 3 <> 0"),
    },
    [
        same("role", "role"),
        '"createdDate" || \'T00:00:00.000Z\' AS date_created',
        *with_flag("email", "email", "'-1'"),
        *with_flag("phone", "phone", "'-1'"),
        *with_flag("unique_external_id", "uniqueExternalId", "'-1'"),
        *with_flag("oidcidtoken", "oidcidtoken", "'-1'"),
        '"group" AS has_group',
        or_default("group_name", "group.name", "'-1'"),
        or_default("group_display_name", "group.displayName", "'-1'"),
        *with_flag("given_name", "givenName", "'-1'"),
        *with_flag("time_zone", "timeZone", "'-1'"),
        *with_flag("family_name", "familyName", "'-1'"),
        *with_flag("language", "language", "'-1'"),
        *with_flag("age", "age", "-1", "INTEGER"),
        *with_flag("birth_date", "birthDate", "'-1'"),
        *with_flag("disease", "disease", "'-1'"),
        *PROFILE_SQL,
    ],
    where='"role" IS NOT NULL',
)
