"""The rest of the bronze mapping queries: activity, devices, shipments, groups."""

from __future__ import annotations

from lakeloom.mapping.specs.activity import FORECAST_FLOATS, FORECAST_INTS
from lakeloom.mapping.specs.things import EXTENDED_STATUS
from lakeloom.queries.bronze import (
    ADDRESS,
    EPOCH,
    element,
    has_required,
    json_list,
    mapped,
    or_default,
    plain_address_sql,
    same,
)
from lakeloom.queries.feed import Arr, Obj, sometimes as S

PAIR = Arr(["value", "-value"], ["true", "true"])

# Events.

GEO = {
    "latitude": S(0, "value"),
    "longitude": S(1, "-value"),
    "precision": S(2, "event_id % 50"),
    "formatted": S(3, "'fo' || event_id"),
    "stateCode": S(0, "'sc'"),
    "postalCode": S(1, "'pc'"),
    "city": "'ci'",
    "country": S(2, "'co'"),
    "stateOrRegion": S(3, "'sr'"),
    "street": S(0, "'st'"),
    "street2": S(1, "'s2'"),
}
WEATHER_DOUBLES = [("pm25", "pm25"), ("pm10", "pm10"), ("o3", "o3"), ("no2", "no2"), ("co", "co"), ("so2", "so2"), ("pressure", "pressure")]
WEATHER_INTS = [
    ("dew_point", "dewPoint"), ("wind_speed", "windSpeed"), ("heat_index", "heatIndex"), ("wind_chill", "windChill"),
    ("aqi", "aqi"), ("wind_direction", "windDirection"), ("humidity", "humidity"), ("temperature", "temperature"),
]
# aqi arrives as text, humidity as a fraction to be cut off
WEATHER_BODY = (
    {k: S(i, "value / 2") for i, (_, k) in enumerate(WEATHER_DOUBLES)}
    | {k: S(i, f"event_id % {90 + i}") for i, (_, k) in enumerate(WEATHER_INTS)}
    | {"aqi": S(1, "concat('', event_id % 300)"), "humidity": "event_id % 100 + 0.75", "aqiCategory": S(2, "'good'")}
)

EVENT_BODY = {
    "id": "'ev' || event_id",
    "date": S(0, "'2024-01-02'"),
    "nightEvent": S(1, "event_id % 3 = 0"),
    "source": "'app'",
    "doses": S(2, "event_id % 4"),
    "preemptive": S(3, "true"),
    "medicationId": S(0, "'m'"),
    "medication": Obj({"type": S(1, "'rescue'")}, "event_id % 3 = 0"),
    "triggers": Arr(["'t' || (event_id % 3)", "'u'"], ["event_id % 3 = 1", "event_id % 6 = 1"]),
    "symptoms": Arr(["'s'"], ["event_id % 5 = 1"]),
    "address": Obj(GEO, "event_id % 5 <> 0"),
    "weather": Obj(WEATHER_BODY, "event_id % 4 <> 3"),
    "place": Obj(
        {
            "location": Obj({"coordinates": PAIR}),
            "type": "'poi'",
            "name": S(0, "'pn'"),
            "element": "'node'",
            "id": "event_id",
        },
        "event_id % 3 = 2",
    ),
    "note": "CASE event_id % 4 WHEN 0 THEN 'note' WHEN 1 THEN '' END",
}
mapped(
    "event",
    EVENT_BODY,
    [
        same("event_id", "id"),
        same("date", "date"),
        same("night_event", "nightEvent"),
        same("source", "source"),
        same("doses", "doses", "INTEGER"),
        same("preemptive", "preemptive"),
        same("medication_id", "medicationId"),
        same("medication_type", "medication.type"),
        json_list("triggers", [(f'"triggers.{i}"', f'"triggers.{i}.value"') for i in (0, 1)]),
        json_list("symptoms", [('"symptoms.0"', '"symptoms.0.value"')]),
        *[
            f'CASE WHEN "address.latitude" IS NOT NULL AND "address.longitude" IS NOT NULL THEN CAST("address.{n}" AS DOUBLE) END AS "{n}"'
            for n in ("latitude", "longitude", "precision")
        ],
        *[
            f"""CASE WHEN "address.formatted" IS NOT NULL THEN coalesce("address.{k}", '') END AS address_{n}"""
            for n, k in (
                ("state_code", "stateCode"), ("postal_code", "postalCode"), ("city", "city"), ("country", "country"),
                ("formatted", "formatted"), ("state_or_region", "stateOrRegion"), ("street", "street"), ("street2", "street2"),
            )
        ],
        *[same(f"weather_{n}", f"weather.{k}", "DOUBLE") for n, k in WEATHER_DOUBLES],
        *[same(f"weather_{n}", f"weather.{k}", "INTEGER") for n, k in WEATHER_INTS if k != "humidity"],
        'CAST(floor("weather.humidity") AS INTEGER) AS weather_humidity',
        same("weather_aqi_category", "weather.aqiCategory"),
        '"place.location.coordinates.1.value" AS place_latitude',
        '"place.location.coordinates.0.value" AS place_longitude',
        *[same(f"place_{n}", f"place.{n}") for n in ("type", "name", "element", "id")],
        "CASE WHEN event_id % 4 = 0 THEN 'note' END AS note",
    ],
    where="""date IS NOT NULL AND "nightEvent" IS NOT NULL AND (NOT "place" OR x OR "place.name" IS NOT NULL)""",
)

VARIABLES = ["comparator", "threshold", "window_size", "window_unit", "actual", "window_label"]
mapped(
    "alert",
    {
        "_id": "'al' || event_id",
        "deleted": "event_id % 2 = 0",
        "acknowledged": S(0, "true"),
        "dateC": "'2024-01-02'",
        "userRole": S(1, "'patient'"),
        "userDeleted": "false",
        "alertType": S(2, "'risk'"),
        "updatedAt": S(3, "'2024-01-05'"),
        "notifiedId": S(0, "'n'"),
        "correlationId": S(1, "'c'"),
        "medId": S(2, "'m'"),
        "dosageTime": S(3, "'08:00'"),
        "firstAtRiskAlert": "CASE event_id % 4 WHEN 0 THEN 'true' WHEN 1 THEN '@@true@@' WHEN 2 THEN 'false' END",
        "dayUses": S(0, "concat('', event_id % 9)"),
        "percentChange": S(1, "event_id % 90 + 0.25"),
        "asthmaScore": S(2, "event_id % 25"),
        "variables": Obj(
            {"mac": S(0, "'mac'"), "quietSensor": Obj({"model": S(1, "'mo'")}, "event_id % 3 = 0")}
            | {v: S(i, f"'{v}'") for i, v in enumerate(VARIABLES)},
            "event_id % 4 <> 3",
        ),
    },
    [
        same("alert_id", "_id"),
        same("deleted", "deleted"),
        same("acknowledged", "acknowledged"),
        same("date_created", "dateC"),
        same("user_role", "userRole"),
        same("user_deleted", "userDeleted"),
        """CASE WHEN event_type = 'alert_deleted' THEN "alertType" END AS alert_type""",
        """CASE WHEN event_type = 'alert_deleted' THEN CASE WHEN "updatedAt" IS NOT NULL THEN "updatedAt"
             WHEN x THEN NULL ELSE call_time END END AS date_updated""",
        same("notified_id", "notifiedId"),
        same("correlation_id", "correlationId"),
        same("medication_id", "medId"),
        same("dose_time", "dosageTime"),
        "CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN false END AS first_at_risk_alert",
        same("day_uses", "dayUses", "INTEGER"),
        'CAST(floor("percentChange") AS INTEGER) AS percent_change',
        same("asthma_control_score", "asthmaScore", "VARCHAR"),
        same("mac", "variables.mac"),
        same("model", "variables.quietSensor.model"),
        *[same(v, f"variables.{v}") for v in VARIABLES],
    ],
    where=has_required("acknowledged", "userRole")
    + """ AND (event_type <> 'alert_deleted' OR x OR "alertType" IS NOT NULL)""",
)

mapped(
    "patient_geo_location",
    {
        "location": Obj({"coordinates": PAIR}, "event_id % 5 <> 0"),
        "precision": S(0, "event_id % 40"),
        "dateR": S(1, "'2024-01-02'"),
        "address": Obj(ADDRESS, "event_id % 3 <> 2"),
        "place": Obj(
            {"location": PAIR, "type": "'poi'", "name": S(2, "'pn'"), "element": "'node'", "id": "event_id"},
            "event_id % 3 = 2",
        ),
    },
    [
        '"location.coordinates.1.value" AS latitude',
        '"location.coordinates.0.value" AS longitude',
        same('"precision"', "precision", "DOUBLE"),
        same("date", "dateR"),
        *plain_address_sql("address", "address"),
        '"place.location.0.value" AS place_latitude',
        '"place.location.1.value" AS place_longitude',
        *[same(f"place_{n}", f"place.{n}") for n in ("type", "name", "element", "id")],
    ],
    where=has_required("dateR") + """ AND "location" AND (NOT "place" OR x OR "place.name" IS NOT NULL)""",
)

COUNTED = '("adherence.dosesTaken" IS NOT NULL AND "dateR" IS NOT NULL)'
MED = [
    ("medication_id", "mid"),
    ("doses_expected", "dosesExpected"),
    ("doses_taken", "dosesTaken"),
    ("doses_taken_actual", "dosesTakenActual"),
    ("percent", "percent"),
    ("percent_actual", "percentActual"),
]


def med(n: int) -> dict:
    return {
        "mid": f"'m{n}-' || event_id",
        "dosesExpected": "event_id % 7",
        "dosesTaken": S(n, "event_id % 5"),
        "dosesTakenActual": S(n + 1, "event_id % 6"),
        "percent": "value",
        "percentActual": "value / 2",
    }


def med_sql(i: int) -> str:
    p = f"adherence.meds.{i}"
    return f"""{{'medication_id': "{p}.mid", 'doses_expected': "{p}.dosesExpected", 'doses_taken': coalesce("{p}.dosesTaken", 0),
        'doses_taken_actual': coalesce("{p}.dosesTakenActual", 0), 'percent': "{p}.percent", 'percent_actual': "{p}.percentActual"}}"""


mapped(
    "adherence",
    {
        "dateR": S(0, "'2024-01-02'"),
        "adherence": Obj(
            {
                "dosesExpected": "event_id % 7",
                "dosesTaken": S(1, "event_id % 5"),
                "dosesTakenActual": S(2, "event_id % 6"),
                "percent": "value",
                "percentActual": S(3, "value / 2"),
                "meds": Arr([med(0), med(1)], ["event_id % 3 <> 0", "event_id % 6 = 1"]),
            },
            "event_id % 5 <> 0",
        ),
    },
    [
        f'CAST(CASE WHEN {COUNTED} THEN "adherence.dosesExpected" ELSE -1 END AS INTEGER) AS doses_expected',
        f'CAST(CASE WHEN {COUNTED} THEN "adherence.dosesTaken" END AS INTEGER) AS doses_taken',
        f'CAST(CASE WHEN {COUNTED} THEN coalesce("adherence.dosesTakenActual", 0) END AS INTEGER) AS doses_taken_actual',
        f'CAST(CASE WHEN {COUNTED} THEN "adherence.percent" ELSE -1.0 END AS DOUBLE) AS percent',
        f'CAST(CASE WHEN {COUNTED} THEN "adherence.percentActual" ELSE -1.0 END AS DOUBLE) AS percent_actual',
        f'CASE WHEN {COUNTED} THEN "dateR" ELSE {EPOCH} END AS date',
        json_list(
            "meds", [(f'({COUNTED} AND "adherence.meds.{i}")', med_sql(i)) for i in (0, 1)],
            f"CASE WHEN {COUNTED} AND x AND NOT \"adherence.meds.0\" AND event_id % 4 = 1 THEN NULL ELSE '[]' END",
        ),
        f"CASE WHEN NOT {COUNTED} THEN 'bye' END AS bye_bye",
    ],
    # figures are required once the doses are counted; doses of a medication may only be null, not missing
    where=f"""(NOT {COUNTED} OR ((x OR ("adherence.dosesTakenActual" IS NOT NULL AND "adherence.percentActual" IS NOT NULL))
        AND ("adherence.meds.0" OR "adherence.meds.1" OR event_id % 4 <> 1)
        AND (x OR NOT "adherence.meds.0" OR ("adherence.meds.0.dosesTaken" IS NOT NULL AND "adherence.meds.0.dosesTakenActual" IS NOT NULL))
        AND (x OR NOT "adherence.meds.1" OR ("adherence.meds.1.dosesTaken" IS NOT NULL AND "adherence.meds.1.dosesTakenActual" IS NOT NULL))))""",
)

# Forecasts: CSV text of a header and eight rows (seven in every fifth record).

HEADER = "lat,pm25_max,month,place,wind_chill"


def csv_expr() -> str:
    row = "concat('\\n', value, ',', {i}, '.5,', event_id % 12, ',\"a, ', {i}, '\",', {i} - 3)"
    rows = [row.format(i=i) for i in range(7)]
    rows.append("CASE WHEN event_id % 5 = 4 THEN '' ELSE " + row.format(i=7) + " END")
    return f"concat('{HEADER}', {', '.join(rows)})"


def forecast_row(i: int) -> str:
    known = {"lat": "value", "pm25_max": f"{i}.5::DOUBLE", "month": "event_id % 12", "wind_chill": f"{i - 3}"}
    parts = [f"'index': {i}"]
    parts += [f"'{n}': {known.get(n, 'NULL::DOUBLE')}" for n in FORECAST_FLOATS]
    parts += [f"'{n}': {known.get(n, 'NULL::INTEGER')}" for n in FORECAST_INTS]
    parts.append(f"'other': {{'place': 'a, {i}'}}")
    return "{" + ", ".join(parts) + "}"


mapped(
    "asthma_forecast",
    {
        "id": "'fc' || event_id",
        "input": csv_expr(),
        "output": S(0, "'0.5'"),
        "modelVersion": S(1, "'2.0'"),
        "webwareVersion": S(2, "'5.0'"),
        "predictionDate": S(3, "'2024-01-03'"),
        "v": "value",
    },
    [
        same("id", "id"),
        "replace(input, '\\n', chr(10)) AS input",
        same("output", "output"),
        or_default("model_version", "modelVersion", "'1.1.0'"),
        or_default("webware_version", "webwareVersion", "'4.35.0'"),
        or_default("prediction_date", "predictionDate", "call_time"),
        f"CAST(to_json([{', '.join(forecast_row(i).replace('value', '\"v\"') for i in range(8))}]) AS VARCHAR) AS input_rows",
    ],
    where=has_required("output") + " AND event_id % 5 <> 4",
)

# Questionnaires.


def answer(n: int) -> dict:
    return {
        "answerId": f"CASE (event_id + {n}) % 3 WHEN 0 THEN 'an{n}' WHEN 1 THEN '' END",
        "text": f"'at{n}-' || event_id",
        "rowLabel": S(n, "'rl'"),
        "rowLabelAnswerId": S(n + 1, "'ra'"),
        "colLabel": S(n + 2, "'cl'"),
        "colLabelAnswerId": S(n + 3, "'ca'"),
        "weight": S(n, "value"),
        "quizScore": S(n + 1, "event_id % 10 + 0.5"),
    }


def question(n: int) -> dict:
    return {
        "questionId": f"'q{n}-' || event_id",
        "text": f"'qt{n}'",
        "answers": Arr([answer(n), answer(n + 1)], ["true", f"(event_id + {n}) % 3 = 0"]),
    }


QUESTIONS = ["questionnaire.0.questions.0", "questionnaire.0.questions.1", "questionnaire.1.questions.0"]
QUESTION_WHEN = ["true", '"questionnaire.0.questions.1"', '"questionnaire.1"']


def question_sql(path: str) -> str:
    ids = ", ".join(f'CASE WHEN "{path}.answers.{i}" THEN "{path}.answers.{i}.answerId" END' for i in (0, 1))
    section = path.split(".questions")[0]
    return f"""{{'question_id': "{path}.questionId", 'answers': list_filter([{ids}], lambda z: z IS NOT NULL AND z <> ''),
        'group_id': "{section}.questionnaireGroupId", 'text': "{path}.text"}}"""


def answer_sql(path: str, i: int) -> str:
    a = f"{path}.answers.{i}"
    text = [f"'{n}': coalesce(\"{a}.{k}\", '')" for n, k in (("answer_id", "answerId"), ("col_label", "colLabel"), ("col_label_answer_id", "colLabelAnswerId"))]
    rest = [f"'{n}': coalesce(\"{a}.{k}\", '')" for n, k in (("row_label", "rowLabel"), ("row_label_answer_id", "rowLabelAnswerId"))]
    parts = [
        *text, f"'question_id': \"{path}.questionId\"", f"'quiz_score': CAST(coalesce(\"{a}.quizScore\", -1) AS DOUBLE)", *rest,
        f"'text': \"{a}.text\"", f"'weight': coalesce(\"{a}.weight\", -1.0)",
    ]
    return "{" + ", ".join(parts) + "}"


RESPONSE = ["Id", "Name", "ResponseDateCreated", "ResponseDateModified", "ResponseId", "Service", "VersionId"]
RESPONSE_COLUMNS = ["id", "name", "response_date_created", "response_date_modified", "response_id", "service", "version_id"]
mapped(
    "questionnaire_response",
    {
        "_id": "'qr' || event_id",
        "questionnaire": Arr(
            [
                {"questionnaireGroupId": "'g0'", "questions": Arr([question(0), question(1)], ["true", "event_id % 3 <> 0"])},
                {"questionnaireGroupId": "'g1'", "questions": Arr([question(2), question(3)], ["true", "false"])},
            ],
            ["true", "event_id % 4 = 2"],
        ),
        "dateS": "'2024-01-02'",
        "language": S(0, "'en'"),
        "rid": S(1, "'r'"),
        "timeToTakeQuestionnaire": S(2, "value"),
    }
    | {f"questionnaire{n}": S(i, f"'{n}'") if i < 2 else f"'{n}'" for i, n in enumerate(RESPONSE)},
    [
        same("id", "_id"),
        json_list("questions", [(w, question_sql(q)) for q, w in zip(QUESTIONS, QUESTION_WHEN)]),
        json_list("answers", [(f'({w} AND "{q}.answers.{i}")', answer_sql(q, i)) for q, w in zip(QUESTIONS, QUESTION_WHEN) for i in (0, 1)]),
        same("date_saved", "dateS"),
        or_default("language", "language", "'-1'"),
        *[same(f"questionnaire_{c}", f"questionnaire{n}") for c, n in zip(RESPONSE_COLUMNS, RESPONSE)],
        same("resource_id", "rid"),
        same("time_to_take_questionnaire", "timeToTakeQuestionnaire"),
    ],
    where=has_required("questionnaireId", "questionnaireName"),
)

# Spirometry.

CUSTOM = "CASE event_id % 4 WHEN 0 THEN concat('@@{`a`:', event_id, ',`b`:`x`}@@') WHEN 1 THEN '@@[1,2]@@' WHEN 2 THEN '@@{}@@' END"
CUSTOM_SQL = """CASE WHEN event_id % 4 = 0 THEN '{"a":"' || event_id || '","b":"x"}' ELSE '{}' END"""


def result(n: int) -> dict:
    return {
        "fvc": f"value + {n}",
        "createdDate": "'2024-01-02'",
        "fev1OverFvc": S(n, "value / 4"),
        "customData": CUSTOM,
        "fev1": "value / 2",
        "fev1Unit": "'L'",
        "fvcUnit": S(n + 1, "'L'"),
        "id": f"'r{n}-' || event_id",
    }


def result_sql(i: int) -> str:
    p = f"results.{i}"
    return f"""{{'fvc': "{p}.fvc", 'created_date': "{p}.createdDate", 'fev1_over_fvc': coalesce("{p}.fev1OverFvc", -1.0),
        'custom_data': CAST({CUSTOM_SQL} AS JSON), 'fev1': "{p}.fev1", 'fev1_unit': "{p}.fev1Unit", 'fvc_unit': "{p}.fvcUnit", 'id': "{p}.id"}}"""


mapped(
    "spirometry_session",
    {
        "id": "'sp' || event_id",
        "createdDate": "'2024-01-02'",
        "spirometer": Obj({"manufacturer": "'ma'", "name": S(0, "'na'"), "deviceId": "'d' || user_id", "customData": CUSTOM}),
        "results": Arr([result(0), result(1)], ["true", "event_id % 3 = 0"]),
        "height": "concat('', event_id % 200)",
        "heightUnit": "'cm'",
        "weight": S(2, "value"),
        "weightUnit": S(3, "'kg'"),
        "customData": CUSTOM,
    },
    [
        same("id", "id"),
        same("created_date", "createdDate"),
        same("spirometer_manufacturer", "spirometer.manufacturer"),
        same("spirometer_name", "spirometer.name"),
        same("spirometer_device_id", "spirometer.deviceId"),
        f"{CUSTOM_SQL} AS spirometer_custom_data",
        json_list("results", [(f'"results.{i}"', result_sql(i)) for i in (0, 1)]),
        same("height", "height", "DOUBLE"),
        same("height_unit", "heightUnit"),
        same("weight", "weight"),
        same("weight_unit", "weightUnit"),
        f"{CUSTOM_SQL} AS custom_data",
    ],
    where=has_required("spirometer.name", "weightUnit")
    + """ AND weight IS NOT NULL AND (x OR ("results.0.fvcUnit" IS NOT NULL AND (NOT "results.1" OR "results.1.fvcUnit" IS NOT NULL)))""",
)

# Devices.

HEARTBEAT_TEXT = {
    "app_heartbeat_id": "_id", "platform": "platform", "rid": "rid", "app_version": "app_version", "model": "model",
    "date_created": "dateC", "packet_type": "packet_type", "device_id": "device_id", "os_version": "os_version",
    "network_type": "network_type", "location_fix_time": "location_fix_time", "location_type": "location_type",
    "launch_reason": "launch_reason", "bluetooth_status": "bluetooth_status", "app_state": "app_state",
    "location_status": "location_status",
}
HEARTBEAT_FLAGS = ["signed_in", "push_on", "location_on", "ble_support", "activity_on"]
KEPT = "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '[\"gps\"]' END"
mapped(
    "app_heartbeat",
    {k: S(i, f"'{k}' || event_id") for i, k in enumerate(HEARTBEAT_TEXT.values())}
    | {k: S(i, f"event_id % {i + 2} = 0") for i, k in enumerate(HEARTBEAT_FLAGS)}
    | {
        "lat": S(0, "value"),
        "lng": S(1, "-value"),
        "heartbeat_count": S(2, "event_id * 1000000"),
        "launch_count": S(3, "event_id % 9"),
        "precision": S(0, "concat('', event_id % 50)"),
        "push_type": Arr(["'gps'", "''"], ["event_id % 3 = 1", "event_id % 6 = 1 OR event_id % 3 = 2"]),
        "activity_type": Arr(["'gps'", "''"], ["event_id % 3 = 1", "event_id % 6 = 4 OR event_id % 3 = 2"]),
    },
    [same(n, k) for n, k in HEARTBEAT_TEXT.items()]
    + [same(k, k) for k in HEARTBEAT_FLAGS]
    + [
        same('"timestamp"', "dateC"),
        same("latitude", "lat"),
        same("longitude", "lng"),
        same("heartbeat_count", "heartbeat_count"),
        same("launch_count", "launch_count"),
        same('"precision"', "precision", "DOUBLE"),
        f"{KEPT} AS push_type",
        f"{KEPT} AS activity_type",
    ],
)

MESSAGE_TEXT = {
    "type": "typ", "raw": "raw", "device_model": "device_model", "system_firmware_version": "system_firmware_version",
    "date_recorded": "dateR", "date_saved": "dateS", "mac": "mac", "firmware_version": "frm", "mod": "mod",
    "sensor_event_id": "evtid", "hub_id": "hub_id", "date_proxy_received": "datP", "date_proxy_transmitted": "datT",
    "proxy_mac": "trans_mac", "proxy_platform": "trans_plat", "proxy_platform_version": "trans_ver",
    "proxy_app_version": "app_ver", "user_day_id": "userdayId", "event_id": "eventId", "medication_id": "mid",
    "event_record_status": "event_record_status",
}
TRUTHS = {
    "moved": ("event_id % 2 = 0", "event_id % 2 = 0"),
    "installed": ("CASE event_id % 3 WHEN 0 THEN 'false' WHEN 1 THEN '' END", "event_id % 3 = 0"),
    "orientation": ("event_id % 3", "event_id % 3 <> 0"),
    "silent": ("CASE WHEN event_id % 3 = 0 THEN '@@0@@' WHEN event_id % 3 = 1 THEN '@@1.5@@' END", "event_id % 3 = 1"),
    "manual_heartbeat": (S(0, "true"), '"ext_status.0.manual_heartbeat" IS NOT NULL'),
}


def status_body() -> dict:
    out = {}
    for i, (name, (kind, _)) in enumerate(EXTENDED_STATUS.items()):
        if kind == "truth":
            out[name] = TRUTHS[name][0]
        elif kind == "double":
            out[name] = S(i, "value / 2")
        elif kind == "string":
            out[name] = S(i, "event_id % 5")
        else:
            out[name] = S(i, f"event_id % {i + 50}") if i % 3 else S(i, f"concat('', event_id % {i + 50})")
    return out


def status_sql() -> list[str]:
    out = []
    sql_kind = {"double": "DOUBLE", "cut": "INTEGER", "string": "VARCHAR"}
    for name, (kind, default) in EXTENDED_STATUS.items():
        if kind == "truth":
            value = f"coalesce({TRUTHS[name][1]}, false)"
        else:
            shown = f"'{default}'" if kind == "string" else default
            value = f'CAST(coalesce("ext_status.0.{name}", {shown}) AS {sql_kind[kind]})'
            if kind == "cut":
                value = f'coalesce(CAST("ext_status.0.{name}" AS INTEGER), {shown})'
            elif kind == "string":
                value = f'coalesce(CAST("ext_status.0.{name}" AS VARCHAR), {shown})'
        out.append(f'CASE WHEN "ext_status.0" THEN {value} END AS extended_status_{name}')
    return out


LOCATED = "event_id % 5 IN (1, 2)"
mapped(
    "sensor_message",
    {k: S(i, f"'{k}' || event_id") for i, k in enumerate(MESSAGE_TEXT.values())}
    | {
        "bat": S(0, "event_id % 100"),
        "elapsed": S(1, "event_id % 70 + 0.5"),
        "ext_status": Arr([status_body()], ["event_id % 4 <> 2"]),
        "loc": Arr(
            ["CASE WHEN event_id % 5 = 2 THEN -value ELSE value END",
             "CASE event_id % 5 WHEN 0 THEN value - value WHEN 1 THEN -value ELSE value END"],
            ["event_id % 5 < 4", "event_id % 5 < 3"],
        ),
        "locP": S(2, "event_id % 30"),
        "locM": S(3, "'gps'"),
        "loc_time": S(0, "'2024-01-02'"),
        "datalink": S(1, "event_id % 2 = 0"),
        "tzT": S(2, "event_id % 12"),
        "src": S(3, "'hub'"),
        "_id": S(0, "'sm' || event_id"),
        "v": "value",
    },
    [same(n, k) for n, k in MESSAGE_TEXT.items()]
    + [
        same("battery", "bat", "INTEGER"),
        'CAST(floor("elapsed") AS INTEGER) AS elapsed',
        *status_sql(),
        "CASE event_id % 5 WHEN 1 THEN v WHEN 2 THEN -v END AS latitude",
        "CASE event_id % 5 WHEN 1 THEN -v WHEN 2 THEN v END AS longitude",
        f'CASE WHEN {LOCATED} THEN CAST("locP" AS DOUBLE) END AS "precision"',
        f'CASE WHEN {LOCATED} THEN "locM" END AS location_method',
        f'CASE WHEN {LOCATED} THEN "loc_time" END AS location_time',
        or_default("data_link", "datalink", "false", "BOOLEAN"),
        """coalesce(CAST("tzT" AS VARCHAR), 'false') AS transmission_device_offset""",
        or_default("source", "src", "'false'"),
        or_default("sensor_message_id", "_id", "'-1'"),
    ],
)

# Shipments and groups.

HISTORY = [("date", "date"), ("status", "status"), ("est_delivery_date", "estDeliveryDate")]


def history(n: int) -> dict:
    return {"date": S(n, "'2024-01-02'"), "status": S(n + 1, "'st'"), "estDeliveryDate": S(n + 2, "'2024-01-09'")}


SHIPMENT = {
    "status": "status", "carrier": "carrier", "tracking_code": "trackingCode", "date_shipped": "dateShipped",
    "est_delivery_date": "estDeliveryDate", "service_level": "serviceLevel",
}
mapped(
    "shipment_status",
    {k: S(i, f"'{k}' || event_id") for i, k in enumerate(SHIPMENT.values())}
    | {
        "statusHistory": Arr([history(0), history(1)], ["event_id % 3 <> 0", "event_id % 6 = 1"]),
        "mac": "CASE event_id % 4 WHEN 0 THEN 'mac' WHEN 1 THEN '' END",
    },
    [same(n, k) for n, k in SHIPMENT.items()]
    + [
        json_list("status_history", [(f'"statusHistory.{i}"', element(f"statusHistory.{i}", HISTORY)) for i in (0, 1)]),
        "CASE WHEN event_id % 4 = 0 THEN 'mac' END AS mac",
    ],
)

GROUP_FLAGS = {
    "act_required": "actRequired", "cat_required": "catRequired", "demo_mode_enabled": "demoModeEnabled",
    "fb_tracking": "fbTracking", "hub_allowed": "hubAllowed", "mailing_address_required": "mailingAddressRequired",
    "preemptive_required": "preemptiveRequired", "provider_enrollment_enabled": "providerEnrollmentEnabled",
    "self_enrollment_enabled": "selfEnrollmentEnabled", "time_zone_required": "timeZoneRequired",
}
GROUP_TEXT = {
    "anonymization_method": "anonymizationMethod", "country": "country", "display_name": "displayName",
    "language": "language", "name": "name", "time_zone": "timeZone", "support_phone": "supportPhone",
    "support_email": "supportEmail",
}
GROUP_OPTIONAL = {
    "default_privacy_policy": "defaultPrivacyPolicy", "default_terms_and_conditions": "defaultTermsAndConditions",
    "device_encryption_and_passcode": "deviceEncryptionAndPasscode", "order_trigger_strategy": "orderTriggerStrategy",
    "protocol": "protocol",
}
GROUP_LISTS = {
    "default_data_consent_forms": "defaultDataConsentForms", "demographics": "demographics",
    "medication_black_list": "medicationBlackList", "medication_white_list": "medicationWhiteList",
    "postal_codes_allowed": "postalCodesAllowed", "sensor_black_list": "sensorBlackList",
    "strict_dose_medication_list": "strictDoseMedicationList",
}
AGREEMENT = [("adult_filter", "adultFilter"), ("disease_filter", "diseaseFilter"), ("medication_filter", "medicationFilter"), ("file_name", "filename")]
mapped(
    "group",
    {k: f"(event_id + {i}) % 2 = 0" for i, k in enumerate(GROUP_FLAGS.values())}
    | {k: S(i, f"'{k}'") if i < 2 else f"'{k}' || user_id" for i, k in enumerate(GROUP_TEXT.values())}
    | {k: S(i, f"'{k}'") for i, k in enumerate(GROUP_OPTIONAL.values())}
    | {k: Arr([f"'{k}' || event_id", "'z'"], [f"(event_id + {i}) % 3 = 0", f"(event_id + {i}) % 6 = 0"]) for i, k in enumerate(GROUP_LISTS.values())}
    | {
        "id": S(3, "'gr' || user_id"),
        "diseases": Arr(["'asthma'", "'copd'"], ["true", "event_id % 2 = 0"]),
        "maxControlCount": S(2, "event_id % 4"),
        "additionalUserAgreements": Arr(
            [{k: f"'{k}'" for _, k in AGREEMENT} | {"type": S(1, "'ty'")}], ["event_id % 3 = 0"]
        ),
        "medicalIdsRequired": Arr(
            [
                {
                    "descriptorKey": "'dk'",
                    "isRequired": "event_id % 2 = 0",
                    "label": S(0, "'la'"),
                    "validator": Obj({"en-US": S(1, "'va'")}, "event_id % 3 <> 0"),
                }
            ],
            ["event_id % 5 < 3"],
        ),
    },
    [same(n, k) for n, k in (GROUP_FLAGS | GROUP_TEXT | GROUP_OPTIONAL).items()]
    + [json_list(n, [(f'"{k}.{i}"', f'"{k}.{i}.value"') for i in (0, 1)]) for n, k in GROUP_LISTS.items()]
    + [
        json_list("diseases", [(f'"diseases.{i}"', f'"diseases.{i}.value"') for i in (0, 1)]),
        same("max_control_count", "maxControlCount", "INTEGER"),
        json_list(
            "additional_user_agreements",
            [(
                '"additionalUserAgreements.0"',
                element("additionalUserAgreements.0", AGREEMENT)[:-1] + ", 'type': coalesce(\"additionalUserAgreements.0.type\", '')}",
            )],
        ),
        json_list(
            "medical_ids_required",
            [(
                '"medicalIdsRequired.0"',
                """{'descriptor_key': "medicalIdsRequired.0.descriptorKey", 'is_required': "medicalIdsRequired.0.isRequired",
                 'label': coalesce("medicalIdsRequired.0.label", ''), 'validator': coalesce("medicalIdsRequired.0.validator.en-US", '')}""",
            )],
        ),
    ],
    where=has_required("anonymizationMethod", "country", "id"),
    envelope='user_id, "id" AS group_id, call_time, pub_sub_event_id, date_year, date_month',
)
