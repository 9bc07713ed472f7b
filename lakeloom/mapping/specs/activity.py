"""Bronze tables about what happens: events, alerts, scores, adherence, questionnaires, lungs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lakeloom.functions.nested import has_key, lacks_any, let, objects, some_lack, string_map, truthy
from lakeloom.functions.texts import csv_rows
from lakeloom.mapping.spec import (
    SENTINELS,
    Body,
    Derived,
    Mapping,
    group,
    if_missing,
    if_null,
    listing,
    not_null,
    optional,
    required,
)
from lakeloom.mapping.specs.common import plain_address


def _not_blank_object(body: Body, name: str) -> Column:
    text = F.try_variant_get(body.variant, f"$.body.{name}", "string")
    return text.isNotNull() & (text != "{}")


# Output order and types of the weather struct.
WEATHER = {
    "pm25": ("pm25", "double"),
    "pm10": ("pm10", "double"),
    "dew_point": ("dewPoint", "cut"),
    "wind_speed": ("windSpeed", "cut"),
    "o3": ("o3", "double"),
    "aqi_category": ("aqiCategory", "string"),
    "no2": ("no2", "double"),
    "heat_index": ("heatIndex", "cut"),
    "wind_chill": ("windChill", "cut"),
    "co": ("co", "double"),
    "wind_direction": ("windDirection", "cut"),
    "so2": ("so2", "double"),
    "aqi": ("aqi", "cut"),
    "pressure": ("pressure", "double"),
    "humidity": ("humidity", "cut"),
    "temperature": ("temperature", "cut"),
}

# Output order of the reverse-geocoded address struct.
GEOCODED = {
    "state_code": "stateCode",
    "postal_code": "postalCode",
    "city": "city",
    "country": "country",
    "formatted": "formatted",
    "state_or_region": "stateOrRegion",
    "street": "street",
    "street2": "street2",
}

ADDRESS_TYPE = {
    "address": {"latitude": "double", "longitude": "double", "precision": "double"}
    | {source: "string" for source in GEOCODED.values()}
}

PLACE_TYPE = {
    "place": {
        "location": {"coordinates": ["double"]},
        "type": "string",
        "name": "string",
        "element": "string",
        "id": "bigint",
    }
}


def _located(name: str):
    def build(body: Body) -> Column:
        address = body["address"]
        return F.when(address["latitude"].isNotNull() & address["longitude"].isNotNull(), address[name])

    return Derived(name, ADDRESS_TYPE, build)


def _geocoded(body: Body) -> Column:
    address = body["address"]
    parts = [F.coalesce(address[source], F.lit("")).alias(name) for name, source in GEOCODED.items()]
    return F.when(address["formatted"].isNotNull(), F.struct(*parts))


def _weather(body: Body) -> Column:
    sent = body["weather"]
    parts = [sent[source].alias(name) for name, (source, _) in WEATHER.items()]
    return F.when(_not_blank_object(body, "weather"), F.struct(*parts))


def _place(body: Body) -> Column:
    place = body["place"]
    point = place["location"]["coordinates"]
    return F.when(
        _not_blank_object(body, "place"),
        F.struct(
            F.get(point, F.lit(1)).alias("latitude"),
            F.get(point, F.lit(0)).alias("longitude"),
            *[place[name].alias(name) for name in ("type", "name", "element", "id")],
        ),
    )


def _place_check(body: Body) -> Column:
    lacking = [~has_key(body.variant, f"$.body.place.{name}") for name in ("type", "name", "element", "id")]
    lacking.append(F.coalesce(F.size(body["place"]["location"]["coordinates"]), F.lit(-1)) < 2)
    some = lacking[0]
    for one in lacking[1:]:
        some = some | one
    return F.when(_not_blank_object(body, "place") & some, F.lit("missing: place"))


EVENT = Mapping(
    "event",
    (
        "address_updated",
        "note_updated",
        "preempt_updated",
        "sensor_event_created",
        "sensor_event_deleted",
        "sensor_event_updated",
        "symptom_created",
        "symptom_deleted",
        "trigger_created",
        "trigger_deleted",
        "weather_updated",
    ),
    (
        not_null("event_id", "id"),
        not_null("date"),
        not_null("night_event", kind="boolean"),
        not_null("source"),
        optional("doses", kind="int"),
        optional("preemptive", kind="boolean"),
        optional("medication_id"),
        group("medication", [optional("medication_type", "type")], shape="inline"),
        listing("triggers"),
        listing("symptoms"),
        _located("latitude"),
        _located("longitude"),
        _located("precision"),
        Derived("address", ADDRESS_TYPE, _geocoded),
        Derived("weather", {"weather": {s: k for s, k in WEATHER.values()}}, _weather),
        Derived("place", PLACE_TYPE, _place, _place_check),
        Derived("note", {"note": "string"}, lambda body: F.when(F.length(body["note"]) > 0, body["note"])),
    ),
)


def _deleted_only(value: Column, body: Body) -> Column:
    return F.when(body.event_type == "alert_deleted", value)


ALERT = Mapping(
    "alert",
    (
        "alert_adherence_created",
        "alert_at_risk_created",
        "alert_controller_volume_created",
        "alert_deleted",
        "alert_exacerbation_created",
        "alert_missed_dose_created",
        "alert_quiet_sensor_created",
        "alert_rescue_usage_created",
        "alert_rescue_volume_created",
        "alert_transition_created",
    ),
    (
        required("alert_id", "_id"),
        required("deleted", kind="boolean"),
        required("acknowledged", kind="boolean"),
        required("date_created", "dateC"),
        required("user_role"),
        required("user_deleted", kind="boolean"),
        Derived(
            "alert_type",
            {"alertType": "string"},
            lambda body: _deleted_only(body["alertType"], body),
            check=lambda body: _deleted_only(
                F.when(~has_key(body.variant, "$.body.alertType"), F.lit("missing: alertType")), body
            ),
        ),
        Derived(
            "date_updated",
            {"updatedAt": "string"},
            lambda body: _deleted_only(
                F.when(has_key(body.variant, "$.body.updatedAt"), body["updatedAt"]).otherwise(body.call_time), body
            ),
        ),
        optional("notified_id"),
        optional("correlation_id"),
        optional("medication_id", "medId"),
        optional("dose_time", "dosageTime"),
        Derived(
            "first_at_risk_alert",
            {"firstAtRiskAlert": "string"},
            lambda body: F.when(
                body["firstAtRiskAlert"].isNotNull(),
                (body["firstAtRiskAlert"] == "true")
                & (F.schema_of_variant(F.try_variant_get(body.variant, "$.body.firstAtRiskAlert", "variant")) == "STRING"),
            ),
        ),
        optional("day_uses", kind="cut"),
        optional("percent_change", kind="cut"),
        optional("asthma_control_score", "asthmaScore"),
        group(
            "variables",
            [
                optional("mac"),
                group("quiet_sensor", [optional("model")], shape="inline"),
                optional("comparator"),
                optional("threshold"),
                optional("window_size", "window_size"),
                optional("window_unit", "window_unit"),
                optional("actual"),
                optional("window_label", "window_label"),
            ],
            shape="inline",
        ),
    ),
)

PATIENT_SCORE = Mapping(
    "patient_score",
    ("patient_score_updated",),
    (
        if_missing("baseline", kind="double"),
        not_null("date", "dateR"),
        not_null("score", kind="double"),
        if_null("disease"),
    ),
)

GEO_LOCATION = Mapping(
    "patient_geo_location",
    ("patient_geo_location_created",),
    (
        Derived(
            "latitude",
            {"location": {"coordinates": ["double"]}},
            lambda body: F.get(body["location"]["coordinates"], F.lit(1)),
            check=lambda body: F.when(
                F.coalesce(F.size(body["location"]["coordinates"]), F.lit(-1)) < 2, F.lit("missing: location.coordinates")
            ),
        ),
        Derived(
            "longitude",
            {"location": {"coordinates": ["double"]}},
            lambda body: F.get(body["location"]["coordinates"], F.lit(0)),
        ),
        optional("precision", kind="double"),
        required("date", "dateR"),
        plain_address("address", "address"),
        Derived(
            "place",
            {
                "place": {
                    "location": ["double"],
                    "type": "string",
                    "name": "string",
                    "element": "string",
                    "id": "bigint",
                }
            },
            lambda body: F.when(
                body["place"].isNotNull(),
                F.struct(
                    F.get(body["place"]["location"], F.lit(0)).alias("latitude"),
                    F.get(body["place"]["location"], F.lit(1)).alias("longitude"),
                    *[body["place"][name].alias(name) for name in ("type", "name", "element", "id")],
                ),
            ),
            check=lambda body: F.when(
                body["place"].isNotNull()
                & (
                    (F.coalesce(F.size(body["place"]["location"]), F.lit(-1)) < 2)
                    | ~has_key(body.variant, "$.body.place.type")
                    | ~has_key(body.variant, "$.body.place.name")
                    | ~has_key(body.variant, "$.body.place.element")
                    | ~has_key(body.variant, "$.body.place.id")
                ),
                F.lit("missing: place"),
            ),
        ),
    ),
)

# Adherence: figures count only when both the doses taken and the date are there.

ADHERENCE_TYPE = {
    "dateR": "string",
    "adherence": {
        "dosesExpected": "int",
        "dosesTaken": "int",
        "dosesTakenActual": "int",
        "percent": "double",
        "percentActual": "double",
        "meds": [
            {
                "mid": "string",
                "dosesExpected": "int",
                "dosesTaken": "int",
                "dosesTakenActual": "int",
                "percent": "double",
                "percentActual": "double",
            }
        ],
    },
}


def _counted(body: Body) -> Column:
    return body["adherence"]["dosesTaken"].isNotNull() & body["dateR"].isNotNull()


def _figure(name: str, source: str, default, *, zero: bool = False):
    def build(body: Body) -> Column:
        value = body["adherence"][source]
        if zero:
            value = F.coalesce(value, F.lit(0))
        chosen = F.when(_counted(body), value)
        return chosen if default is None else chosen.otherwise(F.lit(default))

    return Derived(name, ADHERENCE_TYPE, build)


def _meds(body: Body) -> Column:
    def one(m: Column) -> Column:
        return F.struct(
            m["mid"].alias("medication_id"),
            m["dosesExpected"].alias("doses_expected"),
            F.coalesce(m["dosesTaken"], F.lit(0)).alias("doses_taken"),
            F.coalesce(m["dosesTakenActual"], F.lit(0)).alias("doses_taken_actual"),
            m["percent"].alias("percent"),
            m["percentActual"].alias("percent_actual"),
        )

    counted = F.when(_counted(body), body["adherence"]["meds"])
    none = F.slice(F.array(F.lit(None).cast(_meds_type())), 1, 0)
    return F.coalesce(F.transform(counted, one), none)


def _meds_type() -> str:
    return (
        "struct<medication_id:string,doses_expected:int,doses_taken:int,"
        "doses_taken_actual:int,percent:double,percent_actual:double>"
    )


def _adherence_check(body: Body) -> Column:
    names = ("dosesExpected", "dosesTakenActual", "percent", "percentActual", "meds")
    lacking = F.coalesce(
        *[F.when(~has_key(body.variant, f"$.body.adherence.{n}"), F.lit(f"missing: adherence.{n}")) for n in names]
    )
    meds = some_lack(
        body.variant, "$.body.adherence.meds", "mid", "dosesExpected", "dosesTaken", "dosesTakenActual", "percent", "percentActual"
    )
    return F.when(_counted(body), F.coalesce(lacking, F.when(meds, F.lit("missing: adherence.meds[]"))))


ADHERENCE = Mapping(
    "adherence",
    ("adherence_updated",),
    (
        Derived(
            "doses_expected",
            ADHERENCE_TYPE,
            lambda body: F.when(_counted(body), body["adherence"]["dosesExpected"]).otherwise(F.lit(-1)),
            check=_adherence_check,
        ),
        _figure("doses_taken", "dosesTaken", None, zero=True),
        _figure("doses_taken_actual", "dosesTakenActual", None, zero=True),
        _figure("percent", "percent", -1.0),
        _figure("percent_actual", "percentActual", -1.0),
        Derived(
            "date",
            ADHERENCE_TYPE,
            lambda body: F.when(_counted(body), body["dateR"]).otherwise(F.lit(SENTINELS["datetime"])),
        ),
        Derived("meds", ADHERENCE_TYPE, _meds),
        Derived("bye_bye", ADHERENCE_TYPE, lambda body: F.when(~F.coalesce(_counted(body), F.lit(False)), F.lit("bye"))),
    ),
)

# Forecasts carry their model input as CSV text.

# Which input columns are numbers, and how many input rows there are.
FORECAST_FLOATS = [
    "co", "co_max", "drybulbfahrenheit", "drybulbfahrenheit_max",
    "lat", "lon", "no2", "no2_max", "o3", "o3_max", "pm10", "pm10_max",
    "pm25", "pm25_max", "relativehumidity", "relativehumidity_max",
    "so2", "so2_max", "stationpressure", "stationpressure_max",
    "visibility", "visibility_max", "wind_speed", "wind_speed_max",
    "wind_direction",
]
FORECAST_INTS = [
    "dew_point", "dew_point_max", "heat_index", "heat_index_max",
    "month", "night_events", "norm_day", "prescribed_adh_puffs",
    "rscu_puffs", "taken_adh_puffs", "wind_chill", "wind_chill_max",
]
FORECAST_ROWS = 8


def _numbers() -> list[tuple[str, str]]:
    return [(name, "double") for name in FORECAST_FLOATS] + [(name, "int") for name in FORECAST_INTS]


def _first_rows(body: Body) -> Column:
    return F.slice(csv_rows(body["input"]), 1, FORECAST_ROWS)


def _forecast_row(row: Column, index: Column) -> Column:
    typed = [F.try_element_at(row, F.lit(name)).try_cast(kind).alias(name) for name, kind in _numbers()]
    known = [name for name, _ in _numbers()]
    other = F.map_filter(row, lambda key, _: ~key.isin(known))
    return F.struct(index.alias("index"), *typed, other.alias("other"))


def _forecast_check(body: Body) -> Column:
    def wrong(row: Column) -> Column:
        bad = F.lit(False)
        for name, kind in _numbers():
            cell = F.try_element_at(row, F.lit(name))
            bad = bad | (F.map_contains_key(row, F.lit(name)) & cell.try_cast(kind).isNull())
        return bad

    def found(rows: Column) -> Column:
        few = F.coalesce(F.size(rows), F.lit(0)) < FORECAST_ROWS
        return F.when(few, F.lit("input: fewer than 8 rows")).when(F.exists(rows, wrong), F.lit("type: input"))

    return let(_first_rows(body), found)


FORECAST = Mapping(
    "asthma_forecast",
    ("asthma_forecast_created",),
    (
        required("id"),
        required("input"),
        required("output"),
        if_null("model_version", default="1.1.0"),
        if_null("webware_version", default="4.35.0"),
        Derived(
            "prediction_date",
            {"predictionDate": "string"},
            lambda body: F.coalesce(body["predictionDate"], body.call_time),
        ),
        Derived(
            "input_rows",
            {"input": "string"},
            lambda body: F.transform(_first_rows(body), _forecast_row),
            check=_forecast_check,
        ),
    ),
)

ACT = Mapping(
    "act",
    ("act_created",),
    (
        optional("answered_by_user_id", "answeredByUid"),
        required("score", kind="double"),
        required("answers", "ans"),
        required("date_received", "dateR"),
        required("date_saved", "dateS"),
        required("type"),
    ),
)

CAT = Mapping(
    "cat",
    ("cat_created",),
    (
        optional("answered_by_user_id", "answeredByUid"),
        required("score", kind="double"),
        required("answers", "ans"),
        required("date_received", "dateR"),
        required("date_created", "dateC"),
    ),
)

# Questionnaires: groups of questions with answers, flattened to two lists.

ANSWER_TYPE = {
    "answerId": "string",
    "text": "string",
    "rowLabel": "string",
    "rowLabelAnswerId": "string",
    "colLabel": "string",
    "colLabelAnswerId": "string",
    "weight": "double",
    "quizScore": "double",
}
QUESTIONNAIRE_TYPE = {
    "questionnaire": [
        {
            "questionnaireGroupId": "string",
            "questions": [{"questionId": "string", "text": "string", "answers": [ANSWER_TYPE]}],
        }
    ]
}


def _questions(body: Body) -> Column:
    def question(section: Column, q: Column) -> Column:
        return F.struct(
            q["questionId"].alias("question_id"),
            truthy(F.transform(q["answers"], lambda a: a["answerId"])).alias("answers"),
            section["questionnaireGroupId"].alias("group_id"),
            q["text"].alias("text"),
        )

    return F.flatten(
        F.transform(body["questionnaire"], lambda g: F.transform(g["questions"], lambda q: question(g, q)))
    )


def _answers(body: Body) -> Column:
    def answer(q: Column, a: Column) -> Column:
        return F.struct(
            F.coalesce(a["answerId"], F.lit("")).alias("answer_id"),
            F.coalesce(a["colLabel"], F.lit("")).alias("col_label"),
            F.coalesce(a["colLabelAnswerId"], F.lit("")).alias("col_label_answer_id"),
            q["questionId"].alias("question_id"),
            F.coalesce(a["quizScore"], F.lit(-1.0)).alias("quiz_score"),
            F.coalesce(a["rowLabel"], F.lit("")).alias("row_label"),
            F.coalesce(a["rowLabelAnswerId"], F.lit("")).alias("row_label_answer_id"),
            a["text"].alias("text"),
            F.coalesce(a["weight"], F.lit(-1.0)).alias("weight"),
        )

    questions = F.flatten(F.transform(body["questionnaire"], lambda g: g["questions"]))
    return F.flatten(F.transform(questions, lambda q: F.transform(q["answers"], lambda a: answer(q, a))))


def _questionnaire_check(body: Body) -> Column:
    def question_lacks(q: Column) -> Column:
        return (
            lacks_any(q, "questionId", "text")
            | objects(q, "$.answers").isNull()
            | some_lack(q, "$.answers", "text")
        )

    def section_lacks(g: Column) -> Column:
        questions = objects(g, "$.questions")
        some = F.coalesce(F.exists(questions, question_lacks), F.lit(True))
        return some | (~has_key(g, "$.questionnaireGroupId") & (F.size(questions) > 0))

    sections = objects(body.variant, "$.body.questionnaire")
    return F.when(F.coalesce(F.exists(sections, section_lacks), F.lit(True)), F.lit("missing: questionnaire"))


QUESTIONNAIRE = Mapping(
    "questionnaire_response",
    ("questionnaire_response_created",),
    (
        required("id", "_id"),
        Derived(
            "questions",
            QUESTIONNAIRE_TYPE,
            _questions,
            check=_questionnaire_check,
        ),
        Derived("answers", QUESTIONNAIRE_TYPE, _answers),
        required("date_saved", "dateS"),
        if_null("language"),
        required("questionnaire_id"),
        required("questionnaire_name"),
        required("questionnaire_response_date_created"),
        required("questionnaire_response_date_modified"),
        required("questionnaire_response_id"),
        required("questionnaire_service"),
        required("questionnaire_version_id"),
        optional("resource_id", "rid"),
        optional("time_to_take_questionnaire", kind="double"),
    ),
)

# Spirometry: free-form custom data becomes string maps.

SPIROMETER_TYPE = {"spirometer": {"manufacturer": "string", "name": "string", "deviceId": "string"}}
RESULT_TYPE = {
    "results": [
        {
            "fvc": "double",
            "createdDate": "string",
            "fev1OverFvc": "double",
            "customData": "variant",
            "fev1": "double",
            "fev1Unit": "string",
            "fvcUnit": "string",
            "id": "string",
        }
    ]
}


def _spirometer(body: Body) -> Column:
    sent = body["spirometer"]
    return F.struct(
        sent["manufacturer"].alias("manufacturer"),
        string_map(body.variant, "$.body.spirometer.customData").alias("custom_data"),
        sent["name"].alias("name"),
        sent["deviceId"].alias("device_id"),
    )


def _results(body: Body) -> Column:
    def one(r: Column) -> Column:
        return F.struct(
            r["fvc"].alias("fvc"),
            r["createdDate"].alias("created_date"),
            F.coalesce(r["fev1OverFvc"], F.lit(-1.0)).alias("fev1_over_fvc"),
            string_map(r["customData"], "$").alias("custom_data"),
            r["fev1"].alias("fev1"),
            r["fev1Unit"].alias("fev1_unit"),
            r["fvcUnit"].alias("fvc_unit"),
            r["id"].alias("id"),
        )

    return F.transform(body["results"], one)


def _results_check(body: Body) -> Column:
    def broken(r: Column) -> Column:
        return r["fvc"].isNull() | r["fev1"].isNull()

    lacking = some_lack(body.variant, "$.body.results", "createdDate", "fev1Unit", "fvcUnit", "id")
    return F.when(body["results"].isNull(), F.lit("missing: results")).when(
        F.exists(body["results"], broken) | lacking, F.lit("missing: results[]")
    )


def _spirometer_check(body: Body) -> Column:
    return F.coalesce(
        *[
            F.when(~has_key(body.variant, f"$.body.spirometer.{n}"), F.lit(f"missing: spirometer.{n}"))
            for n in SPIROMETER_TYPE["spirometer"]
        ]
    )


SPIROMETRY = Mapping(
    "spirometry_session",
    ("spirometry_session_created",),
    (
        required("id"),
        required("created_date"),
        Derived("spirometer", SPIROMETER_TYPE, _spirometer, _spirometer_check),
        Derived("results", RESULT_TYPE, _results, _results_check),
        not_null("height", kind="double"),
        required("height_unit"),
        not_null("weight", kind="double"),
        required("weight_unit"),
        Derived("custom_data", {}, lambda body: string_map(body.variant, "$.body.customData")),
    ),
)

MAPPINGS = [
    EVENT,
    ALERT,
    PATIENT_SCORE,
    GEO_LOCATION,
    ADHERENCE,
    FORECAST,
    ACT,
    CAT,
    QUESTIONNAIRE,
    SPIROMETRY,
]
