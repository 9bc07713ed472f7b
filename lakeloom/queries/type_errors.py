"""What is reported of values of a wrong type, in every field of every mapping that is no text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from lakeloom.mapping.compiler import map_events
from lakeloom.mapping.registry import MAPPINGS
from lakeloom.queries.base import Tables, query
from lakeloom.queries.feed import Arr, Obj, envelopes

# The fields by mapping and how they are read. ``whole`` numbers keep their fraction or fail,
# of ``cut`` numbers it is dropped, ``number`` may have one, ``truth`` is true or false, ``digits`` is a number of text.
CHANNELS = "email sms push"
PLAN = {
    "whole": "plan.medications[].usageList[].hour plan.medications[].usageList[].minute plan.medications[].usageList[].doses "
    "plan.medications[].usageList[].unitDoses plan.medications[].sensors[].battery plan.medications[].sensors[].batteryLevel",
    "truth": "plan.medications[].dataLink plan.medications[].sensors[].dataLink plan.medications[].sensors[].forceSilent "
    "plan.medications[].sensors[].silent",
}
PROFILE = {
    "whole": f"age {PLAN['whole']}",
    "cut": "event.totalRescue sync.total",
    "truth": f"notifications.digest.email {PLAN['truth']} isFakeBirthDate isFakeName isPhoneMobile "
    + " ".join(
        f"notifications.{c}.{way}"
        for c in "notes missedDose rescueUsage goal quietSensor actInvite transition environmental atRisk questionnaire".split()
        for way in CHANNELS.split()
    ),
}
FIELDS = {
    "provider": {
        "truth": "notifications.digest.email preferences.portalWelcomeDone preferences.weekendDigests preferences.patientsHidden",
    },
    "caregiver": {
        "truth": "notifications.digest.email "
        + " ".join(
            f"notifications.{c}.{way}"
            for c in "environmental quietSensor goal rescueUsage missedDose actInvite notes transition atRisk".split()
            for way in CHANNELS.split()
        ),
    },
    "patient": PROFILE | {"number": "baseline"},
    "medication": PROFILE | {"number": "baseline"},
    "prospect": PROFILE,
    "event": {
        "whole": "doses place.id",
        "cut": "weather.dewPoint weather.windSpeed weather.heatIndex weather.windChill weather.windDirection weather.aqi "
        "weather.humidity weather.temperature",
        "number": "address.latitude address.longitude address.precision weather.pm25 weather.pm10 weather.o3 weather.no2 "
        "weather.co weather.so2 weather.pressure place.location.coordinates[]",
        "truth": "nightEvent preemptive",
    },
    "alert": {"cut": "dayUses percentChange", "truth": "deleted acknowledged userDeleted"},
    "patient_score": {"number": "baseline score"},
    "patient_geo_location": {"whole": "place.id", "number": "location.coordinates[] precision place.location[]"},
    "adherence": {
        "whole": "adherence.dosesExpected adherence.dosesTaken adherence.dosesTakenActual adherence.meds[].dosesExpected "
        "adherence.meds[].dosesTaken adherence.meds[].dosesTakenActual",
        "number": "adherence.percent adherence.percentActual adherence.meds[].percent adherence.meds[].percentActual",
    },
    "act": {"number": "score"},
    "cat": {"number": "score"},
    "questionnaire_response": {
        "number": "questionnaire[].questions[].answers[].weight questionnaire[].questions[].answers[].quizScore timeToTakeQuestionnaire",
    },
    "spirometry_session": {"number": "results[].fvc results[].fev1OverFvc results[].fev1 height weight"},
    "app_heartbeat": {
        "whole": "heartbeat_count launch_count",
        "number": "lat lng precision",
        "truth": "signed_in push_on location_on ble_support activity_on",
    },
    "sensor_message": {
        "whole": "bat",
        "cut": "elapsed "
        + " ".join(
            f"ext_status[].{name}"
            for name in (
                "wake_up_count awake_time reset_cause reset_cause_sw ms_depressed inhale_peak removal_threshold event_threshold "
                "ir_reference time_since_opened med_removal_count peak_to_mean_ratio peak_count inhale_mean_square press_count "
                "shake_duration shake_intensity press_to_inhale average_volume total_volume total_volume_first_second "
                "inhale_start_to_peak"
            ).split()
        ),
        "number": "locP ext_status[].temperature ext_status[].inhale_duration loc[]",
        "truth": "datalink",
    },
    "group": {
        "whole": "maxControlCount",
        "truth": "actRequired catRequired demoModeEnabled fbTracking hubAllowed mailingAddressRequired preemptiveRequired "
        "providerEnrollmentEnabled selfEnrollmentEnabled timeZoneRequired medicalIdsRequired[].isRequired",
    },
}
#: Damages by row: a fraction, a word, an object, and text that is a number.
DAMAGES = {"fraction": "@@20.5@@", "word": "many", "object": "@@{`a`:1}@@", "digits": "7"}
#: Which of them each way of reading reports. Text of digits is a number, but neither true nor false.
REPORTED = {
    "whole": ("fraction", "word", "object"),
    "cut": ("word", "object"),
    "number": ("word", "object"),
    "truth": ("word", "object", "digits"),
}


def checked_fields(name: str) -> list[tuple[str, str]]:
    """Paths and ways of reading, in one order."""
    return sorted((path, way) for way, paths in FIELDS[name].items() for path in paths.split())


def damaged_body(fields: list[tuple[str, str]]) -> dict:
    """A body with all fields in order, but one of them damaged: which and how follows from the event's number."""
    body: dict = {}
    n = len(fields)
    which = f"elt(cast((event_id div {n}) % {len(DAMAGES)} + 1 as int), {', '.join(map(repr, DAMAGES.values()))})"
    for at, (path, way) in enumerate(fields):
        fine = "'@@true@@'" if way == "truth" else "'@@7@@'"
        _put(body, path.split("."), f"if(event_id % {n} = {at}, {which}, {fine})")
    return _nodes(body)


def _put(into: dict, path: list[str], value: str) -> None:
    head, *rest = path
    if rest:
        _put(into.setdefault(head, {}), rest, value)
    else:
        into[head] = value


def _nodes(body: dict) -> dict:
    out = {}
    for key, value in body.items():
        node = _nodes(value) if isinstance(value, dict) else value
        if key.endswith("[]"):
            whole = {k: v for k, v in node.items()} if isinstance(node, dict) else node
            fine = _plain(whole)
            out[key[:-2]] = Arr([fine, whole], ["true", "true"])  # the damaged element comes second
        else:
            out[key] = Obj(node) if isinstance(node, dict) else node
    return out


def _plain(node):
    """The same node without damage."""
    if isinstance(node, dict):
        return {k: _plain(v) for k, v in node.items()}
    if isinstance(node, Obj):
        return Obj(_plain(node.fields))
    if isinstance(node, Arr):
        return Arr([_plain(i) for i in node.items], node.when)
    return node[node.rindex(", ") + 2 : -1] if node.startswith("if(") else node


def _expected() -> str:
    rows = []
    for name in FIELDS:
        fields = checked_fields(name)
        for at, (path, way) in enumerate(fields):
            for k, damage in enumerate(DAMAGES):
                if damage in REPORTED[way]:
                    rows.append(f"('{name}', 'type: {path}', {len(fields)}, {at}, {k})")
    return ",\n".join(rows)


@query(
    "map_type_errors",
    f"""
    SELECT mapping, error, count(*) AS events FROM events
    JOIN (VALUES {_expected()}) AS v(mapping, error, n, field, damage) ON event_id % n = field AND (event_id // n) % {len(DAMAGES)} = damage
    GROUP BY mapping, error
    """,
)
def type_errors(t: Tables) -> DataFrame:
    """Events by mapping and wrongly typed field, where every event has one damaged field at any depth."""

    def found(name: str) -> DataFrame:
        mapping = MAPPINGS[name]
        rows = map_events(envelopes(t, mapping.event_types, damaged_body(checked_fields(name))), mapping)
        wrong = rows.select(F.explode(F.filter("_errors", lambda e: e.startswith("type: "))).alias("error"))
        return wrong.groupBy("error").agg(F.count(F.lit(1)).alias("events")).select(F.lit(name).alias("mapping"), "error", "events")

    return reduce(DataFrame.unionByName, map(found, FIELDS))
