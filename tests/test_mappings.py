"""Golden envelopes: rules for absent values, failures, renamed fields, own mappings."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from lakeloom.mapping import registry
from lakeloom.mapping.compiler import good_rows, map_events, rejected_rows
from lakeloom.mapping.spec import Mapping, if_missing, if_null, listing, optional, required
from lakeloom.operators.routing import split_quarantine
from lakeloom.plans.bronze import bronze_table, by_table, tables_present, write_bronze
from lakeloom.session import scratch_dir
from lakeloom.sources.envelopes import decode_envelopes


def record(event_type, body, **changes):
    envelope = {
        "userId": "u", "groupId": "g", "callTime": "2020-01-02T03:04:05.678Z", "pubSubEvent": event_type,
        "pubSubEventId": "e", "pubSubArgs": [], "version": "1", "body": body,
    } | changes
    envelope = {k: v for k, v in envelope.items() if v != "DROP"}
    return base64.b64encode(json.dumps(envelope).encode()).decode()


def run(spark, mapping, *bodies, event_type=None, **changes):
    event_type = event_type or mapping.event_types[0]
    rows = [(n, record(event_type, b, **changes)) for n, b in enumerate(bodies)]
    records = spark.createDataFrame(rows, "n int, data string")
    found = map_events(decode_envelopes(records, keep=["n"]), mapping, keep=["n"]).orderBy("n").collect()
    return [r.asDict(recursive=True) for r in found]


PATIENT = registry.MAPPINGS["patient"]
LEAST = {"role": "patient", "createdDate": "2020-01-01"}


def test_registry():
    assert len(registry.MAPPINGS) == 25
    assert len(registry.EVENT_TYPES) == 65
    assert registry.EVENT_TYPES["medication_updated"].name == "patient"


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2020-01-02T03:04:05.678Z", "2020-01-02T03:04:05.678Z"),
        ("2020-01-02T03:04:05Z", "2020-01-02T03:04:05.000Z"),
        ("2020-01-02", "2020-01-02T00:00:00.000Z"),
        ("2020-01-02T03:04:05", "2020-01-02T03:04:05.000Z"),
        ("2020-01-02T03:04:05+0500", "2020-01-01T22:04:05.000Z"),
        ("2020-01-02T03:04Z", "2020-01-02T03:04:00.000Z"),
        ("2020-01-02T03:04:05.678+00:00", "2020-01-02T03:04:05.000Z"),
        ("1577934245678", "2020-01-02T03:04:05.678Z"),
        (1577934245678, "2020-01-02T03:04:05.678Z"),
        (None, None),
        ("garbage", None),
        ("2020-13-45", None),
        ("99999999999999999999", None),
    ],
)
def test_call_time_forms(spark, text, expected):
    row = run(spark, registry.MAPPINGS["patient_login"], {}, callTime=text)[0]
    assert row["call_time"] == expected
    assert row["_errors"] == ([] if expected else ["format: callTime"])


def test_key_missing_is_not_null(spark):
    missing, null, there = run(
        spark, PATIENT, LEAST, LEAST | {"givenName": None, "age": None, "phone": None}, LEAST | {"givenName": "a", "age": 7, "phone": 5}
    )
    assert (missing["given_name"], missing["age"], missing["phone"], missing["has_phone"]) == ("-1", -1, "-1", False)
    assert (null["given_name"], null["age"], null["phone"], null["has_phone"]) == (None, None, "-1", False)
    assert (there["given_name"], there["age"], there["phone"], there["has_phone"]) == ("a", 7, "5", True)
    assert [r["_errors"] for r in (missing, null, there)] == [[], [], []]


def test_patient_errors(spark):
    rows = run(
        spark,
        PATIENT,
        {},
        {"role": None, "createdDate": None},
        LEAST | {"createdDate": "soon"},
        LEAST | {"age": "old", "height": "tall"},
        LEAST | {"group": None},
        LEAST | {"mailingAddress": {"street": "s", "city": None}},
        LEAST | {"notifications": {"goal": {"email": True, "sms": None}}},
        LEAST | {"plan": {"medications": [{"medication": {"id": None}, "sensors": [{"battery": 1}]}]}},
        LEAST | {"externalIds": [{"key": "k"}]},
        LEAST | {"sync": {"sync": 1}},
    )
    assert [r["_errors"] for r in rows] == [
        ["missing: role", "missing: createdDate"],
        ["missing: role", "format: createdDate"],
        ["format: createdDate"],
        ["type: age", "type: height"],
        ["missing: group"],
        ["missing: mailingAddress.country"],
        ["missing: notifications.goal"],
        ["missing: plan.medications[]"],
        ["missing: externalIds[]"],
        ["missing: sync.total"],
    ]


def test_nulls_inside_elements_are_kept(spark):
    row = run(
        spark,
        PATIENT,
        LEAST
        | {
            "medicalIds": [{"key": None, "value": "v"}],
            "plan": {"medications": [{"medication": {"id": "m", "type": None}, "usageList": [{"hour": None, "minute": 5}]}]},
        },
    )[0]
    assert row["_errors"] == []
    assert row["medical_ids"] == [{"key": None, "value": "v"}]
    assert row["usage_list"] == [{"medication_id": "m", "hour": None, "minute": 5, "doses": None}]


def test_both_api_versions(spark):
    old = LEAST | {
        "height": 180, "medicalIds": [{"key": "a", "value": "1"}], "notifications": {"actInvite": {"email": True, "sms": False, "push": True}},
        "plan": {"medications": [{"medication": {"id": "m"}, "usageList": [{"hour": 8, "minute": 0, "doses": 2}], "sensors": [{"mac": "x", "battery": 5}]}]},
    }
    new = LEAST | {
        "height": {"value": 180}, "externalIds": [{"key": "a", "value": "1"}], "notifications": {"questionnaire": {"email": True, "sms": False, "push": True}},
        "plan": {"medications": [{"medication": {"id": "m"}, "usageList": [{"hour": 8, "minute": 0, "unitDoses": 2}], "sensors": [{"mac": "x", "batteryLevel": 5}]}]},
    }
    a, b = run(spark, PATIENT, old, new)
    assert a == b | {"n": 0}
    assert a["height"] == 180.0 and a["has_height"] and a["sensors"][0]["battery"] == 5


def test_prospect_conversion_only_for_created_patients(spark):
    created = run(spark, PATIENT, LEAST, event_type="patient_created", pubSubArgs=["prospect"])[0]
    plain = run(spark, PATIENT, LEAST, event_type="patient_created")[0]
    updated = run(spark, PATIENT, LEAST, event_type="patient_updated", pubSubArgs=["prospect"])[0]
    assert created["prospect_conversion_datetime"] == "2020-01-02T03:04:05.678Z"
    assert plain["prospect_conversion_datetime"] == "1970-01-01T00:00:00.000Z"
    assert updated["prospect_conversion_datetime"] is None


def test_first_sync_null_is_kept(spark):
    null, missing = run(spark, PATIENT, LEAST | {"sync": {"first": None}}, LEAST | {"sync": {"last": "2020"}})
    assert (null["sync"]["has_first"], null["sync"]["first"]) == (True, None)
    assert (missing["sync"]["has_first"], missing["sync"]["first"]) == (False, "1970-01-01T00:00:00.000Z")


def test_empty_objects_are_absent(spark):
    event = registry.MAPPINGS["event"]
    base = {"id": "i", "date": "d", "nightEvent": False, "source": "s"}
    empty, full = run(spark, event, base | {"weather": {}, "place": {}, "address": {}, "note": ""}, base | {"weather": {"aqi": "7"}})
    assert empty["_errors"] == [] and empty["weather"] is None and empty["place"] is None and empty["note"] is None
    assert full["weather"]["aqi"] == 7 and full["weather"]["pm25"] is None
    assert run(spark, event, base | {"nightEvent": None})[0]["_errors"] == ["missing: nightEvent"]


@pytest.mark.parametrize("name", list(registry.MAPPINGS))
def test_null_bodies_never_fail_the_job(spark, name):
    """Nulls, scalars and arrays instead of the body, and fields of the wrong kind, end in quarantine at worst."""
    mapping = registry.MAPPINGS[name]
    keys = {s for f in mapping.fields for s in f.types()}
    bodies = [None, 5, [1], {}, dict.fromkeys(keys), dict.fromkeys(keys, "x"), dict.fromkeys(keys, [1]), dict.fromkeys(keys, {"a": 1})]
    rows = run(spark, mapping, *bodies)
    assert len(rows) == len(bodies)


def test_missing_envelope_keys(spark):
    row = run(spark, registry.MAPPINGS["patient_login"], {}, userId="DROP", pubSubArgs="DROP")[0]
    assert row["_errors"] == ["missing: userId", "missing: pubSubArgs"]


def test_rejects_hold_no_payload(spark):
    records = spark.createDataFrame([(record("act_created", {"secret": 1}),)], "data string")
    bad = rejected_rows(map_events(decode_envelopes(records), registry.MAPPINGS["act"]))
    assert bad.columns == ["user_id", "group_id", "call_time", "pub_sub_event_id", "errors"]
    assert bad.first().errors == ["missing: score", "missing: ans", "missing: dateR", "missing: dateS", "missing: type"]


def test_own_mapping(spark):
    mine = Mapping(
        "visit",
        ("visit_created",),
        (required("place"), optional("note"), if_null("count", kind="int"), if_missing("kind"), listing("tags")),
    )
    registry.register(mine)
    try:
        row = run(spark, mine, {"place": "p", "tags": ["a"], "kind": None})[0]
        assert (row["place"], row["count"], row["kind"], row["tags"], row["_errors"]) == ("p", -1, None, ["a"], [])
        with pytest.raises(ValueError):
            registry.register(mine)
    finally:
        del registry.MAPPINGS["visit"], registry.EVENT_TYPES["visit_created"]


def test_bronze_job(spark):
    rows = [record("sensor_first_sync", {"mac": "m", "mid": 1}), record("sensor_first_sync", {"mac": "m"}), record("mystery", {}), "###"]
    envelopes = decode_envelopes(spark.createDataFrame([(r,) for r in rows], "data string"))
    good, bad = split_quarantine(envelopes)
    assert (good.count(), bad.count()) == (2, 2)
    root = scratch_dir(spark, "bronze")
    for _ in range(2):  # a repeated run replaces itself
        write_bronze(envelopes, root, run="r1", tables=["sensor_sync", "act"])
    written = spark.read.parquet(f"{root}/sensor_sync").collect()
    assert [(r.mac, r.medication_id, r.date_year, r.date_month) for r in written] == [("m", "1", 2020, 1)]
    assert spark.read.parquet(f"{root}/_rejected/mapping").filter(F.col("bronze_table") == "sensor_sync").count() == 1
    assert spark.read.parquet(f"{root}/_rejected/envelope").count() == 2
    write_bronze(envelopes, root, run="r2")
    assert spark.read.parquet(f"{root}/sensor_sync").count() == 2
    assert tables_present(envelopes) == ["sensor_sync"]
    assert bronze_table(good, "sensor_sync").count() == 1
    assert good_rows(map_events(envelopes, registry.MAPPINGS["act"])).count() == 0


def test_feed_of_many_tables_is_read_once(spark):
    """All tables and both kinds of rejects from one computation of the feed; each table reads its own files only."""
    types = [m.event_types[0] for m in registry.MAPPINGS.values()]
    rows = [record(t, {}) for t in types for _ in range(3)] + [record("mystery", {}), "###"]
    calls, small = spark.sparkContext.accumulator(0), ["patient_login", "subgroup", "datalake_message", "act"]

    def run(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    feed = spark.createDataFrame([(r,) for r in rows], "data string").mapInArrow(run, "data string")
    with by_table(decode_envelopes(feed)) as parts:
        assert calls.value == len(rows)
        assert sorted(parts) == sorted([*registry.MAPPINGS, "_rejected"])
        assert all(f"_bronze_table={name}/" in f for name, own in parts.items() for f in own.inputFiles())
        for name in small:
            plan = map_events(parts[name], registry.MAPPINGS[name])._jdf.queryExecution().executedPlan().toString()
            assert "unbase64" not in plan and "parse_json" not in plan and parts[name].count() == 3
        assert parts["_rejected"].count() == 2
    root = scratch_dir(spark, "bronze")
    write_bronze(decode_envelopes(feed), root, run="r1", tables=small)
    assert calls.value == 2 * len(rows)
    good = {n: spark.read.parquet(f"{root}/{n}").count() for n in small[:3]}
    assert good == dict.fromkeys(small[:3], 3)
    assert [(r.bronze_table, r["count"]) for r in spark.read.parquet(f"{root}/_rejected/mapping").groupBy("bronze_table").count().collect()] == [("act", 3)]
    assert spark.read.parquet(f"{root}/_rejected/envelope").count() == 2 + 3 * (len(types) - len(small))
