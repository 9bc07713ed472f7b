"""Values of a wrong type are found in every field, whatever the nesting."""

import pytest

from lakeloom.mapping import registry
from lakeloom.mapping.spec import Mapping, group, listing, optional
from lakeloom.queries.type_errors import FIELDS, checked_fields
from tests.test_mappings import run


def leaves(kind, path=""):
    if isinstance(kind, dict):
        for name, inner in kind.items():
            yield from leaves(inner, f"{path}.{name}" if path else name)
    elif isinstance(kind, list):
        yield from leaves(kind[0], f"{path}[]")
    elif kind not in ("string", "datetime", "variant"):
        yield path, {"int": "whole", "bigint": "whole", "cut": "cut", "double": "number", "boolean": "truth"}[kind]


def test_query_covers_every_field():
    found = {name: sorted(leaves(m.shape())) for name, m in registry.MAPPINGS.items()}
    assert {n: f for n, f in found.items() if f} == {n: checked_fields(n) for n in FIELDS}


DEEP = Mapping(
    "deep",
    ("deep_created",),
    (
        optional("n", kind="int"),
        optional("big", kind="bigint"),
        optional("c", kind="cut"),
        optional("d", kind="double"),
        optional("b", kind="boolean"),
        optional("s"),
        group("g", [optional("n", kind="int"), group("h", [optional("m", kind="int")], source="h")], source="g"),
        listing("xs", "xs", kind="int"),
        listing("names", "names"),
        listing("os", "os", fields=[optional("n", kind="int"), optional("t")]),
    ),
)


@pytest.mark.parametrize(
    "body, errors",
    [
        ({}, []),
        ({"n": 7, "big": 1 << 62, "c": 7.9, "d": 7, "b": True, "s": {"any": 1}}, []),
        ({"n": "7", "big": "7", "c": "7", "d": "7.5", "b": "true"}, []),
        ({"n": None, "big": None, "c": None, "d": None, "b": None, "g": None, "xs": None, "os": None}, []),
        ({"n": 20.7}, ["type: n"]),
        ({"n": 20.0, "c": -0.5}, []),
        ({"n": 3_000_000_000}, ["type: n"]),
        ({"big": 0.5, "c": "7.5", "d": "x", "b": "maybe"}, ["type: big", "type: c", "type: d", "type: b"]),
        ({"d": [1], "b": {}}, ["type: d", "type: b"]),
        ({"g": "text"}, ["type: g"]),
        ({"g": {"n": 1.5, "h": {"m": "x"}}}, ["type: g.n", "type: g.h.m"]),
        ({"g": {"h": [1]}}, ["type: g.h"]),
        ({"xs": 7}, ["type: xs"]),
        ({"xs": [1, 2.5, "x", None, "3"]}, ["type: xs[]"]),
        ({"names": "one"}, ["type: names"]),
        ({"os": [{"n": 1}, None, {"n": 0.5}, {"n": "x"}, "text"]}, ["type: os[].n", "type: os[]"]),
        ({"os": {"n": 1}}, ["type: os"]),
    ],
)
def test_errors_name_the_path(spark, body, errors):
    assert run(spark, DEEP, body)[0]["_errors"] == errors


def test_nested_arrays(spark):
    use = {"hour": 8, "minute": 0}
    plan = {"medications": [{"medication": {"id": "m"}, "usageList": [use, use | {"doses": 1.5}, use | {"hour": "noon"}], "sensors": [{"mac": "x", "battery": 0.5, "silent": "maybe"}]}, {"medication": {"id": "n"}, "usageList": "daily"}]}
    body = {"role": "patient", "createdDate": "2020-01-02", "plan": plan}
    assert sorted(run(spark, registry.MAPPINGS["patient"], body)[0]["_errors"]) == [
        "type: plan.medications[].sensors[].battery", "type: plan.medications[].sensors[].silent", "type: plan.medications[].usageList",
        "type: plan.medications[].usageList[].doses", "type: plan.medications[].usageList[].hour",
    ]


def test_fractions_are_kept_or_cut_as_the_sender_expects(spark):
    act, = run(spark, registry.MAPPINGS["act"], {"score": 20.7, "ans": [], "dateR": "r", "dateS": "s", "type": "t"})
    assert act["score"] == 20.7 and act["_errors"] == []
    alert = {"_id": "i", "deleted": False, "acknowledged": False, "dateC": "d", "userRole": "r", "userDeleted": False}
    cut, = run(spark, registry.MAPPINGS["alert"], alert | {"dayUses": 3.9})
    assert cut["day_uses"] == 3 and cut["_errors"] == []
