"""Finds values that do not fit the type of their field, at any depth of a body.

The body is cast a second time, to the same shape with a VARIANT in place of every number and truth
value. A leaf is wrong where its typed value is null, or lost its fraction, while the VARIANT holds one;
an object or array is wrong where the body holds something else. Elements of arrays are compared in
pairs, so a field inside any nesting of arrays is found and reported by its path, as in
``type: plan.medications[].usageList[].hour``, once per array.

Every field that a mapping reads is checked, whether or not the other values of the event make it count.
Text fits no number unless the whole text is one of that type; any value fits a text field.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, functions as F

from lakeloom.functions.nested import holds_value, let
from lakeloom.mapping.spec import BODY, CUT, child_path, ddl

#: Whole numbers that must arrive whole. Of ``CUT`` fields a fraction is dropped, as their sender expects.
EXACT = ("int", "bigint")
CHECKED = (*EXACT, CUT, "double", "boolean")


def probe_shape(kind):
    """The shape of the second cast, or None where nothing is to be looked at."""
    if isinstance(kind, dict):
        shape = {name: probe_shape(k) for name, k in kind.items()}
        return {name: s for name, s in shape.items() if s is not None} or None
    if isinstance(kind, list):
        return ["variant"] if isinstance(kind[0], (dict, list)) or kind[0] in CHECKED else None
    return "variant" if kind in CHECKED else None


def probe_body(shape: dict) -> Column | None:
    probe = probe_shape(shape)
    return None if probe is None else F.try_variant_get("payload", BODY, ddl(probe))


def type_problems(name: str, kind, typed: Column, probe: Column, payload: Column) -> tuple[list[Column], list[Column]]:
    """Texts, and arrays of texts, that name what is wrong in one field of the body."""
    return _field(name, kind, typed, probe, payload, BODY, "", None)


def _field(name, kind, typed, probe, variant, path, label, parent):
    field, at = typed[name], child_path(path, name)
    own = child_path(label, name).lstrip(".")
    if not isinstance(kind, (dict, list)):
        return ([F.when(_unfit(kind, field, probe[name]), F.lit(f"type: {own}"))], []) if kind in CHECKED else ([], [])
    other = field.isNull() & holds_value(variant, at)
    texts, arrays = [F.when(other if parent is None else parent.isNotNull() & other, F.lit(f"type: {own}"))], []
    if isinstance(kind, list):
        if probe_shape(kind) is not None:
            arrays.append(_elements(kind[0], field, probe[name], f"{own}[]"))
        return texts, arrays
    inner = probe[name] if probe_shape(kind) is not None else probe
    for sub_texts, sub_arrays in _fields(kind, field, inner, variant, at, own):
        texts += sub_texts
        arrays += sub_arrays
    return texts, arrays


def _fields(shape, typed, probe, variant, path, label) -> Iterator[tuple[list[Column], list[Column]]]:
    for name, kind in shape.items():
        yield _field(name, kind, typed, probe, variant, path, label, typed)


def _unfit(kind: str, typed: Column, value: Column) -> Column:
    lost = typed.isNull() & value.isNotNull() & ~F.is_variant_null(value)
    return lost | (F.try_variant_get(value, "$", "double") != typed) if kind in EXACT else lost


def _elements(kind, typed: Column, probe: Column, label: str) -> Column:
    """What is wrong in the elements of an array, each text once."""
    wrong = F.lit(f"type: {label}")

    def scalar(item: Column, value: Column) -> Column:
        return F.array_compact(F.array(F.when(_unfit(kind, item, value), wrong)))

    def nested(item: Column, value: Column) -> Column:
        def use(sub: Column) -> Column:
            texts, arrays = [F.when(item.isNull() & value.isNotNull() & ~F.is_variant_null(value), wrong)], []
            for own_texts, own_arrays in _fields(kind, item, sub, value, "$", label):
                texts += own_texts
                arrays += own_arrays
            return F.concat(F.array_compact(F.array(*texts)), *arrays)

        shape = probe_shape(kind)
        return use(value) if shape is None else let(F.try_variant_get(value, "$", ddl(shape)), use)

    found = F.flatten(F.zip_with(typed, probe, nested if isinstance(kind, dict) else scalar))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))
