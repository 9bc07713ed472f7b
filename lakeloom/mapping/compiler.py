"""From a mapping to the select that builds its bronze table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.nested import compute_once, has_key
from lakeloom.functions.times import iso_ms
from lakeloom.mapping.spec import BODY, Mapping, Scope
from lakeloom.mapping.typecheck import probe_body, type_problems

ENVELOPE_OUTPUT = ["user_id", "group_id", "call_time", "pub_sub_event_id", "date_year", "date_month"]


def map_events(envelopes: DataFrame, mapping: Mapping, *, keep=()) -> DataFrame:
    """One row per envelope of the mapping's event types, plus an ``_errors`` array.

    Rows with a non-empty ``_errors`` are for quarantine: their columns hold what
    could be read. ``keep`` names further columns, ``event_type`` among them.
    """
    typed = envelopes.filter(F.col("event_type").isin(list(mapping.event_types))).select(
        *(k for k in keep if k != "event_type"),
        "user_id",
        "group_id",
        iso_ms(F.col("call_ts")).alias("call_time"),
        F.col("call_ts"),
        "event_type",
        "pub_sub_event_id",
        "args",
        "payload",
        "envelope_errors",
    )
    if mapping.fields:
        typed = compute_once(typed, "typed", typed_body(mapping))
        probe = probe_body(mapping.shape())
        if probe is not None:
            typed = compute_once(typed, "probe", probe)
    fields, errors, group_id = compiled(mapping)
    return typed.select(
        *keep,
        "user_id",
        group_id,
        "call_time",
        "pub_sub_event_id",
        F.year("call_ts").alias("date_year"),
        F.month("call_ts").alias("date_month"),
        *([F.col("args").alias("pub_sub_args")] if mapping.keeps_args else []),
        *fields,
        errors,
    )


_COMPILED: dict[str, tuple[Mapping, list[Column], Column, Column]] = {}


def compiled(mapping: Mapping) -> tuple[list[Column], Column, Column]:
    """Field columns, error column and group id column of a mapping.

    The columns are unresolved expressions, so they are built once per mapping and
    reused by every job of the process: large mappings hold thousands of them.
    """
    known = _COMPILED.get(mapping.name)
    if known is None or known[0] is not mapping:
        known = _COMPILED[mapping.name] = (mapping, *_compile(mapping))
    return known[1:]


def _compile(mapping: Mapping) -> tuple[list[Column], Column, Column]:
    scope = Scope(F.col("typed"), F.col("payload"))
    fields = [column.alias(name) for f in mapping.fields for name, column in f.columns(scope)]
    problems, lists = _problems(mapping, scope)
    group_id = F.col("group_id")
    if mapping.group_id_from_body:
        group_id = F.try_variant_get("payload", f"{BODY}.id", "string")
        problems.append(F.when(~has_key(F.col("payload"), f"{BODY}.id"), F.lit("missing: id")))
    errors = F.col("envelope_errors")
    if problems:
        errors = F.concat(errors, F.array_compact(F.array(*problems)), *lists)
    return fields, errors.alias("_errors"), group_id.alias("group_id")


def _problems(mapping: Mapping, scope: Scope) -> tuple[list[Column], list[Column]]:
    """Texts of what is absent or of a wrong type, field by field, and arrays of such texts."""
    shape, seen = mapping.shape(), set()
    texts, arrays = [], []
    for f in mapping.fields:
        texts += f.errors(scope)
        for source in f.types():
            if source not in seen:
                seen.add(source)
                own_texts, own_arrays = type_problems(source, shape[source], scope.typed, F.col("probe"), scope.variant)
                texts += own_texts
                arrays += own_arrays
    return texts, arrays


def typed_body(mapping: Mapping) -> Column:
    return F.try_variant_get("payload", BODY, mapping.body_type())


def good_rows(mapped: DataFrame) -> DataFrame:
    return mapped.filter(F.size("_errors") == 0).drop("_errors")


def rejected_rows(mapped: DataFrame, *, keep=()) -> DataFrame:
    """Ids and reasons only: payloads may hold personal data and are not copied."""
    return mapped.filter(F.size("_errors") > 0).select(
        *keep, "user_id", "group_id", "call_time", "pub_sub_event_id", F.col("_errors").alias("errors")
    )
