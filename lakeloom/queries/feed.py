"""Event envelopes made of the rows of ``events``, and the same source values in SQL.

A body is a nested dict of SQL expressions that read the same in both engines. An
expression that gives null becomes a missing key in odd rows and a JSON null in even
rows, so every rule for absent values is exercised. Text between ``@@`` marks stands
for JSON as it is, backticks for its quotes: values that are not of one type.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.texts import encode_base64
from lakeloom.functions.times import iso_ms
from lakeloom.queries.base import Tables
from lakeloom.session import spread
from lakeloom.sources.envelopes import decode_envelopes

EXPLICIT = "event_id % 2 = 0"


@dataclass(frozen=True)
class Obj:
    """A nested object, there only where ``when`` holds."""

    fields: dict
    when: str = "true"


@dataclass(frozen=True)
class Arr:
    """An array of objects or expressions; element ``i`` is there where ``when[i]`` holds.

    Where no element is, the array is absent in every fourth row and empty otherwise.
    """

    items: list
    when: list[str]


def sometimes(n: int, expr: str) -> str:
    """The expression in three of four rows."""
    return f"CASE WHEN (event_id + {n}) % 4 <> 0 THEN {expr} END"


ABSENT = "event_id % 4 = 1"


def _value(node) -> Column:
    if isinstance(node, Obj):
        return F.when(F.expr(node.when), F.struct(*[_value(v).alias(k) for k, v in node.fields.items()]))
    if isinstance(node, Arr):
        there = [F.expr(f"coalesce({when}, false)") for when in node.when]
        # lambdas would have all that is in the elements interpreted
        kept = F.concat(*[F.when(own, F.array(_element(item))).otherwise(F.array()) for own, item in zip(there, node.items)])
        return F.when(reduce(Column.__or__, there) | ~F.expr(ABSENT), kept)
    return F.expr(node)


def _element(item) -> Column:
    return _value(Obj(item) if isinstance(item, dict) else item)


def body_json(body: dict) -> Column:
    fields = F.struct(*[_value(v).alias(k) for k, v in body.items()])
    text = F.when(F.expr(EXPLICIT), F.to_json(fields, {"ignoreNullFields": "false"})).otherwise(F.to_json(fields))
    for mark, plain in (('"@@', ""), ('@@"', ""), ("`", '"')):  # by bytes: a pattern looks at every character of a long text
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


CALL_TIMES = "CASE event_id % 3 WHEN 0 THEN date_trunc('milliseconds', ts) WHEN 1 THEN date_trunc('milliseconds', ts) ELSE date_trunc('second', ts) END"


def call_time_json() -> Column:
    iso = F.concat(F.lit('"'), iso_ms(F.col("ts")), F.lit('"'))
    seconds = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('"'))
    form = F.col("event_id") % 3
    return F.when(form == 0, iso).when(form == 1, F.unix_millis("ts").cast("string")).otherwise(seconds)


def pick(names) -> Column:
    """One of the names, by event id."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % len(names) + 1).cast("int"))


def pick_sql(names) -> str:
    return f"[{', '.join(repr(n) for n in names)}][event_id % {len(names)} + 1]"


DEFAULT_ARGS = """concat('["a', event_id % 5, '",null,7]')"""


def envelope_json(event_type: Column, body: Column, args: str = DEFAULT_ARGS, call_time: Column | None = None) -> Column:
    return F.concat(
        F.lit('{"userId":"u'), F.col("user_id"),
        F.lit('","groupId":"g'), F.col("user_id") % 7,
        F.lit('","callTime":'), call_time_json() if call_time is None else call_time,
        F.lit(',"pubSubEvent":"'), event_type,
        F.lit('","pubSubEventId":"p'), F.col("event_id"),
        F.lit('","version":"1","pubSubArgs":'), F.expr(args),
        F.lit(',"body":'), body, F.lit("}"),
    )


def records(t: Tables, event_types, body: dict, args: str = DEFAULT_ARGS) -> DataFrame:
    """``event_id`` and base64 ``data`` of one envelope per event."""
    return spread(t.events, "event_id").select("event_id", encode_base64(envelope_json(pick(event_types), body_json(body), args)).alias("data"))


def envelopes(t: Tables, event_types, body: dict, args: str = DEFAULT_ARGS) -> DataFrame:
    return decode_envelopes(records(t, event_types, body, args))


# The same values in SQL: one column per leaf, named by its path.


def leaves(node, path: str = "", guard: str = "true") -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    if isinstance(node, dict):
        for key, value in node.items():
            out += leaves(value, f"{path}.{key}" if path else key, guard)
    elif isinstance(node, Obj):
        both = node.when if guard == "true" else f"({guard}) AND ({node.when})"
        out.append((path, f"coalesce({both}, false)"))
        out += leaves(node.fields, path, both)
    elif isinstance(node, Arr):
        for i, (item, when) in enumerate(zip(node.items, node.when)):
            both = when if guard == "true" else f"({guard}) AND ({when})"
            out.append((f"{path}.{i}", f"coalesce({both}, false)"))
            out += leaves(item, f"{path}.{i}" if isinstance(item, dict) else f"{path}.{i}.value", both)
    else:
        out.append((path, node if guard == "true" else f"CASE WHEN {guard} THEN {node} END"))
    return out


def source_sql(event_types, body: dict) -> str:
    columns = ",\n".join(f'{expr} AS "{path}"' for path, expr in leaves(body))
    call = f"({CALL_TIMES})"
    return f"""(SELECT event_id, event_id % 2 = 0 AS x, 'u' || user_id AS user_id, 'g' || (user_id % 7) AS group_id,
        strftime({call}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS call_time, 'p' || event_id AS pub_sub_event_id,
        CAST(year(ts) AS INTEGER) AS date_year, CAST(month(ts) AS INTEGER) AS date_month,
        {pick_sql(list(event_types))} AS event_type, user_id AS user_number{',' if columns else ''}
        {columns} FROM events)"""


ENVELOPE_SQL = "user_id, group_id, call_time, pub_sub_event_id, date_year, date_month"
