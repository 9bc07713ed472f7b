"""Field specifications and their compilation to columns.

A mapping is a tree of fields. The leaves name a path in the event body, a type
and a rule for absent values; the body is cast once to the struct type the
tree implies, and every output column is an expression over that struct. Only
presence tests that must tell a missing key from a JSON null go back to the VARIANT.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, functions as F

from lakeloom.functions.nested import has_key, holds_value, some_lack

# What stands for an absent value, per type.
SENTINELS = {
    "string": "-1",
    "int": -1,
    "cut": -1,
    "bigint": -1,
    "double": -1.0,
    "boolean": False,
    "datetime": "1970-01-01T00:00:00.000Z",
}

REQUIRED = "required"  # a missing key is an error, a JSON null is kept
NOT_NULL = "not_null"  # a missing key or a JSON null is an error
IF_MISSING = "if_missing"  # default for a missing key only
IF_NULL = "if_null"  # default for a missing key and for a JSON null
OPTIONAL = "optional"  # null when absent


BODY = "$.body"  # where the fields of an event lie in its payload
CUT = "cut"  # a whole number that drops the fraction of a number, as its sender expects


def sql_type(kind: str) -> str:
    return {"datetime": "string", CUT: "int"}.get(kind, kind)


def read_type(kind: str) -> str:
    """How a kind is known in the shape of a body: dates are text, fractions may be cut."""
    return "string" if kind == "datetime" else kind


@dataclass(frozen=True)
class Scope:
    """Where a field is compiled: the typed struct, and the VARIANT path if there is one."""

    typed: Column
    variant: Column | None
    path: str = BODY

    def down(self, name: str) -> "Scope":
        return Scope(self.typed[name], self.variant, child_path(self.path, name))

    def has_key(self, name: str) -> Column:
        return has_key(self.variant, child_path(self.path, name))

    def holds(self, name: str) -> Column:
        return holds_value(self.variant, child_path(self.path, name))


def child_path(path: str, name: str) -> str:
    return f"{path}.{name}" if name.replace("_", "a").isalnum() else f"{path}['{name}']"


def label_of(scope: Scope, name: str) -> str:
    """Path of a field below the body, for error texts."""
    return child_path(scope.path, name)[len(BODY) + 1 :]


@dataclass(frozen=True)
class Leaf:
    """One scalar. ``sources`` are tried in order; the first one holding a value wins."""

    name: str
    sources: tuple[str, ...]
    kind: str = "string"
    rule: str = REQUIRED
    default: object = None
    flag: bool = False

    def types(self) -> dict:
        return {s: read_type(self.kind) for s in self.sources}

    def columns(self, scope: Scope) -> list[tuple[str, Column]]:
        value = F.coalesce(*[scope.typed[s] for s in self.sources]) if len(self.sources) > 1 else scope.typed[self.sources[0]]
        out = []
        if self.flag:
            out.append((f"has_{self.name}", value.isNotNull()))
        if self.rule == IF_NULL:
            value = F.coalesce(value, self.fallback())
        elif self.rule == IF_MISSING:
            value = F.when(value.isNull() & ~scope.has_key(self.sources[0]), self.fallback()).otherwise(value)
        return out + [(self.name, value)]

    def fallback(self) -> Column:
        default = SENTINELS[self.kind] if self.default is None else self.default
        return F.lit(default).cast(sql_type(self.kind))

    def errors(self, scope: Scope) -> list[Column]:
        """What is absent; wrong types are found for whole bodies (``typecheck``)."""
        if scope.variant is None:
            if self.rule in (REQUIRED, NOT_NULL):
                return [F.when(scope.typed[self.sources[0]].isNull(), F.lit(f"missing: {self.name}"))]
            return []
        out = []
        absent = scope.typed[self.sources[0]].isNull()
        label = label_of(scope, self.sources[0])
        if self.rule == REQUIRED:
            out.append(F.when(absent & ~scope.has_key(self.sources[0]), F.lit(f"missing: {label}")))
        elif self.rule == NOT_NULL:
            out.append(F.when(absent & ~scope.holds(self.sources[0]), F.lit(f"missing: {label}")))
        return out


@dataclass(frozen=True)
class Group:
    """A nested object. ``shape`` says how it appears in the output.

    ``struct``: a struct that is null when the object is absent;
    ``filled``: a struct always present, its fields falling back to their defaults;
    ``inline``: the fields become siblings of the group.
    """

    name: str
    source: str
    fields: tuple
    shape: str = "struct"
    rule: str = OPTIONAL
    flag: bool = False
    needs: str | None = None

    def types(self) -> dict:
        return {self.source: merged_types(self.fields)}

    def columns(self, scope: Scope) -> list[tuple[str, Column]]:
        inner = scope.down(self.source)
        present = scope.typed[self.source].isNotNull()
        parts = [c for f in self.fields for c in f.columns(inner)]
        flag = [(f"has_{self.name}", present)] if self.flag else []
        if self.shape == "inline":
            return flag + parts
        value = F.struct(*[c.alias(n) for n, c in parts])
        if self.shape == "struct":
            value = F.when(present if self.needs is None else present & inner.typed[self.needs].isNotNull(), value)
        return flag + [(self.name, value)]

    def errors(self, scope: Scope) -> list[Column]:
        inner = scope.down(self.source)
        present = scope.typed[self.source].isNotNull()
        inside = [e for f in self.fields for e in f.errors(inner)]
        if self.rule in (REQUIRED, NOT_NULL):
            return inside
        return [F.when(present, e) for e in inside]


@dataclass(frozen=True)
class Listing:
    """An array of objects (``fields``) or scalars (``kind``).

    ``empty``: ``null`` leaves the column out when there is nothing, ``default`` puts
    one element made of defaults, ``empty`` keeps an empty array.
    """

    name: str
    sources: tuple[str, ...]
    fields: tuple = ()
    kind: str = "string"
    empty: str = "null"
    flag: bool = False
    rule: str = OPTIONAL

    def types(self) -> dict:
        element = merged_types(self.fields) if self.fields else read_type(self.kind)
        return {s: [element] for s in self.sources}

    def items(self, scope: Scope) -> Column:
        candidates = [F.when(F.size(scope.typed[s]) > 0, scope.typed[s]) for s in self.sources]
        return F.coalesce(*candidates) if len(candidates) > 1 else candidates[0]

    def element(self, item: Column) -> Column:
        return F.struct(*[c.alias(n) for f in self.fields for n, c in f.columns(Scope(item, None))])

    def columns(self, scope: Scope) -> list[tuple[str, Column]]:
        items = self.items(scope)
        value = F.transform(items, self.element) if self.fields else items
        out = [(f"has_{self.name}", items.isNotNull())] if self.flag else []
        if self.empty == "default":
            blank = self.blank()
            value = F.coalesce(value, F.array(blank))
        elif self.empty == "empty":
            value = F.coalesce(value, F.slice(F.array(self.blank()), 1, 0))
        return out + [(self.name, value)]

    def blank(self) -> Column:
        if not self.fields:
            return F.lit(SENTINELS[self.kind]).cast(sql_type(self.kind))
        nothing = F.lit(None).cast(ddl(merged_types(self.fields)))
        parts = []
        for f in self.fields:
            for n, c in with_defaults(f).columns(Scope(nothing, None)):
                parts.append(c.alias(n))
        return F.struct(*parts)

    def errors(self, scope: Scope) -> list[Column]:
        out = []
        if self.rule in (REQUIRED, NOT_NULL):
            missing = ~scope.has_key(self.sources[0])
            out.append(F.when(missing, F.lit(f"missing: {label_of(scope, self.sources[0])}")))
        keys = [f.sources[0] for f in self.fields if f.rule in (REQUIRED, NOT_NULL)]
        if keys:

            def suspect(item: Column) -> Column:
                null = item[keys[0]].isNull()
                for key in keys[1:]:
                    null = null | item[key].isNull()
                return null

            # the typed elements tell cheaply that nothing is missing; the VARIANT
            # is asked only about elements with a null
            earlier = F.lit(True)
            for source in self.sources:
                typed = scope.typed[source]
                used = earlier & F.exists(typed, suspect)
                lacking = used & some_lack(scope.variant, child_path(scope.path, source), *keys)
                out.append(F.when(lacking, F.lit(f"missing: {source}[]")))
                earlier = earlier & (F.coalesce(F.size(typed), F.lit(0)) < 1)
        return out


@dataclass(frozen=True)
class Derived:
    """A column computed from the typed body; ``reads`` declares the struct it needs."""

    name: str
    reads: dict
    build: Callable[["Body"], Column]
    check: Callable[["Body"], Column] | None = None
    rule: str = OPTIONAL

    def types(self) -> dict:
        return self.reads

    def columns(self, scope: Scope) -> list[tuple[str, Column]]:
        return [(self.name, self.build(Body(scope.typed, scope.variant)))]

    def errors(self, scope: Scope) -> list[Column]:
        return [] if self.check is None else [self.check(Body(scope.typed, scope.variant))]


@dataclass(frozen=True)
class Body:
    """What a derived column may use: the typed body, the payload, and the envelope columns.

    ``variant`` is the whole payload: the body's fields are at ``$.body.<name>``.
    """

    typed: Column
    variant: Column | None

    def __getitem__(self, name: str) -> Column:
        return self.typed[name]

    @property
    def args(self) -> Column:
        return F.col("args")

    @property
    def event_type(self) -> Column:
        return F.col("event_type")

    @property
    def call_time(self) -> Column:
        return F.col("call_time")


@dataclass(frozen=True)
class Mapping:
    """A bronze table: the event types that feed it and its fields."""

    name: str
    event_types: tuple[str, ...]
    fields: tuple = ()
    group_id_from_body: bool = False
    keeps_args: bool = False

    def shape(self) -> dict:
        return merged_types(self.fields)

    def body_type(self) -> str:
        return ddl(self.shape())


def merged_types(fields) -> dict:
    """Struct shape needed by a list of fields, nested shapes merged."""
    out: dict = {}
    for f in fields:
        _merge(out, f.types())
    return out


def _merge(into: dict, extra: dict) -> None:
    for key, kind in extra.items():
        if isinstance(kind, dict) and isinstance(into.get(key), dict):
            _merge(into[key], kind)
        elif isinstance(kind, list) and isinstance(into.get(key), list) and isinstance(kind[0], dict):
            merged = dict(into[key][0])
            _merge(merged, kind[0])
            into[key] = [merged]
        elif isinstance(kind, dict):
            into[key] = {}
            _merge(into[key], kind)
        else:
            into[key] = kind


def ddl(kind) -> str:
    if isinstance(kind, dict):
        return "struct<" + ",".join(f"`{k}`:{ddl(v)}" for k, v in kind.items()) + ">"
    if isinstance(kind, list):
        return f"array<{ddl(kind[0])}>"
    return sql_type(kind)


def with_defaults(f):
    """The same field, falling back to its default wherever nothing is there."""
    if isinstance(f, Leaf):
        return replace(f, rule=IF_NULL)
    if isinstance(f, Group):
        return replace(f, fields=tuple(with_defaults(x) for x in f.fields))
    return f


# Short constructors, so that a specification reads like a field list.


def _sources(name: str, source) -> tuple[str, ...]:
    if source is None:
        return (camel(name),)
    return (source,) if isinstance(source, str) else tuple(source)


def camel(name: str) -> str:
    """Body key of a column that keeps its name: ``given_name`` -> ``givenName``."""
    head, *tail = name.split("_")
    return head + "".join(part.capitalize() for part in tail)


def required(name, source=None, kind="string") -> Leaf:
    return Leaf(name, _sources(name, source), kind, REQUIRED)


def not_null(name, source=None, kind="string") -> Leaf:
    return Leaf(name, _sources(name, source), kind, NOT_NULL)


def optional(name, source=None, kind="string") -> Leaf:
    return Leaf(name, _sources(name, source), kind, OPTIONAL)


def if_missing(name, source=None, kind="string", default=None) -> Leaf:
    return Leaf(name, _sources(name, source), kind, IF_MISSING, default)


def if_null(name, source=None, kind="string", default=None) -> Leaf:
    return Leaf(name, _sources(name, source), kind, IF_NULL, default)


def flagged(name, source=None, kind="string", default=None) -> Leaf:
    return Leaf(name, _sources(name, source), kind, IF_NULL, default, flag=True)


def group(name, fields, source=None, **options) -> Group:
    return Group(name, source or camel(name), tuple(fields), **options)


def listing(name, source=None, fields=(), **options) -> Listing:
    return Listing(name, _sources(name, source), tuple(fields), **options)
