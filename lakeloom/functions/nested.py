"""Array, map and VARIANT expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def compute_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that many later expressions use, evaluated once per row.

    A plain column would be copied into every later filter that the optimizer moves
    below it, and parsed again for each use. Filters do not move below a generator.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def has_key(value: Column, path: str) -> Column:
    """True if the path exists, even when it holds a JSON null."""
    return F.try_variant_get(value, path, "variant").isNotNull()


def holds_value(value: Column, path: str) -> Column:
    """True if the path exists and is not a JSON null."""
    return F.try_variant_get(value, path, "string").isNotNull()


def objects(value: Column, path: str) -> Column:
    """The array at a path as VARIANT elements."""
    return F.try_variant_get(value, path, "array<variant>")


def lacks_any(value: Column, *keys: str) -> Column:
    """True if one of the keys is missing from an object; a JSON null counts as there."""
    missing = ~has_key(value, f"$.{keys[0]}")
    for key in keys[1:]:
        missing = missing | ~has_key(value, f"$.{key}")
    return missing


def some_lack(value: Column, path: str, *keys: str) -> Column:
    """True if an object of the array at a path misses one of the keys."""
    return F.coalesce(F.exists(objects(value, path), lambda item: lacks_any(item, *keys)), F.lit(False))


def first_of(value: Column, target: str, *paths: str) -> Column:
    """Typed value at the first path that holds one (renamed fields of older senders)."""
    return F.coalesce(*[F.try_variant_get(value, path, target) for path in paths])


def non_empty(items: Column) -> Column:
    """The array, or null if it is null or empty."""
    return F.when(F.size(items) > 0, items)


def truthy(items: Column) -> Column:
    """Array of strings without nulls and empty strings."""
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def remove_first(items: Column, texts: Column, value: str) -> Column:
    """Array without the first element whose text equals ``value``.

    ``texts`` is the text form of ``items``, position by position.
    """
    at = F.array_position(texts, F.lit(value)).cast("int")
    size = F.size(items)
    return F.when(at > 0, F.concat(F.slice(items, F.lit(1), at - 1), F.slice(items, at + 1, size - at))).otherwise(
        items
    )


def flatten_map(parents: Column, children) -> Column:
    """Array of all children over an array of parents; null child arrays count as empty."""
    return F.flatten(F.filter(F.transform(parents, children), lambda a: a.isNotNull()))


def lon_lat(coordinates: Column) -> tuple[Column, Column]:
    """(latitude, longitude) of a GeoJSON ``[lon, lat]`` pair."""
    return F.get(coordinates, F.lit(1)), F.get(coordinates, F.lit(0))


def string_map(value: Column, path: str) -> Column:
    """Free object as a string -> string map; empty if absent or not an object."""
    return F.coalesce(
        F.try_variant_get(value, path, "map<string,string>"),
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")),
    )
