"""Matching people by name: exact, within an edit distance, and the decision made of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.texts import deletions


def name_join(left: DataFrame, right: DataFrame, names: list[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join on names at edit distance 0, which is equality: an ordinary equi-join.

    Null names match nothing; ``how="left_anti"`` gives the unmatched rows.
    """
    return left.join(right, [left[a] == right[b] for a, b in names], how)


def matched_flag(left: DataFrame, right: DataFrame, names: list[tuple[str, str]], *, into: str = "matched") -> DataFrame:
    """Matched and unmatched rows in one left join, told apart by a flag."""
    tagged = right.withColumn("_there", F.lit(True))
    joined = left.join(tagged, [left[a] == tagged[b] for a, b in names], "left")
    return joined.withColumn(into, F.col("_there").isNotNull()).drop("_there")


def close_names(left: DataFrame, right: DataFrame, name: tuple[str, str], *, distance: int, block: list[tuple[str, str]] = ()) -> DataFrame:
    """Pairs of distinct names at most ``distance`` edits apart, with equal block columns.

    Names within that distance share a text left after deleting so many characters,
    so candidates come from an equi-join on these texts and are verified afterwards.
    Only distinct names take part, so frequent names cost nothing extra.
    """
    a, b = name
    left_names = left.select(*[x for x, _ in block], a).filter(F.col(a).isNotNull()).distinct()
    right_names = right.select(*[y for _, y in block], b).filter(F.col(b).isNotNull()).distinct()
    lx = left_names.select("*", F.explode(deletions(F.col(a), distance)).alias("_part")).alias("l")
    rx = right_names.select("*", F.explode(deletions(F.col(b), distance)).alias("_part")).alias("r")
    same = [F.col("l._part") == F.col("r._part")] + [F.col(f"l.{x}") == F.col(f"r.{y}") for x, y in block]
    found = (
        lx.join(rx, same)
        .select(*[F.col(f"l.{x}") for x, _ in block], F.col(f"l.{a}"), F.col(f"r.{b}").alias("_other"))
        .distinct()
    )
    apart = F.levenshtein(F.col(a), F.col("_other"))
    return found.withColumn("distance", apart).filter(F.col("distance") <= distance)


def name_join_within(left: DataFrame, right: DataFrame, name: tuple[str, str], *, distance: int, block: list[tuple[str, str]] = ()) -> DataFrame:
    """Rows of both sides whose names are at most ``distance`` edits apart."""
    a, b = name
    pairs = close_names(left, right, name, distance=distance, block=block).alias("m")
    l, r = left.alias("l"), right.alias("r")
    first = l.join(pairs, [F.col(f"l.{a}") == F.col(f"m.{a}")] + [F.col(f"l.{x}") == F.col(f"m.{x}") for x, _ in block])
    first = first.select("l.*", F.col("m._other"), F.col("m.distance")).alias("l")
    both = first.join(r, [F.col("l._other") == F.col(f"r.{b}")] + [F.col(f"l.{x}") == F.col(f"r.{y}") for x, y in block])
    taken = [c for c in right.columns if c not in left.columns]
    return both.select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in taken], "distance")


def match_decision(born: Column, user_born: Column, user_promo: Column, allowed: list[str], value: Column) -> Column:
    """The user's value if both birth dates agree and the promotion is allowed, else null."""
    return F.when((born == user_born) & user_promo.isin(list(allowed)), value)
