"""Hour spines: the hours an entity is followed, as spans and as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.functions.times import SPINE_FLOOR, Period, clamp, hour_of, ts_literal
from lakeloom.session import spread

HOUR = "INTERVAL 1 HOUR"


def hour_spans(
    entities: DataFrame,
    keys: list[str],
    *,
    start: Column,
    end: Column | None,
    now: Column,
    period: Period,
    carry: list[str] = (),
) -> DataFrame:
    """First and last hour of every entity inside the period, as disjoint spans.

    The start is not before 2010 nor before the period, the end is the given one or
    ``now``, not after the period. Spans without any hour vanish. Spans of the same
    key are cut so that no hour appears twice.
    """
    begin = hour_of(period.begin_col())
    first = F.greatest(clamp(hour_of(start), low=ts_literal(SPINE_FLOOR)), begin)
    first = F.when(start.isNotNull(), first)
    last = F.least(F.coalesce(hour_of(end), hour_of(now)) if end is not None else hour_of(now), hour_of(period.end_col()))
    spans = entities.select(*keys, *carry, first.alias("first_hour"), last.alias("last_hour"))
    return disjoint_spans(spans.filter(F.col("first_hour") <= F.col("last_hour")), keys, carry)


def disjoint_spans(spans: DataFrame, keys: list[str], carry: list[str] = ()) -> DataFrame:
    """Cut overlapping spans of a key: the earlier start keeps the shared hours.

    Spans that start in the same hour are reduced to the longest one first, so a key
    has at most one row per hour of the period, whatever the number of its copies.
    The result is spread by the first key, ready to be expanded to hours.
    """
    longest = spans.groupBy(*keys, "first_hour").agg(
        F.max(F.struct("last_hour", *carry)).alias("longest")
    )
    longest = spread(longest, keys[0])
    before = Window.partitionBy(*keys).orderBy("first_hour").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.max(F.col("longest.last_hour")).over(before)
    from_hour = F.coalesce(F.greatest(F.col("first_hour"), covered + F.expr(HOUR)), F.col("first_hour"))
    cut = longest.select(
        *keys,
        *[F.col("longest")[c].alias(c) for c in carry],
        from_hour.alias("first_hour"),
        F.col("longest.last_hour").alias("last_hour"),
    )
    return cut.filter(F.col("first_hour") <= F.col("last_hour"))


def hours_between(first: Column, last: Column) -> Column:
    """Array of hours from first to last, both included; empty if there is none."""
    return F.when(first <= last, F.sequence(first, last, F.expr(HOUR))).otherwise(F.array().cast("array<timestamp>"))


def hour_spine(spans: DataFrame, *, into: str = "hour") -> DataFrame:
    """One row per hour of every span. A map-side step: nothing is shuffled."""
    kept = [c for c in spans.columns if c not in ("first_hour", "last_hour")]
    return spans.select(*kept, F.explode(hours_between(F.col("first_hour"), F.col("last_hour"))).alias(into))


def day_spans(spans: DataFrame, *, into: str = "day") -> DataFrame:
    """Spans cut at the borders of days, each with the begin of its day. A map-side step."""
    first, last = F.date_trunc("day", "first_hour"), F.date_trunc("day", "last_hour")
    days = F.when(F.col("first_hour") <= F.col("last_hour"), F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    cut = spans.withColumn(into, F.explode(days))
    return cut.withColumns(
        {
            "first_hour": F.greatest("first_hour", into),
            "last_hour": F.least("last_hour", F.col(into) + F.expr("INTERVAL 23 HOURS")),
        }
    )
