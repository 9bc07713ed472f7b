"""As-of location: for every hour of an entity the latest point of the days before.

A point counts for an hour if it is later than the start of the hour minus the
look-back and earlier than the last microsecond of the hour, both strictly. Instead
of joining hours with points, points become spans of hours:

1. per entity and first hour a point can serve, only the latest point matters,
   which leaves at most one row per entity and hour, pre-aggregated in every task;
2. each remaining point serves until the next one starts or until it is too old;
3. the spans of points and the gaps between them are matched with the spans of the
   entity, and only the result is expanded to hours.

So no row is copied per hour before the end, and the rows of one entity are bounded
by the number of hours, however many points it sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeloom.functions.times import hour_of
from lakeloom.operators.spine import HOUR, hour_spine
from lakeloom.session import spread

LOOKBACK_HOURS = 48

# Bounds that no hour of any spine passes.
EARLIEST = "0001-01-01T00:00:00Z"
LATEST = "9999-12-31T00:00:00Z"


def point_timeline(
    points: DataFrame,
    keys: list[str],
    ts: Column,
    *,
    carry: list[str],
    tie: list[str] = (),
    lookback_hours: int = LOOKBACK_HOURS,
) -> DataFrame:
    """Gapless spans of hours per key, each with the point that serves it or null.

    Columns: keys, ``from_hour``, ``to_hour``, ``point`` (struct of ``carry``). ``tie``
    decides between points of the same instant.
    """
    hour = hour_of(ts)
    last_instant = hour + F.expr("INTERVAL '59:59.999999' MINUTE TO SECOND")
    first_use = F.when(ts >= last_instant, hour + F.expr(HOUR)).otherwise(hour)
    back = F.make_dt_interval(F.lit(0), F.lit(lookback_hours))
    last_use = F.when(ts == hour, hour + back - F.expr(HOUR)).otherwise(hour + back)
    usable = points.filter(ts.isNotNull()).select(
        *keys,
        first_use.alias("from_hour"),
        F.struct(ts.alias("at"), *[F.col(c).alias(f"tie_{c}") for c in tie], last_use.alias("last_use")).alias("rank"),
        F.struct(*carry).alias("point"),
    )
    latest = usable.groupBy(*keys, "from_hour").agg(
        F.max_by("point", "rank").alias("point"), F.max(F.col("rank.last_use")).alias("last_use")
    )
    latest = spread(latest, keys[0])
    in_order = Window.partitionBy(*keys).orderBy("from_hour")
    following = F.lead("from_hour").over(in_order)
    served = latest.select(
        *keys,
        "from_hour",
        "point",
        F.least(F.col("last_use"), following - F.expr(HOUR)).alias("to_hour"),
        following.alias("next_from"),
        F.lag("from_hour").over(in_order).isNull().alias("is_first"),
    )
    nothing = F.lit(None).cast(usable.schema["point"].dataType)

    def span(start: Column, end: Column, point: Column) -> Column:
        return F.struct(start.alias("from_hour"), end.alias("to_hour"), point.alias("point"))

    gap_after = span(
        F.col("to_hour") + F.expr(HOUR),
        F.coalesce(F.col("next_from") - F.expr(HOUR), F.lit(LATEST).cast("timestamp")),
        nothing,
    )
    gap_before = span(F.lit(EARLIEST).cast("timestamp"), F.col("from_hour") - F.expr(HOUR), nothing)
    spans = F.array_compact(
        F.array(
            F.when(F.col("is_first"), gap_before),
            span(F.col("from_hour"), F.col("to_hour"), F.col("point")),
            gap_after,
        )
    )
    return (
        served.select(*keys, F.explode(spans).alias("span"))
        .select(*keys, "span.from_hour", "span.to_hour", "span.point")
        .filter(F.col("from_hour") <= F.col("to_hour"))
    )


def asof_spans(spans: DataFrame, timeline: DataFrame, on: list[str]) -> DataFrame:
    """Spans cut where the serving point changes, each with its ``point`` or null.

    ``spans`` holds ``first_hour`` and ``last_hour``; other columns are carried along.
    Whatever depends on the point is best computed here, before the spans are
    expanded to hours with :func:`lakeloom.operators.spine.hour_spine`.
    """
    kept = [c for c in spans.columns if c not in ("first_hour", "last_hour")]
    s, t = spans.alias("s"), timeline.alias("t")
    same = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in on]
    overlap = (F.col("t.from_hour") <= F.col("s.last_hour")) & (F.col("t.to_hour") >= F.col("s.first_hour"))
    first = F.greatest(F.col("s.first_hour"), F.coalesce(F.col("t.from_hour"), F.col("s.first_hour")))
    last = F.least(F.col("s.last_hour"), F.coalesce(F.col("t.to_hour"), F.col("s.last_hour")))
    return s.join(t, [*same, overlap], "left").select(
        *[F.col(f"s.{c}") for c in kept], F.col("t.point"), first.alias("first_hour"), last.alias("last_hour")
    )


def asof_hours(spans: DataFrame, timeline: DataFrame, on: list[str], *, into: str = "hour") -> DataFrame:
    """One row per hour of every span, with the ``point`` that serves the hour or null."""
    return hour_spine(asof_spans(spans, timeline, on), into=into)
