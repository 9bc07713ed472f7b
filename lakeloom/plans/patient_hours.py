"""Hourly location and environment of every patient, for one month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.times import Period, iso_ms, parse_any_ts
from lakeloom.operators.asof import LOOKBACK_HOURS, asof_spans, point_timeline
from lakeloom.operators.conform import flatten_structs
from lakeloom.operators.environment import MEASURES, day_environment, environmental_hours
from lakeloom.operators.spine import day_spans, hour_spans, hour_spine
from lakeloom.sinks.tables import stale_partitions, write_partitions
from lakeloom.sources.tables import read_month, read_months

KEYS = ["user_id", "group_id"]
PARTITIONS = ["group_id", "date_year", "date_month"]
LOCATION = ["latitude", "longitude", "precision", "address", "place", "weather_coordinate"]

# How the location of an hour was found.
RECENT = "last_48_hours"
FALLBACK = "geo_location_first"


def located_patients(patients: DataFrame) -> DataFrame:
    """Patients with a usable first location."""
    first = F.col("geo_location_first")
    return patients.filter(
        F.col("has_geo_location_first") & first["latitude"].isNotNull() & first["longitude"].isNotNull()
    )


def patient_spans(patients: DataFrame, period: Period, now: Column) -> DataFrame:
    return hour_spans(
        located_patients(patients),
        KEYS,
        start=parse_any_ts(F.col("date_created")),
        end=parse_any_ts(F.col("date_deleted")),
        now=now,
        period=period,
        carry=["geo_location_first"],
    )


def location_timeline(points: DataFrame, *, lookback_hours: int = LOOKBACK_HOURS, tie: list[str] = ()) -> DataFrame:
    dated = points.withColumn("_ts", parse_any_ts(F.col("date")))
    return point_timeline(
        dated, ["user_id"], F.col("_ts"), carry=LOCATION, tie=list(tie), lookback_hours=lookback_hours
    )


def located_spans(spans: DataFrame, timeline: DataFrame) -> DataFrame:
    """Spans of constant location: the recent point or the fallback, flattened.

    Choosing and flattening happen once per span, not once per hour.
    """
    cut = asof_spans(spans, timeline, ["user_id"])
    recent = F.col("point").isNotNull()

    def pick(name: str) -> Column:
        return F.when(recent, F.col("point")[name]).otherwise(F.col("geo_location_first")[name]).alias(name)

    chosen = cut.select(
        *KEYS,
        "first_hour",
        "last_hour",
        *[pick(name) for name in LOCATION],
        F.when(recent, F.lit(RECENT)).otherwise(F.lit(FALLBACK)).alias("location_strategy"),
    )
    return flatten_structs(chosen)


def located_hours(spans: DataFrame, timeline: DataFrame) -> DataFrame:
    """One row per patient and hour with the location and how it was found."""
    return hour_spine(located_spans(spans, timeline))


def with_environment(spans: DataFrame, environment: DataFrame) -> DataFrame:
    """One row per hour of the spans with the measures of its weather coordinate, or nulls.

    Spans are cut at day borders and joined with the hours of a location and day as one row, so what
    is shuffled grows with days and not with hours; the expansion to hours comes last and stays in
    the tasks of the join. A location that holds many patients is as many keys as the period has
    days, and the join may split those.
    """
    daily = day_environment(environment).alias("e")
    cut = day_spans(spans).alias("s")
    joined = cut.join(daily, [F.col("s.weather_coordinate_id") == F.col("e.location_id"), F.col("s.day") == F.col("e.day")], "left")
    kept = [F.col(f"s.{c}") for c in spans.columns]
    hours = hour_spine(joined.select(*kept, "e.hours"))
    measured = F.try_element_at("hours", F.col("hour"))
    return hours.select(*[c for c in hours.columns if c != "hours"], *[measured[m].alias(m) for m in MEASURES])


def patient_hours(
    patients: DataFrame,
    points: DataFrame,
    weather: DataFrame,
    air: DataFrame,
    *,
    period: Period,
    now: Column,
    lookback_days: int = 0,
    survivor: list[str] = (),
) -> DataFrame:
    """The whole job up to its flat output.

    ``points``, ``weather`` and ``air`` are partitioned by month. ``lookback_days=2``
    also reads the points at the end of the month before; 0 leaves the first two days
    of a month to the fallback when there is no point yet. ``survivor`` names the
    columns that decide between duplicate hours of a location.
    """
    year, month = period.year, period.month
    timeline = location_timeline(read_months(points, year, month, lookback_days=lookback_days))
    spans = located_spans(patient_spans(patients, period, now), timeline)
    environment = environmental_hours(read_month(weather, year, month), read_month(air, year, month), order=survivor)
    return shape(with_environment(spans, environment))


def shape(hours: DataFrame) -> DataFrame:
    """Output columns: flat ones first, then those of the former structs."""
    hour = F.col("hour")
    nested = [c for c in hours.columns if c.startswith(("address_", "place_", "weather_coordinate_"))]
    return hours.select(
        "user_id",
        "latitude",
        "longitude",
        "precision",
        iso_ms(hour).alias("date"),
        "group_id",
        F.year(hour).alias("date_year"),
        F.month(hour).alias("date_month"),
        F.dayofmonth(hour).alias("date_day"),
        F.hour(hour).alias("date_hour"),
        "location_strategy",
        *MEASURES,
        *nested,
    )


def write(hours: DataFrame, path: str) -> None:
    write_partitions(hours, path, PARTITIONS)


def stale(existing: DataFrame, path: str, period: Period) -> DataFrame:
    """Partitions of the month that were there before and are not in the written output."""
    fresh = existing.sparkSession.read.parquet(path)
    return stale_partitions(existing, fresh, PARTITIONS, year=period.year, month=period.month)
