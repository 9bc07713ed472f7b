"""Weather and air quality per location and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeloom.functions.times import hour_of
from lakeloom.operators.conform import with_missing

# Measures in output order, with their source column and type.
MEASURES = {
    "weather_pm25": ("pm25_concentration", "double"),
    "weather_pm10": ("pm10_concentration", "double"),
    "weather_dew_point": ("dew_point", "int"),
    "weather_wind_speed": ("wind_speed", "int"),
    "weather_o3": ("o3_concentration", "double"),
    "weather_no2": ("no2_concentration", "double"),
    "weather_heat_index": ("heat_index", "int"),
    "weather_wind_chill": ("wind_chill", "int"),
    "weather_co": ("co_concentration", "double"),
    "weather_wind_direction": ("wind_direction", "int"),
    "weather_so2": ("so2_concentration", "double"),
    "weather_aqi": ("breezometer_aqi", "int"),
    "weather_pressure": ("pressure", "double"),
    "weather_humidity": ("relative_humidity", "int"),
    "weather_temperature": ("temperature", "int"),
    "weather_visibility": ("visibility", "int"),
}


def hourly(rows: DataFrame, *, when: Column, keep: list[str], order: list[str] = (), location: str = "guid") -> DataFrame:
    """One row per location and hour, columns ``location_id``, ``hour`` and ``keep``.

    Rows without an hour never join anything and are left out. ``order`` chooses the
    survivor of duplicates; without it the survivor is the greatest by ``keep``.
    """
    rank = F.struct(*(order or keep))
    return (
        rows.select(
            F.col(location).alias("location_id"),
            hour_of(when).alias("hour"),
            F.struct(*keep).alias("row"),
            rank.alias("rank"),
        )
        .filter(F.col("hour").isNotNull())
        .groupBy("location_id", "hour")
        .agg(F.max_by("row", "rank").alias("row"))
        .select("location_id", "hour", *[F.col("row")[c].alias(c) for c in keep])
    )


def full_outer_hours(weather: DataFrame, air: DataFrame) -> DataFrame:
    """All hours of both sides; both come out of their reduction partitioned by the join keys."""
    return weather.join(air, ["location_id", "hour"], "full_outer")


def environmental_hours(weather: DataFrame, air: DataFrame, *, order: list[str] = ()) -> DataFrame:
    """The 16 measures per location and hour.

    Air quality is dated by ``datetime``; weather by ``datetime`` or else by
    ``date_observation``. Either column may be missing from the files.
    """
    measured = [source for source, _ in MEASURES.values()]
    weather = with_missing(weather, {"datetime": "string", "date_observation": "string"})
    air = with_missing(air, {"datetime": "string"})
    weather_hours = hourly(
        weather,
        when=F.coalesce(F.col("datetime").try_cast("timestamp"), F.when(F.col("datetime").isNull(), F.col("date_observation").try_cast("timestamp"))),
        keep=[c for c in measured if c in weather.columns],
        order=order,
    )
    air_hours = hourly(
        air,
        when=F.col("datetime").try_cast("timestamp"),
        keep=[c for c in measured if c in air.columns and c not in weather_hours.columns],
        order=order,
    )
    both = with_missing(full_outer_hours(weather_hours, air_hours), dict(MEASURES.values()))
    return both.select(
        "location_id", "hour", *[F.col(source).try_cast(kind).alias(name) for name, (source, kind) in MEASURES.items()]
    )


def day_environment(environment: DataFrame) -> DataFrame:
    """The hours of a location and day as one row: a map from hour to measures, of 24 entries at most."""
    return (
        environment.groupBy("location_id", F.date_trunc("day", "hour").alias("day"))
        .agg(F.map_from_entries(F.collect_list(F.struct("hour", F.struct(*MEASURES)))).alias("hours"))
    )
