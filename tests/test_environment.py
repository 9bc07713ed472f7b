"""Weather of hours joined by location and day."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeloom.operators.environment import MEASURES
from lakeloom.operators.spine import day_spans, hour_spine
from lakeloom.plans.patient_hours import with_environment

BASE = datetime(2024, 2, 27)
HOUR = timedelta(hours=1)
MEASURED = ", ".join(f"{name} {kind}" for name, (_, kind) in MEASURES.items())
spans = st.lists(st.tuples(st.integers(0, 80), st.integers(-3, 60), st.sampled_from(["a", "b", None])), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(given_spans=spans, env=st.sets(st.tuples(st.sampled_from(["a", "c"]), st.integers(0, 130)), max_size=40))
def test_equals_a_join_by_hour(spark, given_spans, env):
    rows = [(str(k), BASE + a * HOUR, BASE + (a + n) * HOUR, at) for k, (a, n, at) in enumerate(given_spans)]
    made = spark.createDataFrame(rows, "user_id string, first_hour timestamp, last_hour timestamp, weather_coordinate_id string")
    blank = (None,) * (len(MEASURES) - 1)
    weather = spark.createDataFrame([(at, BASE + h * HOUR, float(h), *blank) for at, h in env], f"location_id string, hour timestamp, {MEASURED}")
    found = with_environment(made, weather).select("user_id", "hour", "weather_pm25", F.col("weather_coordinate_id").alias("at")).collect()
    expected = [(str(k), BASE + h * HOUR, float(h) if (at, h) in env else None, at) for k, (a, n, at) in enumerate(given_spans) for h in range(a, a + n + 1)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_days_cover_the_hours_of_their_span(spark):
    made = spark.createDataFrame([("u", BASE + 5 * HOUR, BASE + 53 * HOUR), ("v", BASE, BASE), ("w", BASE + HOUR, BASE)], "k string, first_hour timestamp, last_hour timestamp")
    cut = day_spans(made)
    assert sorted((r.k, r.first_hour.hour, r.last_hour.hour) for r in cut.collect()) == [("u", 0, 5), ("u", 0, 23), ("u", 5, 23), ("v", 0, 0)]
    assert sorted(map(tuple, hour_spine(cut.drop("day")).collect())) == sorted(map(tuple, hour_spine(made).collect()))


def test_hours_are_not_shuffled(spark):
    made = spark.createDataFrame([], "user_id string, first_hour timestamp, last_hour timestamp, weather_coordinate_id string")
    weather = spark.createDataFrame([], f"location_id string, hour timestamp, {MEASURED}")
    plan = with_environment(made.hint("merge"), weather)._jdf.queryExecution().optimizedPlan().toString()
    top = plan.split("Join")[0]
    assert "sequence(first_hour" in top and "Repartition" not in top
