"""Spines and as-of locations against brute force, with the rows at every bound."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from lakeloom.functions.times import Period, ts_literal
from lakeloom.operators.asof import asof_hours, point_timeline
from lakeloom.operators.spine import disjoint_spans, hour_spans, hour_spine

HOUR = timedelta(hours=1)
BASE = datetime(2024, 1, 1)


def spine_rows(spark, entities, **options):
    rows = spark.createDataFrame(entities, "user string, start timestamp, end timestamp")
    spans = hour_spans(rows, ["user"], start=F.col("start"), end=F.col("end"), **options)
    found = hour_spine(spans).select("user", F.date_format("hour", "yyyy-MM-dd HH").alias("h")).collect()
    return sorted((r.user, r.h) for r in found)


def test_spine_bounds(spark):
    options = {"now": ts_literal("2024-02-10T10:30:00Z"), "period": Period(2024, 2)}
    entities = [
        ("before", datetime(2024, 1, 15), datetime(2024, 2, 1, 1, 59)),
        ("mid-hour", datetime(2024, 2, 3, 4, 5), datetime(2024, 2, 3, 5, 0, 0, 1)),
        ("reversed", datetime(2024, 2, 5), datetime(2024, 2, 4)),
        ("open", datetime(2024, 2, 10, 9), None),
        ("no start", None, datetime(2024, 2, 4)),
        ("late end", datetime(2024, 2, 29, 23), datetime(2024, 3, 5)),
    ]
    assert spine_rows(spark, entities, **options) == [
        ("before", "2024-02-01 00"),
        ("before", "2024-02-01 01"),
        ("late end", "2024-02-29 23"),
        ("mid-hour", "2024-02-03 04"),
        ("mid-hour", "2024-02-03 05"),
        ("open", "2024-02-10 09"),
        ("open", "2024-02-10 10"),
    ]


def test_spine_starts_in_2010_at_the_earliest(spark):
    options = {"now": ts_literal("2024-01-01T00:00:00Z"), "period": Period(2009, 12)}
    assert spine_rows(spark, [("a", datetime(2009, 1, 1), datetime(2009, 12, 31))], **options) == []


def test_copies_and_overlaps_give_every_hour_once(spark):
    h = [BASE + i * HOUR for i in range(12)]
    spans = [("a", h[0], h[3], "x")] * 3 + [("a", h[2], h[5], "y"), ("a", h[2], h[4], "z"), ("a", h[9], h[9], "w"), ("b", h[1], h[1], "v")]
    rows = spark.createDataFrame(spans, "user string, first_hour timestamp, last_hour timestamp, tag string")
    found = hour_spine(disjoint_spans(rows, ["user"], ["tag"])).collect()
    hours = sorted((r.user, r.hour) for r in found)
    assert hours == [("a", x) for x in h[0:6]] + [("a", h[9]), ("b", h[1])]
    tags = {(r.user, r.hour): r.tag for r in found}
    assert [tags["a", x] for x in h[0:6]] == ["x"] * 4 + ["y"] * 2


def brute(points, first, last):
    out, hour = {}, first
    while hour <= last:
        end = hour + timedelta(minutes=59, seconds=59, microseconds=999999)
        usable = [(ts, i) for ts, i in points if hour - timedelta(days=2) < ts < end]
        out[hour] = max(usable)[1] if usable else None
        hour += HOUR
    return out


def located(spark, users, spans):
    points = spark.createDataFrame([(u, ts, i) for u, ps in users.items() for ts, i in ps], "user string, ts timestamp, id int")
    rows = spark.createDataFrame(spans, "user string, first_hour timestamp, last_hour timestamp")
    timeline = point_timeline(points, ["user"], F.col("ts"), carry=["id"], tie=["id"])
    found = asof_hours(rows, timeline, ["user"]).collect()
    assert len({(r.user, r.hour) for r in found}) == len(found)
    return {(r.user, r.hour): (r.point.id if r.point else None) for r in found}


EDGE = [
    0,
    1,
    3_600_000_000 - 1,  # last microsecond of an hour: not usable in it
    3_600_000_000,
    48 * 3_600_000_000,
    48 * 3_600_000_000 - 1,
    50 * 3_600_000_000 + 5,
]


def test_points_on_the_bounds(spark):
    users = {f"u{n}": [(BASE + timedelta(microseconds=e), n)] for n, e in enumerate(EDGE)}
    first, last = BASE - 2 * HOUR, BASE + 110 * HOUR
    spans = [(u, first, last) for u in [*users, "nobody"]]
    expected = {(u, h): i for u in users for h, i in brute(users[u], first, last).items()}
    expected |= {("nobody", h): None for h in brute([], first, last)}
    assert located(spark, users, spans) == expected


moments = st.one_of(
    st.integers(0, 130 * 3600).map(lambda s: s * 1_000_000),
    st.sampled_from(EDGE),
    st.integers(0, 130).map(lambda h: h * 3_600_000_000 - 1),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(moments, max_size=25), min_size=1, max_size=6), st.integers(0, 100), st.integers(0, 100))
def test_random_points_equal_brute_force(spark, lists, start, length):
    users = {f"u{n}": [(BASE + timedelta(microseconds=m), i) for i, m in enumerate(ms)] for n, ms in enumerate(lists)}
    first, last = BASE + start * HOUR, BASE + (start + length) * HOUR
    expected = {(u, h): i for u in users for h, i in brute(users[u], first, last).items()}
    assert located(spark, users, [(u, first, last) for u in users]) == expected


def test_a_hot_user_stays_bounded(spark):
    """Many points of one user leave at most two spans per hour in the timeline."""
    points = spark.range(200_000).select(
        F.lit("hot").alias("user"),
        (F.lit("2024-01-01T00:00:00Z").cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 864000))).alias("ts"),
        F.col("id").cast("int").alias("id"),
    )
    timeline = point_timeline(points, ["user"], F.col("ts"), carry=["id"], tie=["id"])
    assert timeline.count() <= 2 * 24 * 10 + 3
