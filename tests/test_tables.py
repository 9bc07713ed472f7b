"""Sinks, matching, conforming, batching and streams."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from lakeloom.functions.times import Period, ts_literal
from lakeloom.operators.conform import ErrorBudget, conform_within, profile
from lakeloom.operators.latest import best_per_attributes, latest_by_key, number_rows
from lakeloom.operators.people import close_names
from lakeloom.plans import dim_subgroup as subgroups, patient_hours as hours
from lakeloom.plans.member_match import MatchRules, match_members, submissions
from lakeloom.session import scratch_dir
from lakeloom.sinks.records import send_batches
from lakeloom.sinks.tables import drop_partitions, refresh_table, upsert, write_partitions
from lakeloom.sources.tables import read_path
from lakeloom.streaming.replay import start_replay
from tests.test_mappings import record


def test_latest_takes_the_greatest_tie_breaker(spark):
    rows = spark.createDataFrame([("a", 1, "x", None), ("a", 2, "x", "k"), ("a", 2, "y", "l"), ("b", 0, "z", "m")], "k string, t int, id string, v string")
    found = {r.k: (r.t, r.id, r.v) for r in latest_by_key(rows, ["k"], ["t", "id"]).collect()}
    assert found == {"a": (2, "y", "l"), "b": (0, "z", "m")}


def test_numbering_of_a_hot_key(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 20_000).alias("n"))
    for bucket in (F.floor(F.col("n") / 1000), None):
        numbered = number_rows(rows, ["k"], ["n"], bucket=bucket)
        assert numbered.filter(F.col("row_number") != F.col("n") + 1).count() == 0


def test_numbering_of_copies(spark):
    """A key of identical rows and a null key still get every number once."""
    copies = spark.range(5_000).select(F.lit("a").alias("k"), F.lit(1).alias("n"))
    rows = copies.unionByName(spark.range(700).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("n")))
    numbered = number_rows(rows, ["k"], ["n"])
    found = numbered.groupBy("k").agg(F.count_distinct("row_number").alias("d"), F.max("row_number").alias("m")).collect()
    assert sorted((r.k or "", r.d, r.m) for r in found) == [("", 700, 700), ("a", 5000, 5000)]


def test_close_names_equal_brute_force(spark):
    left = ["ann", "anna", "hannah", "", "bo", "b", "xyzzy", None]
    right = ["ann", "ana", "hanna", "a", "ob", "", "xyz", None]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    a = spark.createDataFrame([(x,) for x in left * 3], "a string")
    b = spark.createDataFrame([(x,) for x in right * 2], "b string")
    for k in (0, 1, 2):
        found = sorted((r.a, r._other, r.distance) for r in close_names(a, b, ("a", "b"), distance=k).collect())
        expected = sorted((x, y, distance(x, y)) for x in left if x is not None for y in right if y is not None if distance(x, y) <= k)
        assert found == expected


def test_best_row_prefers_a_match(spark):
    rows = spark.createDataFrame([("s", None, None), ("s", "u1", "p"), ("s", "u2", None), ("t", None, None)], "s string, uid string, promo string")
    assert sorted(tuple(r) for r in best_per_attributes(rows, ["uid", "promo"]).collect()) == [("s", "u2", None), ("t", None, None)]


def _file(spark, rows, v2=False):
    names = ["mem_first_name", "mem_last_name", "diagnosis", "patient_date_of_birth", "date_of_service"]
    others = [
        "zip", "address-1", "address-2", "city", "email", "phone nbr", "state", "client name", "division", "market",
        "medical_record_number", "patient_gender", "patient_language", "diagnosis_code_1", "diagnosis_desc_1",
        "rendering_provider", "pcp_name", "clinic_desc", "date_ingested",
    ]
    if v2:
        others += ["cerner_person_id", "group_display_name", "address_country_code"]
    schema = ", ".join(f"`{n}` string" for n in names + others)
    return spark.createDataFrame([tuple(r) + (None,) * len(others) for r in rows], schema)


def test_member_match_edges(spark):
    v1 = [
        ("ANN", "A", "COPD", "2/29/1960", "1/2/2020"),
        ("ANN", "A", "COPD", "2/29/1960", "1/2/2020"),
        ("BOB", "B", "ASTHMA", "09/27/68", ""),
        ("CAT", "C", "Asthma", "01/01/69", "9/27/01"),
        ("DAN", "D", "other", "01/01/69", "9/27/01"),
        (None, "E", "ASTHMA", "", "9/27/01"),
        ("fay", "F", "ASTHMA", "01/01/69", "9/27/01"),
    ]
    v2 = [("GUS", "G", "COPD", "02/29/32", "9/27/01")]
    users = [
        ("u1", date(1960, 2, 29), "in", " ann", "a "), ("u2", date(1960, 2, 29), "in", "Ann", "A"),
        ("u3", date(1960, 2, 29), "out", "Ann", "A"), ("u4", date(1968, 9, 27), "in", "bob", "b"),
        ("u5", date(1969, 1, 1), "in", "cat", "c"), ("u6", date(1969, 1, 1), "in", "dan", "d"),
        ("u7", date(1969, 1, 1), "in", "fay", "f"), ("u8", date(1932, 2, 29), "in", "gus", "g"),
        ("u9", None, "in", None, "e"),
    ]
    dim = spark.createDataFrame(users, "uid string, date_of_birth date, promo string, first_name string, last_name string")
    today, now = F.lit("2024-06-01").cast("date"), ts_literal("2024-06-01T00:00:00Z")
    files = submissions(_file(spark, v1), _file(spark, v2, True))

    def matched(**rules):
        found = match_members(files, dim, MatchRules(promotions=("in",), **rules), today=today, now=now).collect()
        return {r.last_name: (r.uid, r.promo, r.date_of_birth, r.date_of_service) for r in found}, len(found)

    found, n = matched()
    assert n == 7
    assert found["A"] == ("u2", "in", date(1960, 2, 29), date(2020, 1, 2))
    assert found["B"] == ("u4", "in", date(1968, 9, 27), None)
    assert found["C"] == ("u5", "in", date(1969, 1, 1), date(2001, 9, 27))
    assert found["D"] == (None, None, None, None)
    assert found["E"] == (None, None, None, date(2001, 9, 27))
    assert found["F"] == (None, None, date(1969, 1, 1), date(2001, 9, 27))
    assert found["G"] == ("u8", "in", date(1932, 2, 29), date(2001, 9, 27))
    assert matched(normalize="both")[0]["F"][0] == "u7"


def test_subgroup_dimension(spark):
    schema = "subgroup_id string, name string, display_name string, type string, group_id string, call_time string, pub_sub_event_id string"

    def change(i, name, at, event):
        return (i, name, name.upper(), None, "g", at, event)

    created = [change("a", "one", "2020-01-01", "1"), change("a", "again", "2020-01-05", "2"), change("b", "bee", "1577836800000", "3")]
    updated = [change("a", "tie1", "2020-01-07", "4"), change("a", "tie2", "2020-01-07", "5"), change("c", "cee", "2020-01-01", "6")]
    deleted = [change("a", "gone", "2020-01-06", "7")]
    frames = [spark.createDataFrame(rows, schema) for rows in (created, updated, deleted)]
    dimension = subgroups.dim_subgroup(*frames, region="eu")
    found = {r.subgroup_id: r for r in dimension.collect()}
    assert len(found) == 3
    a = found["a"]
    assert (a.subgroup_name, a.deleted, a.created_datetime, a.deleted_datetime, a.datetime_modified) == (
        "tie2", True, datetime(2020, 1, 1), datetime(2020, 1, 6), datetime(2020, 1, 7),
    )
    assert (found["b"].deleted, found["b"].created_datetime) == (False, datetime(2020, 1, 1))
    good, bad = subgroups.checked(dimension)
    assert sorted(r.subgroup_id for r in good.collect()) == ["a", "b"]
    assert [(r.subgroup_id, r._errors) for r in bad.collect()] == [("c", ["created_datetime"])]


def test_error_budget(spark):
    rows = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    assert sorted(r.n for r in conform_within(rows, schema).collect() if r.n) == [1]
    with pytest.raises(ValueError):
        conform_within(rows, schema, ErrorBudget(stage=0))
    with pytest.raises(ValueError):
        conform_within(rows, schema, ErrorBudget(total=5), spent=5)


def test_upsert_is_idempotent_and_keeps_null_keys(spark):
    path = scratch_dir(spark, "target")
    spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int").write.parquet(path)
    stage = spark.createDataFrame([("a", 10), ("a", 11), ("c", 12)], "k string, v int")
    for _ in range(2):
        upsert(path, stage, ["k"])
        found = sorted(((r.k or "", r.v) for r in read_path(spark, path).collect()))
        assert found == [("", 2), ("a", 10), ("a", 11), ("b", 3), ("c", 12)]


def test_refresh_of_a_catalog_table(spark):
    for n in (3, 5):
        refresh_table(spark.range(n), "refreshed")
        assert spark.table("refreshed").count() == n
    refresh_table(spark.table("refreshed").filter("id < 2"), "refreshed")
    assert spark.table("refreshed").count() == 2
    refresh_table(spark.range(4).withColumn("more", F.lit("x")), "refreshed")
    assert spark.table("refreshed").columns == ["id", "more"] and spark.table("refreshed").count() == 4
    spark.sql("drop table refreshed")


def test_stale_partitions_of_a_catalog_table(spark):
    rows = spark.createDataFrame([("g1", 2024, 1), ("it's", 2024, 1), ("g1", 2024, 2)], "group_id string, date_year int, date_month int")
    rows.withColumn("v", F.lit(1)).write.partitionBy("group_id", "date_year", "date_month").saveAsTable("hours_table")
    stale = spark.createDataFrame([("it's", 2024, 1)], "group_id string, date_year int, date_month int")
    assert drop_partitions(spark, "hours_table", stale, ["group_id", "date_year", "date_month"]) == 1
    assert sorted((r.group_id, r.date_month) for r in spark.table("hours_table").collect()) == [("g1", 1), ("g1", 2)]


def test_hot_partition_is_split(spark):
    path = scratch_dir(spark, "hot")
    rows = spark.range(400_000).select(F.lit("hot").alias("g"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        write_partitions(rows.unionByName(spark.range(5).select(F.lit("cold").alias("g"), F.lit("x").alias("v"))), path, ["g"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.read.parquet(path).select("g", "_metadata.file_path").distinct().groupBy("g").count().collect()
    count = {r.g: r["count"] for r in files}
    assert count["hot"] > 4 and count["cold"] == 1


def test_patient_hours_write_and_stale(spark):
    path, old = scratch_dir(spark, "new"), scratch_dir(spark, "old")
    schema = "user_id string, group_id string, date_year int, date_month int"
    rows = spark.createDataFrame([("a", "g1", 2024, 1), ("b", "g2", 2024, 1), ("b", "g3", 2024, 2)], schema)
    hours.write(rows, old)
    hours.write(rows.filter("group_id = 'g1'"), path)
    found = hours.stale(spark.read.parquet(old), path, Period(2024, 1)).collect()
    assert [tuple(r) for r in found] == [("g2", 2024, 1)]


def test_sent_batches(spark):
    rows = spark.range(1050).select((F.col("id") % 2).cast("string").alias("event_type"), "id").repartition(3)
    out = scratch_dir(spark, "sent")

    def send(key, batch):
        import os
        import uuid

        os.makedirs(out, exist_ok=True)
        with open(f"{out}/{uuid.uuid4().hex}", "w") as file:
            json.dump([key, [r.id for r in batch]], file)

    send_batches(rows, send)
    sent = [json.loads(r.value) for r in spark.read.text(out, wholetext=True).collect()]
    assert max(len(ids) for _, ids in sent) == 100
    assert sorted(i for _, ids in sent for i in ids) == list(range(1050))
    assert all(str(i % 2) == key for key, ids in sent for i in ids)


def test_replayed_files_are_archived(spark, tmp_path):
    letters = tmp_path / "in" / "act_createdprocessing-failed"
    letters.mkdir(parents=True)
    line = json.dumps({"rawData": record("act_created", {"score": 1})})
    (letters / "one").write_text(f"{line}\n\n{line}\n")
    out, archive, seen = str(tmp_path / "out"), str(tmp_path / "archive"), []
    for n in range(3):
        query = start_replay(
            spark, str(tmp_path / "in"), out, str(tmp_path / "checkpoint"), archive=archive,
            deliver=lambda rows, _: seen.append(rows.count()),
        )
        query.awaitTermination()
        (letters / f"more{n}").write_text(f"{line}\n")
    found = spark.read.parquet(out)
    assert found.count() == 4 and {r.feed for r in found.collect()} == {"act_created-retry"}
    assert sum(seen) == 4
    assert (letters / "one").exists() is False


def test_letters_that_cannot_be_decoded_are_kept_apart(spark, tmp_path):
    letters = tmp_path / "in" / "act_createdprocessing-failed" / "2024" / "01"
    letters.mkdir(parents=True)
    lines = [json.dumps({"rawData": record("act_created", {"score": 1})}), json.dumps({"rawData": "%%"})]
    (letters / "one").write_text("\n".join(lines))
    out = str(tmp_path / "out")
    start_replay(spark, str(tmp_path / "in"), out, str(tmp_path / "checkpoint")).awaitTermination()
    assert [r.feed for r in spark.read.parquet(out).collect()] == ["act_created-retry"]
    lost = spark.read.parquet(f"{out}_rejected").collect()
    assert [(r.feed, r.file.endswith("/one")) for r in lost] == [("act_created-retry", True)]


def test_profile(spark):
    found = profile(spark.range(7), sample=2, where=F.col("id") > 5)
    assert (found["count"], [r.id for r in found["sample"]]) == (7, [6])


def test_period():
    assert Period.of(0, 0, today=date(2024, 2, 3)) == Period(2024, 2)
    assert Period.of(2023, 12).end == datetime(2023, 12, 31, 23, 59, 59, 999999)
