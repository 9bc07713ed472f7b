"""Events once, batches delivered once, rejects that lead back; failures at the steps in between."""

import json

import pytest
from pyspark.sql import functions as F

from lakeloom.session import scratch_dir
from lakeloom.sources.pointers import records_of, with_pointer
from lakeloom.streaming import once
from lakeloom.streaming.delivery import DeliveryFailed, deliver_batches, taken
from lakeloom.streaming.once import keep_new, merge_ledger

EVENTS = "id string, ts timestamp_ntz, v int"


def events(spark, *rows):
    return spark.createDataFrame([(i, at, v) for i, at, v in rows], "id string, at string, v int").select("id", F.to_timestamp("at").alias("ts"), "v")


@pytest.fixture
def places(spark):
    return scratch_dir(spark, "out"), scratch_dir(spark, "ledger")


def written(spark, out):
    return sorted(((r.id or "", r.v) for r in spark.read.parquet(out).collect()))


def test_late_events_come_through_and_repeats_do_not(spark, places):
    out, ledger = places
    put = lambda n, *rows: keep_new(events(spark, *rows), n, out, ledger, stream="s", key="id")
    put(0, ("a", "2024-01-20", 1), ("a", "2024-01-20", 1), ("b", "2024-01-20", 2), (None, "2024-01-20", 3), (None, None, 4))
    put(1, ("c", "2024-01-10", 5), ("a", "2024-01-20", 1), ("d", None, 6))  # c is ten days late
    put(2, ("c", "2024-01-10", 5), ("d", None, 6), ("b", "2024-01-20", 2))
    put(3, ("e", "2024-01-01", 7), (None, "2024-01-01", 8))
    assert written(spark, out) == [("", 3), ("", 4), ("", 8), ("a", 1), ("b", 2), ("c", 5), ("d", 6), ("e", 7)]


def test_repeated_batch_writes_itself_again(spark, places, monkeypatch):
    out, ledger = places
    rows = [("a", "2024-01-20", 1), ("b", "2024-01-21", 2)]
    keep_new(events(spark, ("z", "2024-01-20", 0)), 0, out, ledger, stream="s", key="id")

    def dies(*args):
        if args[3] == ledger:
            raise RuntimeError("dies")
        write(*args)

    write = once._write
    with monkeypatch.context() as patch:  # after the events, before the ledger
        patch.setattr(once, "_write", dies)
        with pytest.raises(RuntimeError):
            keep_new(events(spark, *rows), 1, out, ledger, stream="s", key="id")
    for _ in range(2):
        keep_new(events(spark, *rows), 1, out, ledger, stream="s", key="id")
        assert written(spark, out) == [("a", 1), ("b", 2), ("z", 0)]
    keep_new(events(spark, *rows), 2, out, ledger, stream="s", key="id")
    assert written(spark, out) == [("a", 1), ("b", 2), ("z", 0)]


def test_only_the_days_of_a_batch_are_read(spark, places):
    out, ledger = places
    for n in range(5):
        keep_new(events(spark, *[(f"{n}-{k}", f"2024-01-1{n}", k) for k in range(40)]), n, out, ledger, stream="s", key="id")
    batch = events(spark, ("3-7", "2024-01-13", 0)).withColumns({"_day": once._day("ts"), "_bucket": once._bucket("id", once.BUCKETS)})
    known = once._known(spark, ledger, batch, "s", 9, "id")
    assert 1 <= len(known.inputFiles()) and known.count() < 40
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "2024-01-13" in scan and "PushedFilters: []" in scan


def test_merged_ledger_knows_the_same(spark, places):
    out, ledger = places
    for n in range(4):
        keep_new(events(spark, (f"{n}", "2024-01-10", n), ("x", "2024-01-11", 9)), n, out, ledger, stream="s", key="id")
    before = {r.id for r in once._entries(spark, ledger, "id").collect()}
    assert merge_ledger(spark, ledger, stream="s", before=3, key="id") > 0
    assert {r.id for r in once._entries(spark, ledger, "id").collect()} == before
    keep_new(events(spark, *[(f"{n}", "2024-01-10", n) for n in range(6)]), 4, out, ledger, stream="s", key="id")
    assert written(spark, out) == [("0", 0), ("1", 1), ("2", 2), ("3", 3), ("4", 4), ("5", 5), ("x", 9)]
    merge_ledger(spark, ledger, stream="s", before=4, key="id")
    assert {r.id for r in once._entries(spark, ledger, "id").collect()} == before | {"4", "5"}


def test_delivery_goes_on_where_it_broke(spark, tmp_path):
    rows = spark.range(1000).select(F.lit("f").alias("file"), F.when(F.col("id") % 2 == 0, "a").alias("event_type"), F.floor(F.col("id") / 100).alias("batch"), "id")
    inbox, ledger = tmp_path / "inbox", str(tmp_path / "ledger")
    inbox.mkdir()

    def receiver(fails):
        def send(event_type, batch):
            if (event_type, batch[0].batch) in fails:
                raise ConnectionError("away")
            with open(inbox / f"{event_type}-{batch[0].batch}", "x") as file:  # a second delivery would fail
                json.dump(sorted(r.id for r in batch), file)

        return send

    with pytest.raises(DeliveryFailed, match="3 batches.*away"):
        deliver_batches(rows, receiver({("a", 3), (None, 4), (None, 9)}), ledger, per_round=7)
    assert len(list(inbox.iterdir())) == 17 and taken(spark, ledger).count() == 17
    with pytest.raises(DeliveryFailed, match="1 batches"):
        deliver_batches(rows, receiver({("a", 3)}), ledger)
    assert deliver_batches(rows, receiver(()), ledger) == 1
    assert deliver_batches(rows, receiver(()), ledger) == 0
    assert sorted(i for f in inbox.iterdir() for i in json.loads(f.read_text())) == list(range(1000))


def test_results_of_a_job_that_died_do_not_count(spark, tmp_path):
    ledger = tmp_path / "ledger"
    (ledger / "half").mkdir(parents=True)
    rows = spark.createDataFrame([("f", "a", 0)], "file string, event_type string, batch long")
    assert deliver_batches(rows, lambda *_: None, str(ledger)) == 1 and taken(spark, str(ledger)).count() == 1


def test_equal_records_and_records_without_text_are_found(spark):
    rows = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", None), ("3", "y")], "id string, body string")
    pointed = with_pointer(rows, "body", record_id="id")
    rejects = pointed.where("body is null or body = 'x'").select("pointer", F.array(F.lit("bad")).alias("errors"))
    found = records_of(rejects, rows, "body", record_id="id").select("id", "body", "errors").collect()
    assert sorted(map(tuple, found), key=repr) == [("1", "x", ["bad"]), ("1", "x", ["bad"]), ("2", None, ["bad"])]
