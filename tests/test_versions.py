"""Versioned tables: types, scope of rewriting, crashes at every step, races, dropping, compaction, deletion."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from lakeloom.session import scratch_dir
from lakeloom.sinks import versions
from lakeloom.sinks.tables import full_refresh, upsert
from lakeloom.sinks.versions import LostRace, compact, current, drop_parts, read_table_path, replace, replace_partitions, vacuum

KINDS = "k long, m string, v int"
ODD = ["01", "1", "1.0", "", None, "a/b", "a=b", "50%", "ä ö", "x:y", "[z]*", "2020-01-02"]


def content(spark, path):
    return sorted(map(tuple, read_table_path(spark, path).select("k", "m", "v").collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, KINDS)


def pointers(path):
    return sorted(n for n in os.listdir(f"{path}/_versions") if not n.startswith("."))


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "versions")


def test_odd_partition_values_survive_every_write(spark, path):
    rows = [(k, m, k) for k, m in enumerate(ODD)]
    kept = [(k, m or None, v) for k, m, v in rows]  # Spark writes an empty partition value as null
    replace(frame(spark, rows), path, keys=["m"])
    assert content(spark, path) == sorted(kept, key=repr)
    assert dict(read_table_path(spark, path).dtypes)["m"] == "string"
    for at, (k, m, _) in enumerate(rows):
        version = upsert(path, frame(spark, [(k, m, -k)]), ["k"])
        kept[at] = (k, m or None, -k)
        assert content(spark, path) == sorted(kept, key=repr), m
        assert max(map(len, version.parts.values())) <= 2
    full_refresh(read_table_path(spark, path).withColumn("v", F.col("v") + 1), path)
    assert content(spark, path) == sorted([(k, m, v + 1) for k, m, v in kept], key=repr)
    assert current(spark, path).keys == ("m",)


def test_plain_folder_becomes_a_table(spark, path):
    frame(spark, [(1, "01", 1), (2, "02", 2), (3, "01", 3)]).write.partitionBy("m").parquet(path)
    version = upsert(path, frame(spark, [(2, "02", 20)]), ["k"])
    assert content(spark, path) == [(1, "01", 1), (2, "02", 20), (3, "01", 3)]
    assert version.parts["m=01"] == [""] and version.parts["m=02"] != [""]
    assert dict(read_table_path(spark, path).dtypes)["m"] == "string"
    flat = scratch_dir(spark, "flat")
    frame(spark, [(1, "x", 1)]).write.parquet(flat)
    upsert(flat, frame(spark, [(1, "y", 5), (None, "z", 6)]), ["k"])
    assert content(spark, flat) == sorted([(1, "y", 5), (None, "z", 6)], key=repr)


def test_only_touched_partitions_are_written_again(spark, path):
    first = replace(frame(spark, [(k, f"{k % 10:02}", k) for k in range(100)]), path, keys=["m"])
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/_data/**/*.parquet", recursive=True)}
    second = upsert(path, frame(spark, [(7, "07", -7), (8, "03", -8), (1000, "05", 0), (1001, "new", 0)]), ["k"])
    changed = {p for p in second.parts if second.parts[p] != first.parts.get(p)}
    assert changed == {"m=07", "m=08", "m=03", "m=05", "m=new"}
    assert [len(second.parts[f"m={p}"]) for p in ("07", "08", "03", "05")] == [1, 1, 2, 2]
    expected = [(k, f"{k % 10:02}", k) for k in range(100) if k not in (7, 8)] + [(7, "07", -7), (8, "03", -8), (1000, "05", 0), (1001, "new", 0)]
    assert content(spark, path) == sorted(expected, key=repr)
    assert {p: os.stat(p).st_mtime_ns for p in before} == before


def test_partition_that_loses_all_rows_goes(spark, path):
    replace(frame(spark, [(1, "a", 1), (2, "b", 2)]), path, keys=["m"])
    assert set(upsert(path, frame(spark, [(1, "b", 9)]), ["k"]).parts) == {"m=b"}
    assert content(spark, path) == [(1, "b", 9), (2, "b", 2)]


def test_empty_tables_and_stages(spark, path):
    assert upsert(path, frame(spark, []), ["k"]).number == 1 and content(spark, path) == []
    upsert(path, frame(spark, [(1, "a", 1)]), ["k"])
    upsert(path, frame(spark, []), ["k"])
    assert content(spark, path) == [(1, "a", 1)]
    keyed = scratch_dir(spark, "keyed")
    replace(frame(spark, []), keyed, keys=["m"])
    assert content(spark, keyed) == []
    upsert(keyed, frame(spark, [(1, "a", 1)]), ["k"])
    assert content(spark, keyed) == [(1, "a", 1)] and set(current(spark, keyed).parts) == {"m=a"}


class Dies(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "list", "pointer", "torn"])
@pytest.mark.parametrize("job", ["replace", "upsert", "replace_partitions", "compact"])
def test_crash_at_every_step_leaves_the_old_content(spark, path, monkeypatch, step, job):
    replace(frame(spark, [(1, "a", 1), (2, "b", 2)]), path, keys=["m"])
    upsert(path, frame(spark, [(3, "a", 3)]), ["k"])
    old = content(spark, path)
    jobs = {
        "replace": lambda: full_refresh(frame(spark, [(9, "z", 9)]), path),
        "upsert": lambda: upsert(path, frame(spark, [(1, "a", 10)]), ["k"]),
        "replace_partitions": lambda: replace_partitions(frame(spark, [(9, "a", 9)]), path, ["m"]),
        "compact": lambda: compact(spark, path, folders=1),
    }
    results = {"replace": [(9, "z", 9)], "upsert": [(1, "a", 10), (2, "b", 2), (3, "a", 3)], "replace_partitions": [(2, "b", 2), (9, "a", 9)], "compact": old}

    def dies(*_):
        raise Dies

    def half_written(*args):
        write(*args)
        raise Dies

    def torn(spark, target, base, new):
        with open(f"{target}/_versions/{base.following:012d}.json", "w") as file:
            file.write(new.text()[:-20])
        raise Dies

    write = versions._write
    name, broken = {"write": ("_write", dies), "list": ("_write", half_written), "pointer": ("commit", dies), "torn": ("commit", torn)}[step]
    with monkeypatch.context() as patch:
        patch.setattr(versions, name, broken)
        with pytest.raises(Dies):
            jobs[job]()
    assert content(spark, path) == old
    jobs[job]()  # the same again
    assert content(spark, path) == results[job]


def test_failing_rows_leave_the_old_content(spark, path):
    replace(frame(spark, [(1, "a", 1)]), path, keys=["m"])
    bad = frame(spark, [(1, "a", 1)]).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("dies"))).otherwise(F.col("v")))
    with pytest.raises(Exception):
        full_refresh(bad, path)
    assert content(spark, path) == [(1, "a", 1)]


def test_second_of_two_writers_fails(spark, path, monkeypatch):
    replace(frame(spark, [(1, "a", 1)]), path, keys=["m"])
    commit = versions.commit

    def other_first(spark, target, base, new):
        monkeypatch.setattr(versions, "commit", commit)
        upsert(path, frame(spark, [(5, "b", 5)]), ["k"])
        commit(spark, target, base, new)

    monkeypatch.setattr(versions, "commit", other_first)
    with pytest.raises(LostRace):
        upsert(path, frame(spark, [(1, "a", 2)]), ["k"])
    assert content(spark, path) == [(1, "a", 1), (5, "b", 5)]


def test_readers_keep_their_version(spark, path):
    replace(frame(spark, [(1, "a", 1)]), path, keys=["m"])
    seen = read_table_path(spark, path)
    full_refresh(frame(spark, [(2, "b", 2)]), path)
    assert list(map(tuple, seen.collect())) == [(1, "a", 1)]


def test_dropped_partitions(spark, path):
    replace(frame(spark, [(k, m, 0) for k, m in enumerate(ODD)]), path, keys=["m"])
    stale = spark.createDataFrame([("01",), (None,), ("a/b",), ("missing",)], "m string")
    assert drop_parts(spark, path, stale) == 3
    assert {r[1] for r in content(spark, path)} == set(ODD) - {"01", None, "", "a/b"}


def test_compaction_keeps_rows(spark, path):
    replace(frame(spark, [(0, "a", 0)]), path, keys=["m"])
    for k in range(1, 5):
        upsert(path, frame(spark, [(k, "a", k), (-k, "b" if k == 1 else "c", k)]), ["k"])
    old = content(spark, path)
    assert compact(spark, path, folders=2) == 2
    assert content(spark, path) == old and max(map(len, current(spark, path).parts.values())) <= 2
    assert compact(spark, path, folders=2) == 0


def test_vacuum_deletes_what_nobody_names(spark, path):
    frame(spark, [(1, "01", 1), (2, "02", 2)]).write.partitionBy("m").parquet(path)
    for n in range(4):
        full_refresh(frame(spark, [(n, "01", n)]), path)
    os.makedirs(f"{path}/_data/_version=lost/m=01")
    open(f"{path}/_versions/{9:012d}.json", "w").close()
    assert vacuum(spark, path, keep=2) == [] and len(os.listdir(f"{path}/_data")) == 5
    time.sleep(0.01)
    assert len(vacuum(spark, path, keep=2, older_than_s=0)) == 3
    assert content(spark, path) == [(3, "01", 3)] and not glob.glob(f"{path}/m=*")
    assert pointers(path) == [f"{n:012d}.json" for n in (3, 4, 9)]
    upsert(path, frame(spark, [(7, "07", 7)]), ["k"])
    assert content(spark, path) == [(3, "01", 3), (7, "07", 7)] and pointers(path)[-1] == f"{10:012d}.json"
    assert json.loads(open(f"{path}/_versions/{10:012d}.json").read())["keys"] == ["m"]
