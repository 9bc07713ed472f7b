"""Publication: one pass, a gate before the commit, rejects, and files that go."""

import glob

import pytest
from pyspark.sql import functions as F, types as T

from lakeloom.operators.conform import ErrorBudget, conform_within
from lakeloom.session import scratch_dir
from lakeloom.sinks.publish import publish
from lakeloom.sources.tables import read_path

SCHEMA = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("n", T.IntegerType()), T.StructField("t", T.StringType())])
ROWS = [("1", "7", "abc"), ("2", "x", "abcdef"), (None, "9", "c"), ("y", None, None)]


def counted(spark, rows):
    """Rows that count how often they are computed."""
    calls = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(run, rows.schema), calls


def test_rows_are_computed_once_and_rejects_are_kept(spark):
    rows, calls = counted(spark, spark.createDataFrame(ROWS, "k string, n string, t string"))
    target, rejects = scratch_dir(spark, "target"), scratch_dir(spark, "rejects")
    report = publish(rows, target, SCHEMA, widths={"t": 3}, rejects=rejects)
    assert calls.value == len(ROWS)
    assert (report.rows, report.rejected, report.failed, report.spent) == (4, 2, {"k": 1, "n": 1}, 2)
    assert sorted(map(tuple, read_path(spark, target).collect())) == [(1, 7, "abc"), (2, None, "abc")]
    assert [r._errors for r in read_path(spark, rejects).collect()] == [["k"], ["k"]]
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/conformed-*")


def test_gate_keeps_the_old_table(spark):
    target = scratch_dir(spark, "target")
    rows = spark.createDataFrame(ROWS, "k string, n string, t string")
    publish(rows, target, SCHEMA, keys=["k"])
    old = sorted(map(tuple, read_path(spark, target).collect()))
    with pytest.raises(ValueError):
        publish(rows.withColumn("t", F.lit("new")), target, SCHEMA, budget=ErrorBudget(stage=1), keys=["k"])
    with pytest.raises(ValueError):
        publish(rows.withColumn("t", F.lit("new")), target, SCHEMA, budget=ErrorBudget(total=3), spent=2, keys=["k"])
    assert sorted(map(tuple, read_path(spark, target).collect())) == old
    publish(rows.where("k = '1'").withColumn("t", F.lit("new")), target, SCHEMA, keys=["k"])
    assert {r.k: r.t for r in read_path(spark, target).collect()} == {1: "new", 2: "abcdef"}


def test_conform_within_computes_once(spark):
    rows, calls = counted(spark, spark.createDataFrame(ROWS, "k string, n string, t string"))
    assert conform_within(rows, SCHEMA).count() == 4 and calls.value == len(ROWS)


def test_empty_rows_are_counted(spark):
    target = scratch_dir(spark, "target")
    report = publish(spark.createDataFrame([], "k string, n string, t string").repartition(3, "k"), target, SCHEMA)
    assert (report.rows, report.rejected, report.failed) == (0, 0, {}) and read_path(spark, target).count() == 0
    assert conform_within(spark.createDataFrame([], "k string, n string, t string").repartition(3, "k"), SCHEMA).count() == 0
