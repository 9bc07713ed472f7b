"""Delivery of batches in several rounds."""

from pyspark.sql import functions as F

from lakeloom.streaming.delivery import deliver_batches, taken


def test_records_are_made_once_for_all_rounds(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(value):
        made.add(1)
        return value

    mark = F.udf(seen, "string").asNondeterministic()
    rows = spark.range(600, numPartitions=3).select(F.lit("f").alias("file"), F.lit("t").alias("event_type"), (F.col("id") / 100).cast("long").alias("batch"), mark(F.col("id").cast("string")).alias("data"))
    ledger = str(tmp_path / "ledger")
    assert deliver_batches(rows, lambda event_type, own: None, ledger, per_round=2) == 6
    assert made.value == 600
    assert taken(spark, ledger).agg(F.sum("records")).first()[0] == 600
    assert deliver_batches(rows, lambda event_type, own: None, ledger, per_round=2) == 0
