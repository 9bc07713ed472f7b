"""Bodies of the envelopes that queries are fed with."""

import json

from pyspark.sql import functions as F

from lakeloom.functions.texts import encode_base64
from lakeloom.queries.feed import Arr, Obj, body_json


def test_arrays_are_built_without_lambdas(spark):
    body = {
        "n": "1",
        "list": Arr([Obj({"a": "cast(event_id AS string)"}), {"a": "'@@[`x`]@@'"}], ["event_id > 1", "CASE WHEN event_id > 2 THEN true END"]),
        "plain": Arr(["CASE WHEN event_id = 3 THEN 'v' END"], ["event_id <> 2"]),
    }
    rows = spark.range(1, 5).select(F.col("id").alias("event_id")).select("event_id", body_json(body).alias("text"))
    assert "lambda" not in rows._jdf.queryExecution().optimizedPlan().toString()
    found = {r.event_id: json.loads(r.text) for r in rows.collect()}
    assert found == {
        1: {"n": 1, "plain": [None]},
        2: {"n": 1, "list": [{"a": "2"}], "plain": []},
        3: {"n": 1, "list": [{"a": "3"}, {"a": ["x"]}], "plain": ["v"]},
        4: {"n": 1, "list": [{"a": "4"}, {"a": ["x"]}], "plain": [None]},
    }


def test_base64_has_one_line(spark):
    text = spark.range(1).select(encode_base64(F.repeat(F.lit("é\r\n"), 100)).alias("t")).first().t
    assert "\n" not in text and "\r" not in text and len(text) == 536
