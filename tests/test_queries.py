"""Every registered query: equal to its SQL check, and planned without the known traps."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

# the training-data queries have tests of their own in tests/llm
from lakeloom.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", list(QUERIES))
def test_equals_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, name, QUERIES, ORACLES).startswith(("ok", "rows-only"))


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plan_has_no_product_or_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for trap in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert trap not in plan


def test_entry_is_the_flagship(spark):
    rows = entry.entry(spark)
    assert {"user_id", "date", "location_strategy", "weather_pm25", "address_city"} <= set(rows.columns)
    assert rows.count() > 0
