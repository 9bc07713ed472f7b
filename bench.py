"""Time the headline queries on a warm session; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the timed runs per query after one warm-up (the median counts).
Every query is written to the ``noop`` sink, so all rows and columns are computed.
The bronze mappings read envelopes that were written once before the clock starts.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeloom.mapping.compiler import good_rows, map_events  # noqa: E402
from lakeloom.mapping.registry import MAPPINGS  # noqa: E402
from lakeloom.queries import QUERIES  # noqa: E402
from lakeloom.queries.base import Tables  # noqa: E402
from lakeloom.queries.bronze import PATIENT_BODY, PROSPECT_ARGS  # noqa: E402
from lakeloom.queries.bronze_activity import EVENT_BODY  # noqa: E402
from lakeloom.queries.feed import records  # noqa: E402
from lakeloom.session import build_session, scratch_dir  # noqa: E402
from lakeloom.sources.envelopes import decode_envelopes  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = {
    "latest_by_key": "latest_by_key",
    "hour_spine": "hour_spine",
    "asof_location": "asof_location",
    "env_hours_full_outer": "env_hours_full_outer",
    "patient_hours": "patient_hours",
    "change_dim": "change_dim",
    "keyed_upsert": "keyed_upsert",
    "fuzzy_exact_join": "name_join_exact",
    "member_match": "member_match",
    "send_batches": "send_batches",
    "upsert_partitioned": "upsert_partitioned",
    "bronze_to_dim_subgroup": "bronze_to_dim_subgroup",
}


def main() -> None:
    spark = build_session(
        "lakeloom-bench",
        master=f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, SF_DIR)
    plans = {name: (lambda q=QUERIES[query]: q(spark, SF_DIR)) for name, query in HEADLINE.items()}

    def mapped(table: str, body: dict, args: str | None = None):
        path = scratch_dir(spark, f"bench-{table}")
        more = {} if args is None else {"args": args}
        records(tables, MAPPINGS[table].event_types, body, **more).write.parquet(path)
        return lambda: good_rows(map_events(decode_envelopes(spark.read.parquet(path)), MAPPINGS[table]))

    plans["map_event"] = mapped("event", EVENT_BODY)
    plans["map_patient"] = mapped("patient", PATIENT_BODY, PROSPECT_ARGS)
    path = scratch_dir(spark, "bench-decode")
    records(tables, MAPPINGS["event"].event_types, EVENT_BODY).write.parquet(path)
    plans["decode_envelope"] = lambda: decode_envelopes(spark.read.parquet(path))

    seconds = {}
    for name, plan in plans.items():
        taken = []
        for run in range(RUNS + 1):
            started = time.perf_counter()
            plan().write.format("noop").mode("overwrite").save()
            if run:
                taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    result = {
        "metric": "total_median_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    with contextlib.suppress(Exception):
        spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
