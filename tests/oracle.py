"""Run registered queries next to their SQL checks and compare the values.

``python -m tests.oracle [--sf 0.01] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, str)):
        return value
    if isinstance(value, float):
        return value
    return str(value)


def normal(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, queries, oracles) -> str:
    frame = queries[name](spark, sf_dir)
    mine = normal(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in oracles:
        return f"rows-only {len(mine[1])}"
    con = connect(sf_dir)
    cursor = con.execute(oracles[name])
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    if mine[0] != theirs[0]:
        return f"COLUMNS differ: {sorted(set(mine[0]) ^ set(theirs[0]))}"
    if len(mine[1]) != len(theirs[1]):
        return f"ROWS differ: {len(mine[1])} vs {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            wrong = [(n, x, y) for n, x, y in zip(mine[0], a, b) if x != y or type(x) is not type(y)]
            return f"VALUES differ: {wrong[:4]}"
    return f"ok {len(mine[1])}"


def main(argv: list[str]) -> int:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from lakeloom.session import build_session

    sf = "0.01"
    if "--sf" in argv:
        at = argv.index("--sf")
        sf = argv[at + 1]
        argv = argv[:at] + argv[at + 2 :]
    spark = build_session(
        "oracle",
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in argv or list(queries):
        started = time.time()
        try:
            found = compare(spark, f"/root/testdata/sf{sf}", name, queries, oracles)
        except Exception as error:  # report and go on with the next query
            found = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += not found.startswith(("ok", "rows-only"))
        print(f"{name:32s} {time.time() - started:6.2f}s  {found}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
