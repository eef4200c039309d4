"""Run a registered query and its SQL oracle side by side and compare whole results.

``python tests/oracle.py SF_DIR [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

SPARK_KINDS = {"bigint": "int64", "int": "int32", "double": "float64", "string": "text", "boolean": "bool", "date": "date"}
DUCK_KINDS = {
    "BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "float64", "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date",
}


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, "" if v is None else repr(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def compare(spark, con, run, sql: str | None, root: str) -> str:
    """Empty string when equal, else what differs."""
    got = run(spark, root)
    names = sorted(got.columns)
    rows = sorted((tuple(r) for r in got.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    if sql is None:
        return "" if rows else "no rows"
    cursor = con.execute(f"SELECT * FROM ({sql.rstrip().rstrip(';')}) AS q")
    duck_types = {d[0]: str(d[1]) for d in cursor.description}
    order = [d[0] for d in cursor.description]
    if sorted(order) != names:
        return f"columns {names} != {sorted(order)}"
    index = [order.index(n) for n in names]
    want = sorted((tuple(r[i] for i in index) for r in cursor.fetchall()), key=_key)
    types = dict(got.dtypes)
    for n in names:
        a, b = SPARK_KINDS.get(types[n], types[n]), DUCK_KINDS.get(duck_types[n], duck_types[n])
        if a != b:
            return f"type of {n}: {types[n]} != {duck_types[n]}"
    if len(rows) != len(want):
        return f"{len(rows)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(rows, want) if not all(_same(x, y) for x, y in zip(a, b))]
    return f"{len(bad)} of {len(rows)} rows differ, first {bad[0]}" if bad else ""


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tests.session import local_session

    from panelspark.queries import oracles, runners

    root, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session(), connect(root)
    queries, sqls = runners(), oracles()
    failed = 0
    for name in names or sorted(queries):
        start = time.time()
        try:
            problem = compare(spark, con, queries[name], sqls.get(name), root)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        kind = "sql" if name in sqls else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:4} {time.time() - start:6.1f}s {name} {problem}", flush=True)
    print(f"{failed} failed")
    spark.stop()


if __name__ == "__main__":
    main()
