"""Compares registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, decimal.Decimal):
        return f"dec:{v}"
    return repr(v)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, build, sql: str) -> str:
    """'' when equal, else a short description of the difference."""
    df = build(spark, sf_dir)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    theirs = normal(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ in {sorted(columns)}; first {bad[0]}"
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    loose = {
        n: (types[n], duck[n])
        for n in types
        if (types[n], duck[n].split("(")[0])
        not in {
            ("int", "INTEGER"), ("bigint", "BIGINT"), ("double", "DOUBLE"), ("string", "VARCHAR"), ("boolean", "BOOLEAN"),
            ("date", "DATE"), ("timestamp_ntz", "TIMESTAMP"), ("float", "FLOAT"),
        } and not types[n].startswith("decimal")
    }
    return f"types {loose}" if loose else ""


def main() -> int:
    import __spark_entry__ as entry
    from opspark import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, sf_dir, queries[name], oracles[name])
                note = ""
            else:
                n = queries[name](spark, sf_dir).count()
                problem, note = "", f"rows only: {n}"
        except Exception as e:  # noqa: BLE001
            problem, note = f"{type(e).__name__}: {str(e)[:600]}", ""
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {time.time() - start:6.2f}s {problem or note}", flush=True)
    print(f"{failed} failed of {len(names or queries)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
