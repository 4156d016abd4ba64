"""Run registered queries on Spark and their SQL on DuckDB and compare the results.

Usage: python tests/parity.py [sf dir] [key prefix ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def compare(df, con, sql: str) -> str | None:
    """None when names, types and the multiset of rows agree, else what differs."""
    names = sorted(df.columns)
    result = con.execute(sql)
    other = {c[0]: str(c[1]) for c in result.description}
    if names != sorted(other):
        return f"columns {names} against {sorted(other)}"
    types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    wrong = {n: (types[n], other[n]) for n in names if types[n] != other[n]}
    order = [c[0] for c in result.description]
    theirs = Counter(
        tuple(cell(v) for _, v in sorted(zip(order, row, strict=True))) for row in result.fetchall()
    )
    ours = Counter(tuple(cell(r[n]) for n in names) for r in df.collect())
    if ours != theirs:
        return (
            f"{sum(ours.values())} rows against {sum(theirs.values())}; "
            f"only here {list((ours - theirs).items())[:2]}; only there {list((theirs - ours).items())[:2]}"
        )
    if wrong:
        return f"types {wrong}"
    return None if ours else "EMPTY"


def main(sf_dir: str, prefixes: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    from wavelens.session import local_session

    spark = local_session("parity")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), 0
    for key, run in queries().items():
        if prefixes and not any(key.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            if key in sql:
                problem = compare(run(spark, sf_dir), con, sql[key])
                state = "ok" if problem is None else problem
            else:
                state, problem = f"rows only: {run(spark, sf_dir).count()}", None
        except Exception as error:  # report and go on with the next query
            state = problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{key:40s} {time.time() - start:6.2f}s {state}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
