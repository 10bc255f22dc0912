"""Run queries on Spark and on DuckDB and compare: names, row counts, values.

    python -m tests.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

DEFAULT_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def difference(spark_df, con, sql: str) -> str | None:
    """What differs, or nothing."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(names)}"
    types = {d[0]: str(d[1]) for d in result.description}
    for name, kind in spark_df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            return f"column {name} is {kind} and {types[name]}"
    rows = spark_df.select(*[f"`{n}`" for n in names]).collect()
    got = Counter(tuple(plain(v) for v in r) for r in rows)
    want = Counter(tuple(plain(v) for v in r) for r in expected)
    if got != want:
        only_got, only_want = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"{len(rows)} and {len(expected)} rows; Spark only {only_got}; SQL only {only_want}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry_points
    from weirgate.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default=DEFAULT_DIR)
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark, con = build_session("compare", 8), connect(args.sf)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    failed = 0
    for name in args.names or queries:
        begun = time.time()
        try:
            df = queries[name](spark, args.sf)
            problem = difference(df, con, oracle[name]) if name in oracle else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += bool(problem) and name in oracle
        print(f"{name:28s} {time.time() - begun:6.2f}s {problem or 'same'}", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
