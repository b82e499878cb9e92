"""Compare queries with their SQL in DuckDB: names, row counts, values.

python -m tests.oracle [sf] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _value(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(v + 0.0)
    if hasattr(v, "as_tuple"):  # a decimal where Spark gives a double or integer
        return repr(v)
    return str(v) if not isinstance(v, str) else v


def _kind(dtype: str) -> str:
    dtype = dtype.lower()
    for kind, names in {"int64": ("bigint",), "int32": ("int", "integer"), "double": ("double",),
                        "string": ("varchar", "string")}.items():
        if dtype in names:
            return kind
    return dtype


def difference(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    result = con.sql(sql)
    types = dict(zip(result.columns, [str(d) for d in result.dtypes]))
    if sorted(types) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(types)}"
    names = sorted(types)
    spark_types = dict(df.dtypes)
    odd = [(n, spark_types[n], types[n]) for n in names if _kind(spark_types[n]) != _kind(types[n])]
    mine = sorted(tuple(_value(r[n]) for n in names) for r in df.collect())
    order = [result.columns.index(n) for n in names]
    theirs = sorted(tuple(_value(r[i]) for i in order) for r in result.fetchall())
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]} (types {odd})"
    if odd:
        return f"types {odd}"
    return None if mine else "empty"


def main():
    from tests.session import session
    import __spark_entry__ as entry

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{scale}"
    spark, con = session(), connection(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    failed = []
    for name in names:
        start = time.perf_counter()
        try:
            df = queries[name](spark, folder)
            if name in sql:
                bad = difference(df, con, sql[name])
            else:
                bad = None if df.count() else "empty"
        except Exception as e:  # report and go on
            bad = f"{type(e).__name__}: {str(e)[:1500]}"
        took = time.perf_counter() - start
        print(f"{'ok  ' if bad is None else 'FAIL'} {name} {took:.1f}s {'' if name in sql else '(rows only) '}{bad or ''}", flush=True)
        failed += [name] if bad else []
    print(f"{len(names) - len(failed)} of {len(names)} ok; failed: {failed}")


if __name__ == "__main__":
    main()
