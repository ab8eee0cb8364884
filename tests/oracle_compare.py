"""Compare registered Spark queries with their DuckDB SQL on the same Parquet files.

Run as a script to check everything: ``python tests/oracle_compare.py [folder] [name ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = [tuple(plain(row[i]) for i in order) for row in rows]
    return names, sorted(data, key=lambda row: tuple((v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n", v if v is not None else 0)
                                                     for v in row))


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
         "date": "DATE", "boolean": "BOOLEAN"}


def type_differences(df, connection, sql):
    """Columns whose Spark and DuckDB types are not counterparts."""
    theirs = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return [(n, t, theirs.get(n)) for n, t in df.dtypes if TYPES.get(t) != theirs.get(n)]


def compare(df, connection, sql):
    """None when equal, else a short description of the first difference."""
    names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    wanted_names, wanted = canonical([d[0] for d in result.description], result.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    wrong = [(a, b) for a, b in zip(got, wanted) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(wrong)} of {len(got)} rows differ, first: {cells}"
    return None


def main() -> int:
    from patronscope.session import build_session

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("oracle-compare", "local[8]", 8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    chosen = sys.argv[2:] or list(queries)
    connection = duck(folder)
    failures = 0
    for name in chosen:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            problem = compare(df, connection, oracles[name]) if name in oracles else f"rows only: {len(df.collect())}"
        except Exception as error:
            problem = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        if problem is None:
            different = type_differences(df, connection, oracles[name])
            problem = f"TYPES {different}" if different else None
        failed = problem is not None and not problem.startswith("rows only")
        failures += failed
        print(f"{'FAIL' if failed else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    unknown = set(oracles) - set(queries)
    print(f"{len(chosen)} run, {failures} failed, SQL without a query: {sorted(unknown)}")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
