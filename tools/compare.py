"""Run every query in Spark and in DuckDB and compare the results.

    python tools/compare.py [folder] [name ...]
"""

from __future__ import annotations

import collections
import math
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

import duckdb

from ledgerloom.plans import catalog, oracle
from ledgerloom.session import local_session

DEFAULT_FOLDER = "/root/testdata/sf0.01"
_SPARK_KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{folder}/{file}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


def compare(spark, con, folder: str, name: str) -> list[str]:
    """Differences between the two results; none if they agree."""
    df = catalog.queries()[name](spark, folder)
    columns = sorted(df.columns)
    ours = [_key(tuple(r)) for r in df.select(*(f"`{c}`" for c in columns)).collect()]
    cursor = con.execute(oracle.statements()[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    names = [d[0] for d in cursor.description]
    problems = []
    if sorted(names) != columns:
        return [f"columns {columns} != {sorted(names)}"]
    kinds = {f.name: _SPARK_KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    problems += [f"type of {c}: {kinds[c]} != {described[c]}" for c in columns if kinds[c] != described[c]]
    order = [names.index(c) for c in columns]
    theirs = [_key(tuple(r[i] for i in order)) for r in cursor.fetchall()]
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    a, b = collections.Counter(ours), collections.Counter(theirs)
    if a != b:
        problems.append(f"only in Spark {list((a - b).items())[:2]}; only in DuckDB {list((b - a).items())[:2]}")
    return problems


def main() -> int:
    args = sys.argv[1:]
    folder = args.pop(0) if args and "/" in args[0] else DEFAULT_FOLDER
    spark, con, bad = local_session(), connect(folder), 0
    for name in args or catalog.queries():
        start = time.time()
        try:
            problems = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok '} {name} {time.time() - start:.2f}s", *problems, sep="\n    ", flush=True)
    print(f"{bad} of {len(args or catalog.queries())} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
