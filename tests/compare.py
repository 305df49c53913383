"""Run registered queries beside their SQL in DuckDB and compare the rows.

``python tests/compare.py [sf_dir] [key ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd

TOLERANCE = 1e-9


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), v if not isinstance(v, float) else round(v, 6)) if v is not None else (True, "", 0) for v in r))


def differences(spark_frame, relation) -> list[str]:
    left_columns, right_columns = spark_frame.columns, relation.columns
    if sorted(left_columns) != sorted(right_columns):
        return [f"columns {sorted(left_columns)} / {sorted(right_columns)}"]
    # What the values become outside the engines must be alike as well.
    kinds = dict(zip(right_columns, [str(t) for t in relation.types]))
    expected = {
        "string": "VARCHAR",
        "bigint": "BIGINT",
        "int": "INTEGER",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "date": "DATE",
        "timestamp_ntz": "TIMESTAMP",
    }
    problems = [
        f"type of {c}: {t} / {kinds[c]}"
        for c, t in spark_frame.dtypes
        if expected.get(t) != kinds[c] and kinds[c] != '"NULL"'
    ]
    left = rows_of(left_columns, spark_frame.collect())
    right = rows_of(right_columns, relation.fetchall())
    if len(left) != len(right):
        return [*problems, f"rows {len(left)} / {len(right)}"]
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                same = math.isclose(x, y, rel_tol=TOLERANCE, abs_tol=TOLERANCE)
            else:
                same = x == y
            if not same:
                return [*problems, f"{a} / {b}"]
    exact = sum(x == y for a, b in zip(left, right) for x, y in zip(a, b))
    total = sum(len(a) for a in left)
    if exact != total:
        problems.append(f"inexact: {total - exact} of {total} values differ in the last bits")
    return problems


def main() -> None:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from tests.session import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or list(entry.queries())
    spark, connection, oracle = session(), duck(sf_dir), entry.oracle_sql()
    good = 0
    for key in keys:
        begin = time.time()
        try:
            frame = entry.queries()[key](spark, sf_dir)
            if key not in oracle:
                print(f"rows   {key:40s} {frame.count()} {time.time() - begin:.1f}s", flush=True)
                continue
            found = differences(frame, connection.sql(oracle[key]))
            count = connection.sql(f"SELECT count(*) FROM ({oracle[key]})").fetchall()[0][0]
        except Exception as error:
            found, count = [f"{type(error).__name__}: {str(error)[:600]}"], 0
        good += not found
        verdict = "ok    " if not found else "DIFF  "
        print(f"{verdict} {key:40s} {count:6d} {time.time() - begin:.1f}s {found or ''}", flush=True)
    print(f"{good} of {sum(k in oracle for k in keys)} agree")


if __name__ == "__main__":
    main()
