"""Compare registered queries with their SQL in DuckDB: ``python tests/check.py [sf] [name ...]``.

``TIDEMARK_SPLIT=1`` treats every input as large and cuts keys of more than 40 rows.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "\0null"
    if isinstance(v, bool):
        return str(v)
    return repr(round(v, 9)) if isinstance(v, float) else str(v)


def _rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(map(_cell, r)) for r in zip(*columns))


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and the SQL answer; empty when they agree."""
    got, want = df.toArrow(), con.sql(sql).to_arrow_table()
    problems = []
    if sorted(got.column_names) != sorted(want.column_names):
        return [f"columns {sorted(got.column_names)} != {sorted(want.column_names)}"]
    for n in got.column_names:
        a, b = str(got.schema.field(n).type), str(want.schema.field(n).type)
        if a.replace("large_", "") != b.replace("large_", ""):
            problems.append(f"type of {n}: {a} != {b}")
    if got.num_rows != want.num_rows:
        problems.append(f"rows {got.num_rows} != {want.num_rows}")
    a, b = _rows(got), _rows(want)
    if a != b:
        extra, missing = set(a) - set(b), set(b) - set(a)
        problems.append(f"values differ: extra {list(extra)[:3]} missing {list(missing)[:3]}")
    return problems


if __name__ == "__main__":
    from tidemark.plans.catalog import ORACLES, QUERIES
    from tidemark.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    data = f"/root/testdata/sf{sf}"
    session, db = local_session(8), connect(data)
    if os.environ.get("TIDEMARK_SPLIT"):
        session.conf.set("spark.tidemark.smallInputBytes", "0")
        session.conf.set("spark.tidemark.chunkRows", "20")
    bad = 0
    for name in names:
        begun = time.time()
        try:
            result = QUERIES[name](session, data)
            found = compare(result, db, ORACLES[name]) if name in ORACLES else [] if result.count() else ["no rows"]
        except Exception as error:  # report and go on
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok':4} {name:28} {time.time() - begun:6.2f}s {'; '.join(found)}", flush=True)
    print("failed:", bad, "of", len(names))
