"""Run registered queries next to their SQL and compare: `python tests/compare.py [sf] [names...]`."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    """Exact text: numbers that differ in the last bit, or in the sign of zero, are different."""
    return repr(float(v)) if isinstance(v, float) else str(v)


def normal(columns, rows):
    """Rows as sorted text tuples, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    cols, rows = normal(df.columns, df.collect())
    result = con.execute(sql)
    want_cols, want = normal([d[0] for d in result.description], result.fetchall())
    if cols != want_cols:
        return [f"columns {cols} != {want_cols}"]
    if len(rows) != len(want):
        return [f"rows {len(rows)} != {len(want)}"]
    wrong = [(a, b) for a, b in zip(rows, want) if a != b]
    return [f"{len(wrong)} rows differ, first {wrong[0]}"] if wrong else []


if __name__ == "__main__":
    from conftest import make_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, sqls = make_session(), oracle_connection(sf_dir), entry.oracle_sql()
    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        t = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in sqls:
                found = differences(df, con, sqls[name])
            else:
                found = [] if df.count() else ["no rows"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        kind = "sql" if name in sqls else "rows"
        print(f"{'FAIL' if found else 'ok  '} {kind} {name} {time.time() - t:.1f}s {found or ''}", flush=True)
    print("failures:", bad)
