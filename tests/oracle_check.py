"""Compare every query with its SQL on one data folder: python -m tests.oracle_check [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def cell(v) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return repr(round(float(v), 9))
    if isinstance(v, datetime):
        return v.date().isoformat() if v.time().isoformat() == "00:00:00" else v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(cell(r[k]) for k in order) for r in rows)


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    return names, result.fetchall(), types


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def compare(df, sf_dir: str, sql: str) -> str:
    """Empty when both sides agree, else the first difference."""
    names, rows, _ = oracle_rows(sf_dir, sql)
    want, got = canonical(names, rows), canonical(*spark_rows(df))
    if want[0] != got[0]:
        return f"columns: sql only {set(want[0]) - set(got[0])}, spark only {set(got[0]) - set(want[0])}"
    if len(want[1]) != len(got[1]):
        return f"rows: sql {len(want[1])}, spark {len(got[1])}"
    for a, b in zip(want[1], got[1]):
        if a != b:
            diff = [(c, x, y) for c, x, y in zip(want[0], a, b) if x != y]
            return f"first difference (column, sql, spark): {diff}"
    return ""


def main(argv) -> int:
    import __spark_entry__ as entry
    from tests.conftest import make_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = make_session()
    queries, oracles, bad = entry.queries(), entry.oracle_sql(), 0
    for name in argv[1:] or queries:
        start = time.time()
        try:
            problem = compare(queries[name](spark, sf_dir), sf_dir, oracles[name]) if name in oracles else "no sql"
            count = ""
            if not problem:
                count = len(oracle_rows(sf_dir, oracles[name])[1])
        except Exception as e:  # report and go on with the next query
            problem, count = f"{type(e).__name__}: {str(e)[:500]}", ""
        bad += bool(problem)
        print(f"{name:28s} {time.time() - start:6.2f}s rows={count} {'ok' if not problem else problem}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
