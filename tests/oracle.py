"""Run a registered query in Spark and its SQL oracle in DuckDB, compare.

Comparison: same column names (sorted), same row count, same multiset of
rows after normalising values (dates/timestamps to ISO text, floats to 6
decimals, NaN/None to None).
"""

from __future__ import annotations

import datetime as dt
import math
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):  # numpy scalars
        return _norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark, con, name, query, sql, sf_dir):
    sdf = query(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    problems = []
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns spark={sorted(scols)} duck={sorted(dcols)}")
        return problems, len(srows), len(drows)
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    a = sorted(rows_of(scols, srows), key=repr)
    b = sorted(rows_of(dcols, drows), key=repr)
    if a != b:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        problems.append(f"values differ; spark-only {diff_a} duck-only {diff_b}")
    return problems, len(srows), len(drows)


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from meterlake.session import build_session

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    names = argv[1:] or list(E.queries())
    spark = build_session()
    con = duck(sf_dir)
    sqls = E.oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"{n:32s} (no oracle)")
            continue
        try:
            probs, ns, nd = compare(spark, con, n, E.queries()[n], sqls[n], sf_dir)
        except Exception as e:  # report and go on
            probs, ns, nd = [f"error {type(e).__name__}: {str(e)[:400]}"], -1, -1
        bad += bool(probs)
        print(f"{n:32s} {'OK ' if not probs else 'BAD'} spark={ns} duck={nd} {' | '.join(probs)}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
