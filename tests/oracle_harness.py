"""Run a registered Spark query and its DuckDB oracle side by side.

Comparison: same column names, same row count, and the same multiset of
rows (columns sorted by name, values normalised: floats compared exactly
after conversion to Python float, timestamps as naive datetimes).
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = {"name": name, "spark_rows": len(s_rows), "columns": s_names}
    if sql is None:
        res["ok"] = True
        res["check"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_names = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["names_ok"] = sorted(s_names) == sorted(d_names)
    res["values_ok"] = res["names_ok"] and _rows(s_names, s_rows) == _rows(d_names, d_rows)
    res["ok"] = res["names_ok"] and res["values_ok"] and len(s_rows) == len(d_rows)
    if not res["ok"]:
        a, b = _rows(s_names, s_rows), _rows(d_names, d_rows)
        res["only_spark"] = list((a - b).items())[:3]
        res["only_oracle"] = list((b - a).items())[:3]
        res["oracle_columns"] = d_names
    return res


def main(argv):
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from tillroll.session import local_session

    sf_dir = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    names = argv[1:] or list(E.queries())
    spark = local_session(8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, sf_dir, n, qs[n], sqls.get(n), con)
        except Exception as e:  # report and go on with the next query
            r = {"name": n, "ok": False, "error": repr(e)[:2000]}
        bad += not r["ok"]
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
