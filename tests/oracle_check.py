"""Run check queries against their DuckDB oracle, like the driver's gate.

    python tests/oracle_check.py [sf_dir] [key ...]

Prints one line per key: rows, column-name match, value match.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from rollwise.sources.catalog import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def rows_of(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


def compare(spark, con, key, qfn, sql, sf_dir, show=3):
    t0 = time.time()
    sdf = qfn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(key=key, rows=len(s_rows), oracle=None, spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    names_ok = sorted(s_cols) == sorted(d_cols)
    a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
    ok = names_ok and a == b
    info = dict(key=key, rows=len(s_rows), oracle_rows=len(d_rows), names_ok=names_ok,
                values_ok=a == b, spark_s=round(t1 - t0, 2))
    if not ok:
        info["spark_cols"] = sorted(s_cols)
        info["duck_cols"] = sorted(d_cols)
        sa, sb = set(a), set(b)
        info["only_spark"] = sorted(sa - sb, key=str)[:show]
        info["only_duck"] = sorted(sb - sa, key=str)[:show]
    return info


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf_dir, argv = argv[0], argv[1:]
    import __spark_entry__ as E
    from rollwise.session import get_spark
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    keys = argv or list(qs)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        try:
            info = compare(spark, con, k, qs[k], sqls.get(k), sf_dir)
        except Exception as e:  # report and go on
            info = dict(key=k, error=f"{type(e).__name__}: {str(e)[:400]}")
        ok = info.get("values_ok", info.get("oracle", 1) is None and "error" not in info)
        bad += 0 if ok else 1
        print(("OK  " if ok else "BAD ") + str(info), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
