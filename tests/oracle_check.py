"""Run registered queries on Spark and their SQL twins on DuckDB, compare.

Mirrors the driver's gate: columns sorted by name, row count, and an
order-insensitive comparison of values (floats rounded to 6 digits).

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, int):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:].strip("0: ") == "" else str(v)
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    t2 = time.time()
    sc, sr = rows_of(scols, srows)
    dc, dr = rows_of(dcols, drows)
    ok_cols = sc == dc
    ok_n = len(sr) == len(dr)
    ok_v = sr == dr
    diff = None
    if not ok_v and ok_cols:
        ss, ds = set(sr), set(dr)
        diff = (list(ss - ds)[:3], list(ds - ss)[:3])
    return dict(name=name, cols=ok_cols, rows=ok_n, values=ok_v, n_spark=len(sr), n_duck=len(dr),
                spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2),
                scols=None if ok_cols else sc, dcols=None if ok_cols else dc, diff=diff)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from nextbuy.session import get_session
    spark = get_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name:40s} rows-only n={df.count()}")
            continue
        try:
            r = compare(spark, con, name, qs[name], sqls[name], sf_dir)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{name:40s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        ok = r["cols"] and r["rows"] and r["values"]
        bad += not ok
        print(f"{name:40s} {'OK ' if ok else 'BAD'} n={r['n_spark']}/{r['n_duck']} "
              f"spark={r['spark_s']}s duck={r['duck_s']}s"
              + ("" if ok else f" cols={r['scols']} vs {r['dcols']} diff={r['diff']}"))
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
