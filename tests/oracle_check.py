"""Compare each registered Spark query with its DuckDB oracle SQL on the same parquet tables.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


# Spark type → DuckDB type, for the schema part of the comparison.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def compare(spark, con, name: str, builder, sql: str):
    t0 = time.time()
    sdf = builder(spark, SF_DIR)
    s_cols = sdf.columns
    s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
               for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    d_types = {d[0]: str(d[1]) for d in res.description}
    bad_types = {c: (s_types[c], d_types[c]) for c in s_types
                 if c in d_types and d_types[c] != "None" and s_types[c] != d_types[c]}
    if bad_types:
        problems.append(f"types {bad_types}")
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={s_cols} duck={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows), t1 - t0, t2 - t1


SF_DIR = "/root/testdata/sf0.01"


def main(argv):
    global SF_DIR
    if argv and argv[0].startswith("/"):
        SF_DIR = argv[0]
        argv = argv[1:]
    from listingflow.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("local[8]", 8)
    con = duck_connect(SF_DIR)
    qs, os_ = E.queries(), E.oracle_sql()
    names = argv or list(qs)
    bad = 0
    for n in names:
        if n not in os_:
            print(f"{n:28s} NO-ORACLE")
            continue
        try:
            problems, rows, ts, td = compare(spark, con, n, qs[n], os_[n])
        except Exception as e:  # noqa: BLE001
            problems, rows, ts, td = [f"error {type(e).__name__}: {str(e)[:600]}"], -1, 0, 0
        status = "OK" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{n:28s} {status:4s} rows={rows:<7d} spark={ts:.2f}s duck={td:.2f}s {'; '.join(problems)[:1500]}")
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
