"""Run registered queries in Spark and their oracle SQL in DuckDB on one scale directory and
compare: column names, row count, and the sorted multiset of rows.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def type_mismatches(sdf, res):
    duck_types = {c[0]: str(c[1]).upper() for c in res.description}
    out = []
    for name, dtype in sdf.dtypes:
        want = SPARK_TO_DUCK.get(dtype, dtype.upper())
        got = duck_types.get(name)
        if got is not None and got != want:
            out.append((name, dtype, got))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_n = len(s_rows) == len(d_rows)
    ok_v = ok_cols and ok_n and rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)
    types = type_mismatches(sdf, res)
    info = dict(name=name, ok=ok_cols and ok_n and ok_v and not types, cols=ok_cols, count=ok_n, values=ok_v, types=types,
                rows=len(s_rows), oracle_rows=len(d_rows), spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2))
    if not info["ok"]:
        info["spark_cols"] = s_cols
        info["duck_cols"] = d_cols
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        diff = [x for x in a if x not in set(b)][:3]
        info["spark_only"] = diff
        info["duck_only"] = [x for x in b if x not in set(a)][:3]
    return info


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from prefkit.session import local_session

    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        info = compare(spark, con, name, qs[name], sqls.get(name), sf_dir)
        print(info, flush=True)
        bad += info["ok"] is False
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
