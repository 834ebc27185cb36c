"""Run named queries against their SQL on DuckDB: python tools/check.py [sf_dir] [name ...]."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def session(cpus: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool):
        return str(v)
    return None if v is None else str(v)


def rows_of(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in idx) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, q, sql):
    t0 = time.time()
    df = q(spark, sf_dir)
    got = df.collect()
    took = time.time() - t0
    if sql is None:
        return True, f"{len(got)} rows (no SQL) {took:.1f}s"
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want_rows = rel.fetchall()
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}"
    a, b = rows_of(df.columns, got), rows_of(cols, want_rows)
    if a != b:
        extra = [x for x in a if x not in set(b)][:3]
        missing = [x for x in b if x not in set(a)][:3]
        return False, f"{len(a)} vs {len(b)} rows\n   {sorted(cols)}\n   spark {extra}\n   sql   {missing}"
    return True, f"{len(a)} rows {took:.1f}s"


def main(argv):
    from lapsewatch import catalog

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark, con = session(), connect(sf_dir)
    sqls = catalog.oracle_sql()
    bad = []
    for name, q in catalog.queries().items():
        if names and name not in names:
            continue
        try:
            ok, note = compare(spark, con, sf_dir, name, q, sqls.get(name))
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:700]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
