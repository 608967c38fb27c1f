"""Run registered queries next to their SQL and compare all rows. Also usable by hand: python tests/oracle.py [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    import datetime
    import decimal
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return repr(0.0 if v == 0 else v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(" ")
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_plain(x)) for x in v) + "]"
    return f"{type(v).__name__}:{v}"


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(str(_plain(r[i])) for i in order) for r in data)


def compare(spark, con, name: str, sf_dir: str, fn, sql) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"{len(got[1])} rows, no oracle"
    res = con.execute(sql)
    want = rows([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} vs {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return False, f"{len(got[1])} vs {len(want[1])} rows; spark only {list(a - b)[:2]}; oracle only {list(b - a)[:2]}"
    return True, f"{len(got[1])} rows"


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracles = duck(sf_dir), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in (names or queries):
        matched = [q for q in queries if q == name or (name.endswith("*") and q.startswith(name[:-1]))]
        for q in matched:
            start = time.time()
            try:
                ok, note = compare(spark, con, q, sf_dir, queries[q], oracles.get(q))
            except Exception as exc:  # noqa: BLE001
                ok, note = False, f"{type(exc).__name__}: {str(exc)[:1500]}"
            bad += not ok
            print(f"{'ok  ' if ok else 'FAIL'} {q} {time.time() - start:.1f}s {note}", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
