"""Run registered queries on Spark and their oracle SQL on DuckDB; compare rows order-insensitively.

    python tools/parity.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from sparkloom.plans.registry import ORACLE, QUERIES  # noqa: E402
from sparkloom.plans.testdata import TABLES  # noqa: E402
from sparkloom.session import local_session  # noqa: E402


def norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        if math.isnan(v):
            return ("f", "nan")
        return ("f", repr(v))
    if isinstance(v, decimal.Decimal):
        return ("n", str(v.normalize()) if v == v else "nan")
    if isinstance(v, int):
        return ("n", str(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("s", str(v))


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    if os.environ.get("PARITY_DEFAULT_SESSION"):
        # A session with Spark's defaults (200 shuffle partitions, local time zone, ANSI as shipped)
        # to check that no query relies on the settings of ``local_session``.
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", os.environ.get("PARITY_TZ", "America/Los_Angeles"))
                 .config("spark.sql.ansi.enabled", os.environ.get("PARITY_ANSI", "false")).getOrCreate())
    else:
        spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            t1 = time.time()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: spark error {str(e)[:400]}")
            bad += 1
            continue
        if name not in ORACLE:
            print(f"NOORACLE {name}: rows={len(rows)} ({t1 - t0:.1f}s)")
            continue
        try:
            res = con.execute(ORACLE[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL  {name}: oracle error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL  {name}: columns {cols} vs {ocols}")
            bad += 1
            continue
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
        a = sorted(tuple(norm(r[i]) for i in order) for r in rows)
        b = sorted(tuple(norm(r[i]) for i in oorder) for r in orows)
        if a != b:
            bad += 1
            diff_a = [x for x in a if x not in set(b)][:3]
            diff_b = [x for x in b if x not in set(a)][:3]
            print(f"FAIL  {name}: rows {len(a)} vs {len(b)}; spark-only {diff_a}; oracle-only {diff_b}")
        else:
            print(f"OK    {name}: rows={len(a)} ({t1 - t0:.1f}s)")
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
