"""Summarise the physical plan of every registered query as a markdown table.

    python tools/plans.py [sf_dir]

Columns: shuffles by kind (hash on a key / range / single partition), scanned columns per table,
subqueries, broadcasts and Python nodes. Sink queries are planned on their re-read and are left out.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkloom.plans.registry import QUERIES  # noqa: E402
from sparkloom.session import local_session  # noqa: E402

SINKS = {"partition_overwrite", "ingestion_partition", "table_sink_append", "table_sink_truncate",
         "text_roundtrip", "header_roundtrip", "tagged_sink", "text_source_lines", "incremental_staging",
         "incremental_staging_no_day", "tagged_sink_chunks", "header_null_lines", "table_sink_truncate_partitioned",
         "catalog_source", "catalog_sink", "catalog_partition_overwrite", "partition_divert"}


def summarise(plan: str) -> dict:
    ex = re.findall(r"Exchange (\w+)\(?([^\n]*)", plan)
    kinds = {"hash": 0, "range": 0, "single": 0}
    for kind, _ in ex:
        if kind == "hashpartitioning":
            kinds["hash"] += 1
        elif kind == "rangepartitioning":
            kinds["range"] += 1
        elif kind == "SinglePartition":
            kinds["single"] += 1
    scans = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
    ncols = [len(s.split(",")) for s in scans]
    return {
        **kinds,
        "scan_cols": "+".join(str(n) for n in ncols),
        "subquery": plan.count("Subquery subquery"),
        "broadcast": plan.count("BroadcastExchange"),
        "python": any(n in plan for n in ("PythonUDF", "EvalPython", "InPandas", "MapInArrow")),
    }


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    print("| query | key shuffles | range | single | scanned cols | subquery | broadcast | python |")
    print("|---|---|---|---|---|---|---|---|")
    for name in QUERIES:
        if name in SINKS:
            continue
        s = summarise(QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['hash']} | {s['range']} | {s['single']} | {s['scan_cols']} | "
              f"{s['subquery']} | {s['broadcast']} | {'yes' if s['python'] else 'no'} |")


if __name__ == "__main__":
    main(sys.argv[1:])
