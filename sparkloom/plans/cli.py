"""Command-line entry point for the jobs (``spark-submit -m``-style or ``python -m``).

    python -m sparkloom.plans.cli stage --table raw.orders --schema-json /schemas/ORDERS.json \
        --output /warehouse/staging/orders --partition-col create_dt
    python -m sparkloom.plans.cli group-words --input in/*.txt --output out/

The session comes from the environment (cluster settings, ``spark.checkpoint.dir``); nothing here
overrides it.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkloom.plans import jobs
from sparkloom.sinks.tables import NO_PARTITION_COLUMN
from sparkloom.sources import readers


def _kv_text(spark: SparkSession, path: str):
    """``key,value`` lines -> (k, v) strings (for the co-group job)."""
    from sparkloom.functions.strings import field

    lines = readers.read_lines(spark, path)
    return lines.select(field(F.col("value"), 0).alias("k"), field(F.col("value"), 1).alias("v"))


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sparkloom")
    sub = p.add_subparsers(dest="job", required=True)

    def text_job(name: str, help_: str) -> argparse.ArgumentParser:
        sp = sub.add_parser(name, help=help_)
        sp.add_argument("--input", required=True)
        sp.add_argument("--output", required=True)
        sp.add_argument("--num-shards", type=int, default=None)
        return sp

    st = sub.add_parser("stage", help="raw (all-string) table or SQL query -> typed, day-partitioned table")
    st.add_argument("--table")
    st.add_argument("--query")
    st.add_argument("--schema-json")
    st.add_argument("--schema-string")
    st.add_argument("--output", required=True)
    st.add_argument("--partition-col", default=NO_PARTITION_COLUMN)
    st.add_argument("--on-error", default="reset", choices=["reset", "null_field", "strict", "reject"])
    st.add_argument("--on-null", default="fail", choices=["fail", "divert"])
    st.add_argument("--reject-output")
    st.add_argument("--input-format", default="parquet")
    st.add_argument("--output-format", default="parquet")

    tt = sub.add_parser("stage-table", help="raw table or SQL query -> typed table with dispositions")
    tt.add_argument("--table")
    tt.add_argument("--query")
    tt.add_argument("--schema-json")
    tt.add_argument("--schema-string")
    tt.add_argument("--on-error", default="reset", choices=["reset", "null_field", "strict", "reject"])
    tt.add_argument("--output", required=True)
    tt.add_argument("--write", default="append", choices=["append", "truncate", "empty"])
    tt.add_argument("--create", default="if_needed", choices=["if_needed", "never"])
    tt.add_argument("--input-format", default="parquet")
    tt.add_argument("--output-format", default="parquet")

    text_job("group-words", "'word, n' lines -> 'word:[n1, n2]'")
    text_job("sum-words", "'word, n' lines -> 'word:sum'")
    text_job("longest-words", "'word, n' lines -> groups of the longest words")
    sw = sub.add_parser("split-words", help="grouped words routed to below/above/marker outputs")
    sw.add_argument("--input", required=True)
    sw.add_argument("--output", required=True)
    sw.add_argument("--cutoff", type=int, default=jobs.DEFAULT_CUTOFF)
    sw.add_argument("--marker", default=jobs.DEFAULT_MARKER)
    cg = sub.add_parser("cogroup", help="two 'key,value' inputs -> 'key : [..];[..]'")
    cg.add_argument("--left", required=True)
    cg.add_argument("--right", required=True)
    cg.add_argument("--output", required=True)
    cg.add_argument("--blank-empty", action="store_true")
    text_job("recode-sessions", "session CSV: drop headers, recode field 6, header on every shard")
    text_job("upper-usernames", "session CSV: field 2 upper-cased")
    cc = text_job("city-customers", "customer CSV: keep one city")
    cc.add_argument("--city", default=jobs.DEFAULT_CITY)
    cr = text_job("customer-records", "lines starting with a customer id (comments skipped)")
    cr.add_argument("--customer-id", required=True)
    return p


def run(spark: SparkSession, argv: Sequence[str]) -> str:
    a = build_parser().parse_args(list(argv))
    if a.job == "stage":
        return jobs.raw_to_staging(spark, output=a.output, table=a.table, query=a.query,
                                   schema_json_path=a.schema_json, schema_string=a.schema_string,
                                   partition_col=a.partition_col, on_error=a.on_error, on_null=a.on_null,
                                   reject_output=a.reject_output, input_format=a.input_format,
                                   output_format=a.output_format)
    if a.job == "stage-table":
        return jobs.raw_to_table(spark, output=a.output, table=a.table, query=a.query,
                                 schema_json_path=a.schema_json, schema_string=a.schema_string, on_error=a.on_error,
                                 write=a.write, create=a.create,
                                 input_format=a.input_format, output_format=a.output_format)
    if a.job == "cogroup":
        inputs = {"left": _kv_text(spark, a.left), "right": _kv_text(spark, a.right)}
        return jobs.cogroup_pairs(inputs, output=a.output, blank_empty=a.blank_empty)
    if a.job == "split-words":
        return jobs.split_words(spark, input=a.input, output=a.output, cutoff=a.cutoff, marker=a.marker)
    simple = {
        "group-words": jobs.group_words, "sum-words": jobs.sum_words, "longest-words": jobs.longest_words,
        "recode-sessions": jobs.recode_sessions, "upper-usernames": jobs.upper_usernames,
    }
    if a.job in simple:
        return simple[a.job](spark, input=a.input, output=a.output, num_shards=a.num_shards)
    if a.job == "city-customers":
        return jobs.city_customers(spark, input=a.input, output=a.output, city=a.city, num_shards=a.num_shards)
    if a.job == "customer-records":
        return jobs.customer_records(spark, input=a.input, output=a.output, customer_id=a.customer_id,
                                     num_shards=a.num_shards)
    raise AssertionError(a.job)


def main(argv: Sequence[str] | None = None) -> None:
    import sys

    spark = SparkSession.builder.appName("sparkloom").getOrCreate()
    print(run(spark, sys.argv[1:] if argv is None else argv))


if __name__ == "__main__":
    main()
