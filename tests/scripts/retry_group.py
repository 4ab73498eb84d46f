"""Run group_lines with one injected task failure after the range split; print the lines as JSON.

A test-only Python UDF raises in the first attempt of partition 0 of the stage that builds the runs,
so the task is retried (master local[N, maxFailures]). The result must not change."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from sparkloom.operators import keyed  # noqa: E402


@F.udf(T.StringType())
def fail_once(k):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("injected failure")
    return k


def main():
    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "6").config("spark.sql.adaptive.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    hot = spark.range(0, 3000).select(F.lit("hot").alias("k"), (F.col("id") % 500).alias("v"))
    cold = spark.range(0, 300).select(F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("k"),
                                      F.col("id").alias("v"))
    df = hot.unionByName(cold)
    runs = keyed.group_runs(df, "k", "v", as_text=True)
    runs = runs.withColumn("k", fail_once("k"))  # evaluated in the post-range stages
    joined = runs.groupBy("k").agg(F.collect_list(F.struct("_run", "txt")).alias("_p")).select(
        "k", F.array_join(F.transform(F.array_sort("_p"), lambda s: s["txt"]), ", ").alias("txt"))
    print(json.dumps(sorted([r.k, r.txt] for r in joined.collect())))


if __name__ == "__main__":
    main()
