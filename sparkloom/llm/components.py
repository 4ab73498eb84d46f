"""Connected components as DataFrame steps: least-label spreading with pointer jumping.

Labels and edges stay in tables; each round is written to the shared folder (no lineage grows), and
only a count comes back to the driver. A vertex with very many edges costs one partial minimum per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, label) for every end of an edge (a, b); label is the least node of its component.

    The caller may pass the ``Scratch`` that holds the last round's table and removes it later; earlier ones go at once.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    write = scratch.write
    both = write(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "cc-edges")
    labels = write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).select(F.col("u").alias("node"), "label"), "cc")
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.least("label", "near").alias("low"), (F.col("near") < F.col("label")).alias("moved"))
        step = write(step, "cc")
        scratch.drop(labels)
        if step.filter("moved").isEmpty():
            scratch.drop(both)
            return step.select("node", F.col("low").alias("label"))
        jump = step.select(F.col("node").alias("low"), F.col("low").alias("lower"))
        labels = write(step.join(jump, "low").select("node", F.col("lower").alias("label")), "cc")
        scratch.drop(step)
