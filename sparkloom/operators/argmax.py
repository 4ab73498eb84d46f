"""Rows with the greatest value, in one pass over the input.

A scalar subquery over the same input reads it twice. Here every task streams its rows once and lets through only those that
reach the greatest value seen so far in it (Arrow batches, nothing is held); what is left, usually a handful of rows a
task, is exchanged once, and both the overall maximum and the rows that have it are read from that one exchange.
Ties are kept, however many there are: they are spread over the tasks they come from, never gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.exchange import above_exchange

BY, TASK = "_by", "_task"


def keep_greatest(df: DataFrame, by: Column) -> DataFrame:
    """The rows whose ``by`` (a whole number, may be NULL) equals its maximum; rows with NULL never do."""
    from pyspark.sql.types import LongType, StructType

    if {BY, TASK} & set(df.columns):
        raise ValueError(f"{BY} and {TASK} are taken")
    schema = StructType([*df.schema.fields]).add(BY, LongType())
    place = len(df.columns)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for b in batches:
            values = b.column(place)
            top = pc.max(values).as_py()
            if top is None or (best is not None and top < best):
                continue
            best = top
            yield b.filter(pc.equal(values, top))

    pruned = df.withColumn(BY, by.cast("bigint")).mapInArrow(prune, schema)
    # Dealt by the task a row comes from: even a third of all rows tied stays spread.
    pruned = pruned.withColumn(TASK, F.spark_partition_id()).repartition(TASK)
    # The maximum reads every column (through a hash), so that both readers need the same exchange and Spark reuses it.
    greatest = pruned.agg(F.max(F.struct(F.col(BY), F.xxhash64(*df.columns, TASK)))[BY]).scalar()
    return pruned.where(above_exchange(F.col(BY) == greatest)).drop(BY, TASK)
