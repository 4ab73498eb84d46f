"""A mergeable heavy-hitter sketch: counts of hashed keys that are never too low.

Keys are hashed to ``width`` buckets and rows are counted per bucket (partial aggregation: one row per bucket and task
crosses the network, and only the key column is read). A key's rows all fall into its bucket, so the bucket's count is at
least the key's: a key with more than n rows is never missed, and a small key that shares a bucket with others may be
taken for a large one. Sketches of parts add up to the sketch of the whole.

``width`` buckets hold rows / width rows on average; choose it so that this stays well under the bound that is asked for
(a million rows a key: 2**20 buckets serve some 10**11 rows). Too small a width costs time, never a result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 1 << 20


def bucket_of(key: Column, width: int = WIDTH) -> Column:
    """Bucket of a key (NULL has one too)."""
    return F.pmod(F.xxhash64(key), F.lit(width)).cast("int")


def count_sketch(df: DataFrame, key: str, width: int = WIDTH) -> DataFrame:
    """(bucket, rows): the sketch of the key column, at most ``width`` rows."""
    return df.select(bucket_of(F.col(key), width).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketch of all rows from sketches of parts (same width)."""
    return reduce(DataFrame.unionByName, sketches).groupBy("bucket").agg(F.sum("rows").alias("rows"))


def heavy_buckets(sketch: DataFrame, more_than: int) -> DataFrame:
    """(bucket) of every key with more than that many rows, and of those that share one."""
    return sketch.where(F.col("rows") > F.lit(more_than)).select("bucket")


def large_keys(df: DataFrame, key: str, more_than: int, out: str = "rows", width: int = WIDTH) -> DataFrame:
    """(key, rows) of the keys with more than that many rows, exactly: the sketch leaves the keys of heavy buckets, and only
    those are counted by key. The list of heavy buckets has at most ``width`` rows."""
    heavy = heavy_buckets(count_sketch(df, key, width), more_than)
    kept = df.select(key, bucket_of(F.col(key), width).alias("bucket")).join(F.broadcast(heavy), "bucket", "left_semi")
    return kept.groupBy(key).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > F.lit(more_than))
