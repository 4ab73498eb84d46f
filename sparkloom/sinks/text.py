"""Text sinks: line files, per-shard header, one directory per tag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# monotonically_increasing_id() = partition index << 33 | record number within the partition.
_RECORD_BITS = (1 << 33) - 1


def _as_lines(df: DataFrame, col: str | None) -> DataFrame:
    if col is None:
        if len(df.columns) != 1:
            raise ValueError("a text sink needs exactly one string column (or name it with col=)")
        col = df.columns[0]
    return df.select(F.col(col).cast("string").alias("value"))


def write_lines(df: DataFrame, path: str, col: str | None = None, num_shards: int | None = None,
                header: str | None = None, compression: str | None = None, mode: str = "errorifexists") -> str:
    """K1/K2: one line per row. ``num_shards`` fixes the file count (round-robin repartition); by
    default the existing partitioning is kept, so the write is as parallel as the job.

    ``header`` is written as the first line of every non-empty shard, and as a header-only file
    when there is no data at all. It is prepended to each partition's first record (record number
    0 of ``monotonically_increasing_id``) - a narrow, row-local expression, no extra pass. Blank
    and quote-bearing lines are written verbatim (unlike the CSV writer)."""
    lines = _as_lines(df, col)
    if num_shards is not None:
        lines = lines.repartition(num_shards)
    if header is not None:
        first = (F.monotonically_increasing_id().bitwiseAND(F.lit(_RECORD_BITS)) == F.lit(0))
        lines = lines.select(F.when(first, F.concat(F.lit(header + "\n"), F.coalesce("value", F.lit(""))))
                             .otherwise(F.col("value")).alias("value"))
    writer = lines.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    if header is not None:
        spark = df.sparkSession
        if spark.read.text(path).isEmpty():  # reads at most one line of the output just written
            spark.createDataFrame([(header,)], "value string").coalesce(1).write.mode("append").text(path)
    return path


def write_tagged(df: DataFrame, path: str, tag: str = "tag", col: str | None = None, mode: str = "errorifexists") -> str:
    """K3: one output directory per tag (``path/tag=<t>/``) from a single pass over the data."""
    value_col = col or next(c for c in df.columns if c != tag)
    df.select(F.col(value_col).cast("string").alias("value"), F.col(tag)).write.mode(mode).partitionBy(tag).text(path)
    return path
