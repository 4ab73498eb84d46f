"""Incremental staging: the same typed-staging operator over raw files as they arrive.

Raw files (all-string columns) land in a folder; a Structured Streaming query stages each new file
set with ``stage`` and appends it to a day-partitioned parquet table through the file sink. The
file sink and the checkpoint make it exactly-once and restartable: after an executor or driver loss
the query resumes from the checkpoint and re-commits nothing twice.

Why append and not day-replace: a micro-batch holds only part of a day, so replacing the days it
touches would drop the rows earlier micro-batches wrote for the same day. The batch job
(``plans.jobs.raw_to_staging``) keeps the replace-the-touched-days semantics.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkloom import schema as sch
from sparkloom.operators.staging import stage
from sparkloom.session import shared_dir
from sparkloom.sinks.tables import INGESTION_DAY, NO_PARTITION_COLUMN


def raw_schema(fields: list[sch.Field]) -> T.StructType:
    """The raw side: every schema column (minus the load-time column) as a string."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in sch.raw_projection(fields)])


def start_staging_stream(
    spark: SparkSession,
    *,
    source_dir: str,
    fields: list[sch.Field],
    output: str,
    partition_col: str | None = NO_PARTITION_COLUMN,
    on_error: str = "reset",
    source_format: str = "parquet",
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the incremental staging query (``available_now``: process what is there, then stop).

    The table is partitioned by a column of its own (``_PARTITIONDATE``): the day of ``partition_col``, or
    the ingestion day for rows without one (a long-running query must not fail for them) and when no
    column is named. The schema's columns are written as staged; a NULL date stays NULL."""
    reader = spark.readStream.schema(raw_schema(fields)).format(source_format)
    if source_format == "csv":
        reader = reader.option("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    staged = stage(reader.load(source_dir), fields, on_error=on_error)
    day = F.current_date()
    if partition_col not in (None, NO_PARTITION_COLUMN):
        day = F.coalesce(F.col(partition_col).cast("date"), day)
    writer = (staged.withColumn(INGESTION_DAY, day).writeStream.format("parquet").partitionBy(INGESTION_DAY)
              .option("checkpointLocation", checkpoint or shared_dir(spark, "staging-stream-ckpt"))
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(output)
