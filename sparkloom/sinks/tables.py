"""Table sinks: write/create dispositions, day-partition replacing writes, partition ids.

A target is a catalog table name or a parquet path (anything with a ``/``).
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.session import checkpoint_root
from sparkloom.sinks.publish import publish_partitions, write_if_empty
from sparkloom.sources.readers import is_path as _is_path

WRITE_DISPOSITIONS = ("append", "truncate", "empty")
CREATE_DISPOSITIONS = ("if_needed", "never")
# Fixed value: the column used when rows are routed to the ingestion day (partition option "N/A").
INGESTION_DAY = "_PARTITIONDATE"
NO_PARTITION_COLUMN = "N/A"


_MODE = "partitionOverwriteMode"


def _insert(df: DataFrame, table: str, overwrite: bool, partitions: str) -> None:
    """``insertInto`` under a partition overwrite mode. The mode is a session setting (the writer option
    is ignored for catalog tables): it is set for this write only, in the writer's own session, so two
    threads that share one session must not write to catalog tables at the same time."""
    spark = df.sparkSession
    key = f"spark.sql.sources.{_MODE}"
    before = spark.conf.get(key, None)
    spark.conf.set(key, partitions)
    try:
        df.select(*spark.read.table(table).columns).write.insertInto(table, overwrite=overwrite)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def target_exists(spark: SparkSession, target: str, fmt: str = "parquet") -> bool:
    if not _is_path(target):
        return spark.catalog.tableExists(target)
    try:
        spark.read.format(fmt).load(target).schema
        return True
    except AnalysisException:
        return False


def read_target(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(target) if _is_path(target) else spark.read.table(target)


def write_table(df: DataFrame, target: str, write: str = "append", create: str = "if_needed",
                partition_by: list[str] | None = None, fmt: str = "parquet") -> str:
    """K4: ``append`` adds rows; ``truncate`` replaces the table's content; ``empty`` writes only if
    the target has no rows (path targets: when its rows are ready to be moved in, so of two writers one fails). ``create="never"`` requires the target to exist already. Path targets
    are written as ``fmt``; catalog tables keep their own format. A truncate replaces everything,
    whatever partition overwrite mode the session has."""
    if write not in WRITE_DISPOSITIONS or create not in CREATE_DISPOSITIONS:
        raise ValueError(f"write must be one of {WRITE_DISPOSITIONS}, create one of {CREATE_DISPOSITIONS}")
    spark = df.sparkSession
    exists = target_exists(spark, target, fmt)
    if create == "never" and not exists:
        raise ValueError(f"target {target} does not exist and create disposition is 'never'")
    if write == "empty" and exists and not read_target(spark, target, fmt).isEmpty():
        raise ValueError(f"target {target} is not empty (write disposition 'empty')")
    if write == "empty" and _is_path(target):  # decided again when the rows are there: another writer may have come first
        return write_if_empty(df, target, partition_by, fmt)
    mode = "overwrite" if write == "truncate" else "append"
    if _is_path(target):
        writer = df.write.mode(mode).option(_MODE, "static")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.format(fmt).save(target)
    elif exists:
        _insert(df, target, overwrite=(mode == "overwrite"), partitions="static")
    else:
        writer = df.write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(target)
    return target


def partition_suffix(value: Column) -> Column:
    """K7: the day suffix of a partition value: its text with every ``-`` removed (``2024-01-05``
    -> ``20240105``)."""
    return F.replace(value.cast("string"), F.lit("-"), F.lit(""))


def partition_id(table: str, value: Column) -> Column:
    """K7: ``table$yyyymmdd`` - the destination a row is routed to."""
    return F.concat(F.lit(table + "$"), partition_suffix(value))


def with_ingestion_day(df: DataFrame) -> DataFrame:
    """K6: route every row to today's partition (the query's current date, one value per query)."""
    return df.withColumn(INGESTION_DAY, F.current_date())


def write_day_partitions(df: DataFrame, target: str, partition_col: str | None = NO_PARTITION_COLUMN,
                         on_null: str = "fail", reject_target: str | None = None, fmt: str = "parquet",
                         load_id: str | None = None) -> str:
    """K5/K6: replace exactly the day partitions present in ``df``; untouched days stay.

    * ``partition_col`` must be a DATE column; ``None``/``"N/A"`` routes rows to today's date
      (ingestion-time partitioning).
    * A NULL partition value fails the job (``on_null="fail"``: checked inside the write itself, so
      nothing is committed and no extra pass is needed) or, with ``on_null="divert"``, those rows go
      to the folder ``load=<load_id>`` of ``reject_target``. The input is computed once (reliable
      checkpoint), the table is written first, and the reject folder is overwritten: a load that is
      retried under its ``load_id`` replaces both, it doubles nothing.
    * Rows are rebalanced on the partition column before writing (AQE splits a hot day over several
      tasks and merges small ones), so one task never writes a whole large day and small days do
      not turn into many tiny files. The ingestion day is one value: its rows are rebalanced by size
      only.
    * Path targets are staged and swapped in day by day, in parallel (``sinks.publish``): a load that was killed and is
      run again under its ``load_id`` goes on where it stopped. Catalog targets must exist (create never) and use dynamic
      overwrite by the session setting around ``insertInto`` (the writer option is ignored there).
    """
    spark = df.sparkSession
    one_day = partition_col in (None, NO_PARTITION_COLUMN)
    if one_day:
        df, partition_col = with_ingestion_day(df), INGESTION_DAY
    part_type = dict(df.dtypes).get(partition_col)
    if part_type != "date":
        # Day partitions need a DATE column: a timestamp would give one partition per distinct
        # instant (and an invalid day suffix), a string could hold anything.
        raise TypeError(f"partition column {partition_col} must be DATE, got {part_type}")
    if on_null == "divert":
        if not reject_target:
            raise ValueError("on_null='divert' needs a reject_target")
        checkpoint_root(spark)
        df = df.checkpoint(eager=True)
        rejects = df.where(F.col(partition_col).isNull())
        df = df.where(F.col(partition_col).isNotNull())
    elif on_null == "fail":
        part = F.col(partition_col)
        checked = F.when(part.isNull(), F.raise_error(F.lit(f"NULL value in partition column {partition_col}"))).otherwise(part)
        df = df.withColumn(partition_col, checked)
    else:
        raise ValueError("on_null must be 'fail' or 'divert'")
    if not _is_path(target) and not spark.catalog.tableExists(target):
        raise ValueError(f"table {target} must exist (partitioned writes use create disposition 'never')")
    df = df.hint("rebalance") if one_day else df.hint("rebalance", partition_col)
    if _is_path(target):
        publish_partitions(df, target, partition_col, fmt, load_id)
    else:
        _insert(df, target, overwrite=True, partitions="dynamic")
    if on_null == "divert":
        rejects.write.mode("overwrite").format(fmt).save(f"{reject_target.rstrip('/')}/load={load_id or uuid.uuid4().hex}")
    return target
