"""Sources: text lines, inline rows, tables / parquet paths, SQL queries, schema-pruned reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.schema import Field, raw_projection


def is_path(name: str) -> bool:
    """A table name with a ``/`` is a path, any other one (``raw.json`` too) a catalog name."""
    return "/" in name


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``DataFrame[value: string]``, one row per line (globs, directories and compressed files
    work; the reader splits large files, so a single input file still scans in parallel)."""
    return spark.read.text(path)


def from_rows(spark: SparkSession, rows: Iterable, schema) -> DataFrame:
    """A small driver-side collection as a DataFrame (lookup lists, fixtures)."""
    return spark.createDataFrame(list(rows), schema)


def read_table(spark: SparkSession, table: str | None = None, query: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    """The table if given, else the SQL query, else an error (the documented input rule).

    ``table`` is a catalog name or a path (read as ``fmt``: parquet, orc, json, ...); ``query`` runs
    through ``spark.sql`` against the session's catalog/temp views, so all of Spark SQL is available."""
    if table:
        return spark.read.format(fmt).load(table) if is_path(table) else spark.read.table(table)
    if query:
        return spark.sql(query)
    raise ValueError("either a table or a SQL query must be given")


def read_pruned(spark: SparkSession, table: str, fields: list[Field], fmt: str = "parquet") -> DataFrame:
    """Only the schema's columns (minus the load-time column) are read; Catalyst turns the
    projection into the columnar ``ReadSchema`` so other columns are never decoded."""
    return read_table(spark, table=table, fmt=fmt).select(*raw_projection(fields))


def read_partitioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A path table of very many partition folders. Spark lists each folder in a task of its own; a folder of a few files is
    listed faster than a task starts, so the folders are dealt over as many tasks as run at a time."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return spark.read.format(fmt).load(path)  # the listing happens here
    finally:
        spark.conf.set(key, before)
