"""End-to-end jobs: source -> operators -> sink, parameterised by keyword arguments.

Each job is a thin composition of the library operators (``DataFrame.transform`` style); the plan
is declared lazily and runs once, at the sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom import schema as sch
from sparkloom.operators import keyed, lines, staging
from sparkloom.sinks import tables, text
from sparkloom.sources import readers

# CSV headers of the line jobs, the default city of the city filter, and the default
# length cutoff and marker of the word-routing job.
SESSION_HEADER = "sessionid,userid,username,videoid,duration,starttime,sex"
SESSION_HEADER_PREFIX = "sessionid"
CUSTOMER_HEADER = "id,name,last name,city"
USERNAME_HEADER = "username"
DEFAULT_CITY = "Los Angeles"
DEFAULT_CUTOFF = 5
DEFAULT_MARKER = "s"


def load_fields(spark: SparkSession, schema_json_path: str | None = None, schema_json: str | None = None,
                schema_string: str | None = None) -> list[sch.Field]:
    if schema_json_path:
        return sch.from_json_file(spark, schema_json_path)
    if schema_json:
        return sch.from_json_text(schema_json)
    if schema_string:
        return sch.from_pipe_string(schema_string)
    raise ValueError("a schema (JSON path, JSON text or pipe string) is required")


def staged(spark: SparkSession, fields: list[sch.Field], table: str | None = None, query: str | None = None,
           on_error: str = "reset", prune: bool = True, input_format: str = "parquet") -> DataFrame:
    """Raw -> typed rows (the lazy part of the staging job)."""
    raw = readers.read_table(spark, table=table, query=query, fmt=input_format)
    if prune:
        present = set(raw.columns)
        raw = raw.select(*[c for c in sch.raw_projection(fields) if c in present])
    return staging.stage(raw, fields, on_error=on_error)


def raw_to_staging(spark: SparkSession, *, output: str, table: str | None = None, query: str | None = None,
                   schema_json_path: str | None = None, schema_json: str | None = None,
                   schema_string: str | None = None, partition_col: str | None = tables.NO_PARTITION_COLUMN,
                   on_error: str = "reset", on_null: str = "fail", reject_output: str | None = None,
                   input_format: str = "parquet", output_format: str = "parquet") -> str:
    """The staging load: read the raw table or query, cast by the schema, stamp the load time and
    replace the day partitions present in the batch."""
    fields = load_fields(spark, schema_json_path, schema_json, schema_string)
    out = staged(spark, fields, table=table, query=query, on_error=on_error, input_format=input_format)
    return tables.write_day_partitions(out, output, partition_col, on_null=on_null, reject_target=reject_output,
                                       fmt=output_format)


def raw_to_table(spark: SparkSession, *, output: str, table: str | None = None, query: str | None = None,
                 schema_string: str | None = None, schema_json: str | None = None,
                 schema_json_path: str | None = None, write: str = "append", create: str = "if_needed", on_error: str = "reset",
                 input_format: str = "parquet", output_format: str = "parquet") -> str:
    """Staging into an unpartitioned table with write/create dispositions."""
    fields = load_fields(spark, schema_json_path, schema_json, schema_string)
    rows = staged(spark, fields, table=table, query=query, on_error=on_error, input_format=input_format)
    return tables.write_table(rows, output, write=write, create=create, fmt=output_format)


# ---- keyed text jobs -----------------------------------------------------------------------
def group_words(spark: SparkSession, *, input: str, output: str, num_shards: int | None = None) -> str:
    kv = keyed.parse_kv_lines(readers.read_lines(spark, input))
    return text.write_lines(keyed.group_lines(kv), output, col="line", num_shards=num_shards)


def sum_words(spark: SparkSession, *, input: str, output: str, num_shards: int | None = None) -> str:
    kv = keyed.parse_kv_lines(readers.read_lines(spark, input))
    return text.write_lines(kv.transform(keyed.sum_lines), output, col="line", num_shards=num_shards)


def longest_words(spark: SparkSession, *, input: str, output: str, num_shards: int | None = None,
                  materialize_input: bool = False) -> str:
    kv = keyed.parse_kv_lines(readers.read_lines(spark, input))
    longest = keyed.filter_by_max_length(kv, materialize=materialize_input)
    return text.write_lines(keyed.group_lines(longest), output, col="line", num_shards=num_shards)


def cogroup_pairs(inputs: dict[str, DataFrame], *, output: str, blank_empty: bool = False,
                  num_shards: int | None = None) -> str:
    return text.write_lines(keyed.cogroup_lines(inputs, blank_empty=blank_empty), output, col="line",
                            num_shards=num_shards)


def split_words(spark: SparkSession, *, input: str, output: str, cutoff: int = DEFAULT_CUTOFF,
                marker: str = DEFAULT_MARKER) -> str:
    kv = keyed.parse_kv_lines(readers.read_lines(spark, input))
    routed = keyed.route_outputs(keyed.group_lines(kv), "k", cutoff, marker)
    return text.write_tagged(routed.select("line", "tag"), output, tag="tag", col="line")


# ---- delimited-line jobs -------------------------------------------------------------------
def recode_sessions(spark: SparkSession, *, input: str, output: str, num_shards: int | None = None) -> str:
    data = lines.skip_prefix(readers.read_lines(spark, input), SESSION_HEADER_PREFIX)
    return text.write_lines(lines.recode_field(data), output, header=SESSION_HEADER, num_shards=num_shards)


def upper_usernames(spark: SparkSession, *, input: str, output: str, num_shards: int | None = None) -> str:
    data = lines.skip_prefix(readers.read_lines(spark, input), SESSION_HEADER_PREFIX)
    return text.write_lines(lines.field_upper(data, 2), output, header=USERNAME_HEADER, num_shards=num_shards)


def city_customers(spark: SparkSession, *, input: str, output: str, city: str = DEFAULT_CITY,
                   num_shards: int | None = None) -> str:
    data = lines.field_equals(readers.read_lines(spark, input), CUSTOMER_HEADER, 3, city)
    return text.write_lines(data, output, header=CUSTOMER_HEADER, num_shards=num_shards)


def customer_records(spark: SparkSession, *, input: str, output: str, customer_id: str,
                     num_shards: int | None = None) -> str:
    data = lines.id_prefix(readers.read_lines(spark, input), customer_id)
    return text.write_lines(data, output, num_shards=num_shards)


def customer_names(df: DataFrame, *, output: str, num_shards: int | None = None) -> str:
    return text.write_lines(lines.project(df, "name"), output, num_shards=num_shards)
