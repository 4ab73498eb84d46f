"""Staging schemas: an ordered list of (name, TYPE) fields from a JSON file/text or a pipe string.

Parsed once on the driver; only the resulting column expressions ship to executors. Order matters:
it is the output column order and it drives the per-row error-reset rule of ``stage``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from sparkloom.functions.casts import SPARK_TYPES

# Fixed value: the column that is always stamped with the load time instead of being parsed.
RECORD_LOAD_TS = "record_load_ts"


@dataclass(frozen=True)
class Field:
    name: str
    type: str


def from_json_text(text: str) -> list[Field]:
    """JSON array of ``{"name": ..., "type": ..., "fields": [...]}``; only name and type are read."""
    doc = json.loads(text)
    if not isinstance(doc, list):
        raise ValueError("schema JSON must be an array of field objects")
    fields = []
    for i, entry in enumerate(doc):
        if not isinstance(entry, dict) or "name" not in entry or "type" not in entry:
            raise ValueError(f"schema entry {i} needs 'name' and 'type': {entry!r}")
        fields.append(Field(str(entry["name"]), str(entry["type"])))
    return fields


def from_json_file(spark: SparkSession, path: str) -> list[Field]:
    """Read a JSON schema from any Hadoop-visible path (local, HDFS, object store)."""
    rows = spark.read.text(path, wholetext=True).collect()  # one small file -> one row
    if len(rows) != 1:
        raise ValueError(f"{path} must be one schema file, found {len(rows)}")
    return from_json_text(rows[0][0])


def from_pipe_string(spec: str, field_sep: str = "|") -> list[Field]:
    """``id:INTEGER|name:STRING``. Trailing empty entries are ignored (like ``String.split``);
    an entry without ``:`` is an error; a third ``:``-part is ignored."""
    entries = spec.split(field_sep)
    while entries and entries[-1] == "":
        entries.pop()
    fields = []
    for entry in entries:
        parts = entry.split(":")
        while parts and parts[-1] == "":
            parts.pop()
        if len(parts) < 2:
            raise ValueError(f"schema entry {entry!r} is not name:TYPE")
        fields.append(Field(parts[0], parts[1]))
    return fields


def spark_type(field: Field) -> T.DataType:
    if field.name == RECORD_LOAD_TS:
        return T.TimestampType()
    return SPARK_TYPES.get(field.type, T.StringType())


def to_struct(fields: list[Field]) -> T.StructType:
    return T.StructType([T.StructField(f.name, spark_type(f), True) for f in fields])


def raw_projection(fields: list[Field]) -> list[str]:
    """Columns to read from the raw source: the schema minus the load-time column."""
    return [f.name for f in fields if f.name != RECORD_LOAD_TS]
