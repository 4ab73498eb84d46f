"""sparkloom: schema-driven typed staging and keyed dataflow jobs as Spark DataFrame plans.

Main entry points (all return lazy DataFrames unless they write):

* staging      ``stage(raw, fields, on_error=...)``, ``schema.from_json_text / from_json_file / from_pipe_string``
* keyed        ``parse_kv_lines``, ``group_lines``, ``group_by_key``, ``group_chunks``, ``cogroup_lines``,
               ``cogroup``, ``sum_lines``, ``sum_per_key``, ``global_max``, ``filter_by_max_length``,
               ``route_outputs``, ``large_keys``, ``keep_greatest``
* elements     ``ElementFunction``, ``Where``, ``EachRow``, ``apply_elements`` (user-written, Arrow batches)
* lines        ``skip_prefix``, ``field_equals``, ``id_prefix``, ``field_upper``, ``recode_field``, ``project``
* sources      ``read_lines``, ``read_table``, ``read_partitioned``, ``read_pruned``, ``from_rows``
* sinks        ``write_lines``, ``write_named_lines``, ``write_group_lines``, ``write_cogroup_lines``, ``write_tagged``,
               ``write_table``, ``write_day_partitions``, ``write_routed``, ``partition_id``
* streaming    ``start_staging_stream``
* jobs / CLI   ``sparkloom.plans.jobs``, ``python -m sparkloom.plans.cli``
"""

from sparkloom.operators.argmax import keep_greatest
from sparkloom.operators.elements import EachRow, ElementFunction, Where, apply_elements
from sparkloom.operators.keyed import (
    cogroup,
    cogroup_lines,
    filter_by_max_length,
    global_max,
    group_by_key,
    group_chunks,
    group_lines,
    parse_kv_lines,
    route_outputs,
    sum_lines,
    sum_per_key,
)
from sparkloom.operators.lines import field_equals, field_upper, id_prefix, project, recode_field, skip_prefix
from sparkloom.operators.sketch import large_keys
from sparkloom.operators.staging import split_rejects, stage
from sparkloom.sinks.publish import write_routed
from sparkloom.sinks.shards import write_cogroup_lines, write_group_lines, write_named_lines
from sparkloom.sinks.tables import partition_id, write_day_partitions, write_table
from sparkloom.sinks.text import write_lines, write_tagged
from sparkloom.sources.readers import from_rows, read_lines, read_partitioned, read_pruned, read_table

__all__ = [
    "cogroup", "cogroup_lines", "filter_by_max_length", "global_max", "group_by_key", "group_chunks",
    "group_lines", "parse_kv_lines", "route_outputs", "sum_lines", "sum_per_key",
    "field_equals", "field_upper", "id_prefix", "project", "recode_field", "skip_prefix",
    "split_rejects", "stage",
    "EachRow", "ElementFunction", "Where", "apply_elements", "keep_greatest", "large_keys",
    "partition_id", "write_day_partitions", "write_table", "write_lines", "write_tagged",
    "write_cogroup_lines", "write_group_lines", "write_named_lines", "write_routed",
    "from_rows", "read_lines", "read_partitioned", "read_pruned", "read_table",
]
