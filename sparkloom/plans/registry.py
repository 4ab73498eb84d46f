"""The registered queries over the driver's tables (one per operator) and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables. Sink queries write
to a fresh folder under the session's shared checkpoint folder and return the re-read result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom import schema as sch
from sparkloom.functions import casts
from sparkloom.operators import elements, keyed, lines, sketch, staging
from sparkloom.plans import jobs, oracles as O, testdata as D
from sparkloom.session import shared_dir
from sparkloom.sinks import publish, shards, tables, text
from sparkloom.sources import readers

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame, fields: list[sch.Field]) -> DataFrame:
    """Stable rendering of a staged frame: TIMESTAMP -> epoch micros, load time -> 'was set'."""
    cols = []
    for f in fields:
        if f.name == sch.RECORD_LOAD_TS:
            cols.append(F.col(f.name).isNotNull().alias("record_loaded"))
        elif f.type == "TIMESTAMP":
            cols.append(F.unix_micros(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---- keyed ---------------------------------------------------------------------------------------
def q_split_lines(spark, d):
    return keyed.parse_kv_lines(D.lines_of(D.table(spark, d, "orders"), D.PRIORITY_ORDER_LINES))


def q_group_by_key(spark, d):
    kv = keyed.parse_kv_lines(D.lines_of(D.table(spark, d, "orders"), D.PRIORITY_CUST_LINES))
    return keyed.group_lines(kv)


CHUNK_SIZE = 1000


def q_group_by_key_chunks(spark, d):
    """A1 with bounded rows: the group_by_key lists in chunks of at most CHUNK_SIZE values."""
    kv = keyed.parse_kv_lines(D.lines_of(D.table(spark, d, "orders"), D.PRIORITY_CUST_LINES))
    return keyed.group_chunks(kv, chunk_size=CHUNK_SIZE)


def q_sum_per_key(spark, d):
    kv = keyed.parse_kv_lines(D.lines_of(D.table(spark, d, "lineitem"), D.FLAG_PART_LINES))
    return kv.transform(keyed.sum_lines)


def _part_kv(spark, d):
    return keyed.parse_kv_lines(D.lines_of(D.table(spark, d, "part"), D.PART_NAME_LINES))


def q_global_max(spark, d):
    from sparkloom.functions.strings import utf16_length
    return keyed.global_max(_part_kv(spark, d), utf16_length(F.col("k")), "max_len")


def q_key_length(spark, d):
    kv = _part_kv(spark, d)
    return kv.select("k", keyed.key_length(kv))


def q_max_length_filter(spark, d):
    return keyed.group_lines(keyed.filter_by_max_length(_part_kv(spark, d)))


def _nation_inputs(spark, d):
    sup = D.table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("k"), F.col("s_name").alias("v"))
    cus = D.table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("k"), F.col("c_name").alias("v"))
    return {"suppliers": sup, "customers": cus}


def q_cogroup(spark, d):
    return keyed.cogroup_lines(_nation_inputs(spark, d))


def q_cogroup_blank_empty(spark, d):
    return keyed.cogroup_lines(_nation_inputs(spark, d), blank_empty=True)


MULTI_CUTOFF, MULTI_MARKER = 9, "s"


def q_multi_output(spark, d):
    routed = keyed.route_outputs(keyed.group_lines(_part_kv(spark, d)), "k", MULTI_CUTOFF, MULTI_MARKER)
    return routed.select("tag", "k", "line")


# ---- bounded rows: the same groups in chunks -------------------------------------------------------
def q_null_key_chunks(spark, d):
    """A1 bounded, with a NULL key that holds a fifth of the rows."""
    key = F.when(F.col("o_orderpriority") != F.lit("5-LOW"), F.col("o_orderpriority"))
    return keyed.group_chunks(D.table(spark, d, "orders").select(key.alias("k"), F.col("o_custkey").alias("v")), chunk_size=CHUNK_SIZE)


def q_hot_key_chunks(spark, d):
    """A1 bounded, with a key that holds over a third of the rows."""
    rows = D.table(spark, d, "lineitem").select(F.col("l_returnflag").alias("k"), F.col("l_partkey").alias("v"))
    return keyed.group_chunks(rows, chunk_size=CHUNK_SIZE)


COGROUP_CHUNK = 7


def q_cogroup_chunks(spark, d):
    """J1 bounded."""
    return keyed.cogroup_chunks(_nation_inputs(spark, d), chunk_size=COGROUP_CHUNK)


def _routed_chunks(spark, d):
    chunks = keyed.chunk_lines(keyed.group_chunks(_part_kv(spark, d), chunk_size=COGROUP_CHUNK))
    return keyed.route_outputs(chunks, "k", MULTI_CUTOFF, MULTI_MARKER)


def q_multi_output_chunks(spark, d):
    """F5 over chunks."""
    return _routed_chunks(spark, d).select("tag", "k", "chunk", "line")


def q_tagged_sink_chunks(spark, d):
    """K3 over chunks."""
    target = shared_dir(spark, "text-tagged-chunks")
    text.write_tagged(_routed_chunks(spark, d).select("line", "tag"), target, tag="tag", col="line")
    return spark.read.text(target).select("value", F.col("tag").cast("string"))


def q_cogroup_empty_string(spark, d):
    """P9 with a side whose only value is the empty string: it is not an empty side."""
    left = D.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("k"), F.lit("").alias("v"))
    right = D.table(spark, d, "customer").where(F.col("c_nationkey") > F.lit(9)).select(
        F.col("c_nationkey").cast("string").alias("k"), F.col("c_name").alias("v"))
    return keyed.cogroup_lines({"nations": left, "customers": right}, blank_empty=True)


# ---- whole document texts --------------------------------------------------------------------------
def _doc_words(spark, d):
    """(word, doc_id) for every word of every whole text (split on spaces and line breaks)."""
    docs = D.table(spark, d, "documents").select("doc_id", "text")
    words = F.filter(F.split(F.col("text"), D.WORD_SPLIT), lambda w: w != F.lit(""))
    return docs.select(F.explode(words).alias("k"), F.col("doc_id").alias("v"))


def q_word_doc_groups(spark, d):
    """A1/P6 over real text: very common words are hot keys holding a large share of all pairs."""
    return keyed.group_lines(_doc_words(spark, d))


def q_word_counts(spark, d):
    """U1 composite over real text: occurrences per word (partial aggregation absorbs hot words)."""
    counted = _doc_words(spark, d).select("k", F.lit(1).cast("bigint").alias("v"))
    return counted.transform(keyed.sum_lines)


def q_longest_words(spark, d):
    """F4/J2 over real text: the longest words of all documents with the ids of their documents."""
    return keyed.group_lines(keyed.filter_by_max_length(_doc_words(spark, d)))


def q_text_source_lines(spark, d):
    """K1 + S1 with whole multi-line texts: write every document as text, read the lines back."""
    target = shared_dir(spark, "doc-text")
    text.write_lines(D.table(spark, d, "documents").select("text"), target)
    return readers.read_lines(spark, target)


LARGE_WORD = 500


def q_large_keys(spark, d):
    """A1's size sketch over real text: the words that occur often, exactly."""
    return sketch.large_keys(_doc_words(spark, d).select("k"), "k", LARGE_WORD, "n")


# ---- groups of any size as one line each -------------------------------------------------------------
def _list_items(spark, path):
    """The items of lists written as text, one row each: read with the list separator as the line separator, so that no row
    holds a line."""
    items = spark.read.option("lineSep", ", ").text(path)
    return items.select(F.explode(F.split("value", "\n")).alias("value")).where(F.col("value") != F.lit(""))


LINE_SHARDS = 3


def q_group_line_shards(spark, d):
    """A1 + K1: the group_by_key lines, each streamed into a named shard; read back item by item."""
    target = shared_dir(spark, "group-lines")
    kv = keyed.parse_kv_lines(D.lines_of(D.table(spark, d, "orders"), D.PRIORITY_CUST_LINES))
    shards.write_group_lines(kv, target, num_shards=LINE_SHARDS, chunk_size=CHUNK_SIZE, prefix="groups", suffix=".txt")
    return _list_items(spark, target)


def q_word_line_shards(spark, d):
    """A1 + K1 over real text: every word's documents as one line; very common words are long lines."""
    target = shared_dir(spark, "word-lines")
    shards.write_group_lines(_doc_words(spark, d), target, num_shards=LINE_SHARDS, chunk_size=CHUNK_SIZE, prefix="words", suffix=".txt")
    return readers.read_lines(spark, target).groupBy(F.split("value", ":\\[")[0].alias("k")).agg(
        F.sum(F.length("value")).alias("chars"), F.count(F.lit(1)).alias("n_lines"))


def q_cogroup_line_shards(spark, d):
    """J1 + K1: the cogroup lines, streamed; a nation without suppliers has an empty list."""
    target = shared_dir(spark, "cogroup-lines")
    shards.write_cogroup_lines(_nation_inputs(spark, d), target, num_shards=LINE_SHARDS, chunk_size=COGROUP_CHUNK, prefix="nations")
    return _list_items(spark, target)


# ---- delimited lines -------------------------------------------------------------------------------
def _session_lines(spark, d):
    return D.with_line(spark, D.lines_of(D.table(spark, d, "events"), D.SESSION_LINES), jobs.SESSION_HEADER)


def q_skip_header_prefix(spark, d):
    return lines.skip_prefix(_session_lines(spark, d), jobs.SESSION_HEADER_PREFIX)


def q_field_upper(spark, d):
    return lines.field_upper(lines.skip_prefix(_session_lines(spark, d), jobs.SESSION_HEADER_PREFIX), 2)


def q_recode_rows(spark, d):
    return lines.recode_field(lines.skip_prefix(_session_lines(spark, d), jobs.SESSION_HEADER_PREFIX))


def q_field_equals_filter(spark, d):
    src = D.with_line(spark, D.lines_of(D.table(spark, d, "customer"), D.CUSTOMER_CITY_LINES), D.CUSTOMER_HEADER_UPPER)
    return lines.field_equals(src, jobs.CUSTOMER_HEADER, 3, D.CITY)


def q_id_prefix_filter(spark, d):
    src = D.with_line(spark, D.lines_of(D.table(spark, d, "customer"), D.CUSTOMER_ID_LINES), D.CUSTOMER_COMMENT)
    return lines.id_prefix(src, D.ID_PREFIX)


class _RecordsOf(elements.Where):
    """F3 as a user writes it: lines of one record id, no comments."""

    def __init__(self, record_id: str, comment: str = "#"):
        self.record_id, self.comment = record_id, comment

    def keep(self, batch):
        import pyarrow.compute as pc

        line = batch.column("value")
        return pc.and_not(pc.starts_with(line, self.record_id), pc.starts_with(line, self.comment))


def q_user_element_filter(spark, d):
    """The id_prefix_filter rows by a user-written element function."""
    src = D.with_line(spark, D.lines_of(D.table(spark, d, "customer"), D.CUSTOMER_ID_LINES), D.CUSTOMER_COMMENT)
    return elements.apply_elements(src, _RecordsOf(D.ID_PREFIX))


class _Words(elements.EachRow):
    """(doc_id, text) to (doc_id, n, word): none or many rows for each."""

    def __init__(self, shortest: int):
        self.shortest = shortest

    def analyze(self, schema):
        from pyspark.sql.types import LongType, StringType, StructType

        return StructType([schema["doc_id"]]).add("n", LongType()).add("word", StringType())

    def process(self, batch):
        import pyarrow as pa
        import pyarrow.compute as pc

        words = pc.split_pattern_regex(pc.fill_null(batch.column("text"), ""), "[ \t\n\r]+")
        row, flat = pc.list_parent_indices(words), pc.list_flatten(words)
        first = words.offsets.take(row)
        long = pc.greater_equal(pc.utf8_length(flat), self.shortest)
        n = pc.subtract(pa.array(range(len(flat)), pa.int64()), pc.subtract(first, words.offsets[0]).cast(pa.int64()))
        cells = [batch.column("doc_id").take(row), n, flat]
        return pa.RecordBatch.from_arrays([c.filter(long) for c in cells], names=["doc_id", "n", "word"])


LONG_WORD = 12


def q_user_element_expand(spark, d):
    """U2, one row to none or many: the long words of every text and their places."""
    return elements.apply_elements(D.table(spark, d, "documents").select("doc_id", "text"), _Words(LONG_WORD))


def q_project_field(spark, d):
    customers = D.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    return lines.project(customers, "name")


# ---- typed parses ---------------------------------------------------------------------------------
def _cast_query(type_name: str, table: str, key: str, raw: str, render=None) -> Query:
    def q(spark, d):
        src = D.table(spark, d, table).select(F.col(key).alias("key"), F.expr(raw).alias("raw"))
        value = casts.parse_as(F.col("raw"), type_name)
        if render is not None:
            value = render(value)
        return src.select("key", "raw", value.alias("value"))
    return q


q_cast_integer = _cast_query("INTEGER", "orders", "o_orderkey", D.RAW_INTEGER)
q_cast_boolean = _cast_query("BOOLEAN", "orders", "o_orderkey", D.RAW_BOOLEAN)
q_cast_date = _cast_query("DATE", "orders", "o_orderkey", D.RAW_DATE)
q_cast_datetime = _cast_query("DATETIME", "events", "event_id", D.RAW_DATETIME)
q_cast_timestamp = _cast_query("TIMESTAMP", "events", "event_id", D.RAW_TIMESTAMP, F.unix_micros)
def q_cast_float(spark, d):
    """FLOAT parse; NaN is reported as a flag (NaN never equals itself, so no value hash can match it)."""
    parsed = _cast_query("FLOAT", "lineitem", "l_orderkey", D.RAW_FLOAT)(spark, d)
    nan = F.isnan(F.col("value"))
    return parsed.select("key", "raw", F.when(~nan, F.col("value")).alias("value"),
                         F.coalesce(nan, F.lit(False)).alias("is_nan"))
q_cast_numeric = _cast_query("NUMERIC", "lineitem", "l_orderkey", D.RAW_NUMERIC)
q_cast_time = _cast_query("TIME", "events", "event_id", D.RAW_TIME)


def _in_digits(source: str, first: int) -> str:
    return f"translate({source}, '0123456789', '{''.join(chr(first + i) for i in range(10))}')"


# Raw values in Arabic-Indic, Devanagari and full-width digits (digits to the JVM's parsers) and in mathematical ones (not).
_SCRIPTS = {"F": 0x660, "O": 0x966}
_FULL_WIDTH, _MATHEMATICAL = 0xFF10, 0x1D7CE


def _digits_raw(value: str, text_type: str) -> str:
    plain = f"CAST({value} AS {text_type})"
    return (f"CASE WHEN o_orderpriority = '5-LOW' THEN {_in_digits(plain, _MATHEMATICAL)} "
            + " ".join(f"WHEN o_orderstatus = '{s}' THEN concat('-', {_in_digits(plain, c)}, '7')" for s, c in _SCRIPTS.items())
            + f" ELSE {_in_digits(plain, _FULL_WIDTH)} END")


def q_cast_integer_digits(spark, d):
    """Digits of other scripts."""
    return _cast_query("INTEGER", "orders", "o_orderkey", _digits_raw("o_custkey", "STRING"))(spark, d)


def _clock_raw(text_type: str) -> str:
    parts = (f"CAST(o_orderkey % 30 AS {text_type})", f"CAST(o_custkey % 70 AS {text_type})", f"CAST(o_orderkey % 7 AS {text_type})")
    clock = f"concat({parts[0]}, ':', {parts[1]}, ':', {parts[2]})"
    return f"CASE WHEN o_orderstatus = 'F' THEN {_in_digits(clock, 0x660)} WHEN o_orderstatus = 'O' THEN {_in_digits(clock, _MATHEMATICAL)} ELSE {clock} END"


def q_cast_time_digits(spark, d):
    """Digits of other scripts."""
    return _cast_query("TIME", "orders", "o_orderkey", _clock_raw("STRING"))(spark, d)


# ---- staging ----------------------------------------------------------------------------------------
def _staged_orders(spark, d, raw_exprs, on_error="reset"):
    raw = D.raw_frame(D.table(spark, d, "orders"), raw_exprs)
    return staging.stage(raw, D.ORDER_FIELDS, on_error=on_error)


def q_staging_reset_on_error(spark, d):
    return comparable(_staged_orders(spark, d, D.RAW_ORDERS_DIRTY), D.ORDER_FIELDS)


def q_staging_typed(spark, d):
    fields = sch.from_json_text(_order_schema_json())
    raw = D.raw_frame(D.table(spark, d, "orders"), D.RAW_ORDERS_CLEAN)
    return comparable(staging.stage(raw, fields), fields)


def q_staging_strict(spark, d):
    fields = [f for f in D.ORDER_FIELDS if f.type != "TIME"]
    raw = D.raw_frame(D.table(spark, d, "orders"), D.RAW_ORDERS_CLEAN)
    return comparable(staging.stage(raw, fields, on_error="strict"), fields)


def q_staging_schema_string(spark, d):
    fields = sch.from_pipe_string(D.LINEITEM_SCHEMA_STRING)
    raw = D.raw_frame(D.table(spark, d, "lineitem"), D.RAW_LINEITEM)
    return comparable(staging.stage(raw, fields), fields)


def q_load_timestamp(spark, d):
    staged = _staged_orders(spark, d, D.RAW_ORDERS_CLEAN)
    return staged.select("o_orderkey", F.col("record_load_ts").isNotNull().alias("record_loaded"))


STAGING_TABLE = "staging.orders"


def q_partition_id(spark, d):
    staged = _staged_orders(spark, d, D.RAW_ORDERS_CLEAN)
    return (staged.select(tables.partition_id(STAGING_TABLE, F.col("o_orderdate")).alias("partition_id"))
            .groupBy("partition_id").agg(F.count(F.lit(1)).alias("n")))


def _order_schema_json() -> str:
    import json
    return json.dumps([{"name": f.name, "type": f.type, "fields": []} for f in D.ORDER_FIELDS])


# ---- sources ----------------------------------------------------------------------------------------
def q_table_source(spark, d):
    return readers.read_table(spark, table=f"{d.rstrip('/')}/orders.parquet")


def _unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _catalog_table(spark, df, name: str, partition_by: tuple = ()) -> str:
    """A new catalog table with ``df``'s rows, its files in the shared folder."""
    table = _unique(name)
    df.write.option("path", shared_dir(spark, table)).partitionBy(*partition_by).saveAsTable(table)
    return table


def q_catalog_source(spark, d):
    """S3, catalog branch: the orders as a catalog table, read by name."""
    return readers.read_table(spark, table=_catalog_table(spark, D.table(spark, d, "orders"), "orders"))


SOURCE_QUERY = ("SELECT o_orderpriority, count(*) AS n, "
                "CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS total "
                "FROM orders GROUP BY o_orderpriority")


def q_sql_query_source(spark, d):
    view = _unique("orders")  # never a name that the caller may use
    D.table(spark, d, "orders").createOrReplaceTempView(view)
    return readers.read_table(spark, query=SOURCE_QUERY.replace("FROM orders", f"FROM {view}"))


def q_pruned_source(spark, d):
    fields = [sch.Field("o_orderkey", "INTEGER"), sch.Field("record_load_ts", "TIMESTAMP"),
              sch.Field("o_custkey", "INTEGER"), sch.Field("o_orderstatus", "STRING")]
    return readers.read_pruned(spark, f"{d.rstrip('/')}/orders.parquet", fields)


# ---- sinks --------------------------------------------------------------------------------------------
_SINK_COLS = ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


def q_partition_overwrite(spark, d):
    target = shared_dir(spark, "staging-orders")
    first = _staged_orders(spark, d, D.RAW_ORDERS_CLEAN).select(*_SINK_COLS)
    tables.write_day_partitions(first, target, "o_orderdate")
    second = (_staged_orders(spark, d, D.RAW_ORDERS_CLEAN).where(F.col("o_orderstatus") == F.lit("F"))
              .select("o_orderkey", "o_orderstatus", F.concat(F.lit("R-"), "o_orderpriority").alias("o_orderpriority"),
                      "o_orderdate"))
    tables.write_day_partitions(second, target, "o_orderdate")
    out = readers.read_partitioned(spark, target)
    return out.select("o_orderkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date"))


def q_ingestion_partition(spark, d):
    target = shared_dir(spark, "staging-ingest")
    staged = _staged_orders(spark, d, D.RAW_ORDERS_CLEAN).select("o_orderkey", "o_orderstatus")
    tables.write_day_partitions(staged, target, tables.NO_PARTITION_COLUMN)
    out = spark.read.parquet(target)
    return out.select("o_orderkey", (F.col(tables.INGESTION_DAY).cast("date") == F.current_date()).alias("is_today"))


def _parts(spark, d):
    return D.table(spark, d, "part").select("p_partkey", "p_name", "p_size")


def q_table_sink_append(spark, d):
    target = shared_dir(spark, "part-append")
    tables.write_table(_parts(spark, d), target, write="append")
    tables.write_table(_parts(spark, d), target, write="append", create="never")
    return spark.read.parquet(target)


def q_table_sink_truncate(spark, d):
    target = shared_dir(spark, "part-truncate")
    tables.write_table(_parts(spark, d), target, write="empty")
    tables.write_table(_parts(spark, d).where(F.col("p_size") > F.lit(25)), target, write="truncate", create="never")
    return spark.read.parquet(target)


def q_table_sink_truncate_partitioned(spark, d):
    """K4 truncate of a partitioned table, in a session that overwrites partitions dynamically."""
    target = shared_dir(spark, "part-truncate-days")
    sizes = D.table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, "static")
    spark.conf.set(key, "dynamic")
    try:
        tables.write_table(sizes, target, write="append", partition_by=["p_size"])
        tables.write_table(sizes.where(F.col("p_size") > F.lit(25)), target, write="truncate", partition_by=["p_size"])
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(target).select("p_partkey", "p_name", F.col("p_size").cast("long"))


def q_catalog_sink(spark, d):
    """K4 on a catalog table: append, then truncate."""
    table = _catalog_table(spark, _parts(spark, d), "parts")
    tables.write_table(_parts(spark, d), table, write="append", create="never")
    tables.write_table(_parts(spark, d).where(F.col("p_size") > F.lit(25)), table, write="truncate", create="never")
    tables.write_table(_parts(spark, d), table, write="append", create="never")
    return spark.read.table(table)


def _months(spark, d, label: str):
    day = F.trunc("o_orderdate", "month").alias("month")
    return D.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.lit(label).alias("load"), day)


def q_catalog_partition_overwrite(spark, d):
    """K5 on a catalog table: only the partitions of the second load are replaced."""
    table = _catalog_table(spark, _months(spark, d, "first"), "months", ("month",))
    second = _months(spark, d, "second").where(F.col("month") < F.lit("1995-01-01").cast("date"))
    tables.write_day_partitions(second.where(F.col("o_orderstatus") == F.lit("F")), table, "month")
    return spark.read.table(table).select("o_orderkey", "o_orderstatus", "load", "month")


def q_partition_divert(spark, d):
    """K5 with rows that have no day: they go to the reject folder of the load; a retry doubles nothing."""
    target, reject = shared_dir(spark, "months"), shared_dir(spark, "rejects")
    rows = _months(spark, d, "x").withColumn("month", F.when(F.col("o_orderstatus") != F.lit("P"), F.col("month")))
    for _ in range(2):
        tables.write_day_partitions(rows, target, "month", on_null="divert", reject_target=reject, load_id="a")
    kept = spark.read.parquet(target).select("o_orderkey", F.col("month").cast("date"), F.lit(False).alias("rejected"))
    return kept.unionByName(spark.read.parquet(reject).select("o_orderkey", F.col("month").cast("date"), F.lit(True).alias("rejected")))


def q_header_null_lines(spark, d):
    """K2 over lines of which some are NULL: every shard starts with the header."""
    target = shared_dir(spark, "text-header-null")
    line = F.when(F.col("c_mktsegment") == F.lit(D.CITY), F.col("c_name")).alias("value")
    text.write_lines(D.table(spark, d, "customer").select(line), target, header="name", num_shards=HEADER_SHARDS)
    return readers.read_lines(spark, target)


SEGMENT_SHARDS = 16


def q_named_shards(spark, d):
    """K1/K2: lines dealt by market segment into sixteen named shards, most of them empty; every one has the header."""
    target = shared_dir(spark, "named")
    src = D.table(spark, d, "customer").select("c_mktsegment", F.concat_ws(",", "c_mktsegment", "c_name").alias("value"))
    shards.write_named_lines(src, target, prefix="customers", suffix=".csv", col="value", by="c_mktsegment", num_shards=SEGMENT_SHARDS, header="segment,name")
    lines_ = spark.read.text(target).select(F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("file"), "value")
    heads = lines_.where(F.col("value") == F.lit("segment,name"))
    return heads.unionByName(lines_.where(F.col("value") != F.lit("segment,name")).select(F.lit("").alias("file"), "value"))


def q_routed_tables(spark, d):
    """K7: orders to the table (finished ones: to the month) that each names, twice; the second load replaces months and adds to the rest."""
    root = shared_dir(spark, "routed")
    month = F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd")
    to = (F.when(F.col("o_orderstatus") == F.lit("F"), F.concat(F.lit("finished$"), month))
          .when(F.col("o_orderstatus") == F.lit("O"), F.lit("open")).otherwise(F.lit("pending")))
    orders = D.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    how = {"finished": "truncate", "open": "append", "pending": "append"}
    publish.write_routed(orders.withColumn("load", F.lit("first")), to, root, write="empty", day_col="month")
    again = orders.where((F.col("o_orderstatus") == F.lit("P")) | (F.year("o_orderdate") < F.lit(1995)))
    publish.write_routed(again.withColumn("load", F.lit("second")), to, root, write=how, create="never", day_col="month")
    tables_ = [spark.read.parquet(f"{root}/{t}").select("o_orderkey", "load", F.lit(t).alias("tab")) for t in ("finished", "open", "pending")]
    return tables_[0].unionByName(tables_[1]).unionByName(tables_[2])


def q_text_roundtrip(spark, d):
    target = shared_dir(spark, "text-lines")
    src = D.lines_of(D.table(spark, d, "customer"), "concat_ws(',', CAST(c_custkey AS STRING), c_name)")
    text.write_lines(src, target)
    return readers.read_lines(spark, target)


HEADER_SHARDS = 4


def q_header_roundtrip(spark, d):
    target = shared_dir(spark, "text-header")
    recoded = q_recode_rows(spark, d)
    text.write_lines(recoded, target, header=jobs.SESSION_HEADER, num_shards=HEADER_SHARDS)
    return readers.read_lines(spark, target)


def q_tagged_sink(spark, d):
    target = shared_dir(spark, "text-tagged")
    routed = q_multi_output(spark, d)
    text.write_tagged(routed.select("line", "tag"), target, tag="tag", col="line")
    return spark.read.text(target).select("value", F.col("tag").cast("string"))


def q_incremental_staging(spark, d):
    """Structured Streaming form of the staging load: the raw orders arrive as two file batches
    (finished orders first, then the rest); each run of the stager picks up only the new files
    (checkpointed file source + file sink = exactly once). Result = one staging of all orders."""
    from sparkloom.streaming.staging_stream import start_staging_stream

    src, out, ckpt = shared_dir(spark, "raw-orders"), shared_dir(spark, "staged-orders"), shared_dir(spark, "ckpt")
    raw = D.raw_frame(D.table(spark, d, "orders"), D.RAW_ORDERS_CLEAN)
    for batch, cond in (("b1", F.col("o_orderstatus") == F.lit("F")), ("b2", F.col("o_orderstatus") != F.lit("F"))):
        raw.where(cond).write.parquet(f"{src}/{batch}")
        start_staging_stream(spark, source_dir=f"{src}/*", fields=D.ORDER_FIELDS, output=out,
                             partition_col=tables.NO_PARTITION_COLUMN, checkpoint=ckpt).awaitTermination()
    return comparable(spark.read.parquet(out).drop(tables.INGESTION_DAY), D.ORDER_FIELDS)


def q_incremental_staging_no_day(spark, d):
    """The stream form with rows that have no partition date: the date stays NULL in the table."""
    from sparkloom.streaming.staging_stream import start_staging_stream

    src, out = shared_dir(spark, "raw-orders"), shared_dir(spark, "staged-orders")
    D.raw_frame(D.table(spark, d, "orders"), D.RAW_ORDERS_DIRTY).write.parquet(f"{src}/b1")
    start_staging_stream(spark, source_dir=f"{src}/*", fields=D.ORDER_FIELDS, output=out, partition_col="o_orderdate",
                         checkpoint=shared_dir(spark, "ckpt")).awaitTermination()
    return comparable(spark.read.parquet(out).drop(tables.INGESTION_DAY), D.ORDER_FIELDS)


QUERIES: dict[str, Query] = {
    "split_lines": q_split_lines,
    "word_doc_groups": q_word_doc_groups,
    "word_counts": q_word_counts,
    "longest_words": q_longest_words,
    "text_source_lines": q_text_source_lines,
    "group_by_key": q_group_by_key,
    "group_by_key_chunks": q_group_by_key_chunks,
    "sum_per_key": q_sum_per_key,
    "global_max": q_global_max,
    "key_length": q_key_length,
    "max_length_filter": q_max_length_filter,
    "cogroup": q_cogroup,
    "cogroup_blank_empty": q_cogroup_blank_empty,
    "multi_output": q_multi_output,
    "skip_header_prefix": q_skip_header_prefix,
    "field_upper": q_field_upper,
    "recode_rows": q_recode_rows,
    "field_equals_filter": q_field_equals_filter,
    "id_prefix_filter": q_id_prefix_filter,
    "project_field": q_project_field,
    "cast_integer": q_cast_integer,
    "cast_boolean": q_cast_boolean,
    "cast_date": q_cast_date,
    "cast_datetime": q_cast_datetime,
    "cast_timestamp": q_cast_timestamp,
    "cast_float": q_cast_float,
    "cast_numeric": q_cast_numeric,
    "cast_time": q_cast_time,
    "staging_reset_on_error": q_staging_reset_on_error,
    "staging_typed": q_staging_typed,
    "staging_strict": q_staging_strict,
    "staging_schema_string": q_staging_schema_string,
    "load_timestamp": q_load_timestamp,
    "partition_id": q_partition_id,
    "table_source": q_table_source,
    "sql_query_source": q_sql_query_source,
    "pruned_source": q_pruned_source,
    "partition_overwrite": q_partition_overwrite,
    "ingestion_partition": q_ingestion_partition,
    "table_sink_append": q_table_sink_append,
    "table_sink_truncate": q_table_sink_truncate,
    "text_roundtrip": q_text_roundtrip,
    "header_roundtrip": q_header_roundtrip,
    "tagged_sink": q_tagged_sink,
    "incremental_staging": q_incremental_staging,
    "incremental_staging_no_day": q_incremental_staging_no_day,
    "null_key_chunks": q_null_key_chunks,
    "hot_key_chunks": q_hot_key_chunks,
    "cogroup_chunks": q_cogroup_chunks,
    "multi_output_chunks": q_multi_output_chunks,
    "tagged_sink_chunks": q_tagged_sink_chunks,
    "cogroup_empty_string": q_cogroup_empty_string,
    "header_null_lines": q_header_null_lines,
    "table_sink_truncate_partitioned": q_table_sink_truncate_partitioned,
    "catalog_source": q_catalog_source,
    "catalog_sink": q_catalog_sink,
    "catalog_partition_overwrite": q_catalog_partition_overwrite,
    "partition_divert": q_partition_divert,
    "large_keys": q_large_keys,
    "group_line_shards": q_group_line_shards,
    "word_line_shards": q_word_line_shards,
    "cogroup_line_shards": q_cogroup_line_shards,
    "user_element_filter": q_user_element_filter,
    "user_element_expand": q_user_element_expand,
    "cast_integer_digits": q_cast_integer_digits,
    "cast_time_digits": q_cast_time_digits,
    "named_shards": q_named_shards,
    "routed_tables": q_routed_tables,
}


# ---- oracles ------------------------------------------------------------------------------------------
_PART_GROUPS = O.group_line_sql("p_name", "p_partkey", "part")
_MULTI = (f"WITH g AS ({_PART_GROUPS}) "
          f"SELECT 'below' AS tag, k, line FROM g WHERE length(k) < {MULTI_CUTOFF} "
          f"UNION ALL SELECT 'above' AS tag, k, line FROM g WHERE length(k) >= {MULTI_CUTOFF} "
          f"UNION ALL SELECT 'marker' AS tag, k, line FROM g WHERE starts_with(lower(k), '{MULTI_MARKER}')")
_MULTI_CHUNKS = (f"WITH g AS (SELECT *, k || ':' || CAST(chunk AS VARCHAR) || ':[' || txt || ']' AS line "
                 f"FROM ({O.chunk_sql('p_name', 'p_partkey', 'part', COGROUP_CHUNK)})) "
                 f"SELECT 'below' AS tag, k, chunk, line FROM g WHERE length(k) < {MULTI_CUTOFF} "
                 f"UNION ALL SELECT 'above', k, chunk, line FROM g WHERE length(k) >= {MULTI_CUTOFF} "
                 f"UNION ALL SELECT 'marker', k, chunk, line FROM g WHERE starts_with(lower(k), '{MULTI_MARKER}')")
_COGROUP_CHUNKS = " UNION ALL ".join(
    f"SELECT k, '{tag}' AS tag, chunk, txt FROM ({O.chunk_sql(f'CAST({k} AS VARCHAR)', v, t, COGROUP_CHUNK)})"
    for tag, k, v, t in (("suppliers", "s_nationkey", "s_name", "supplier"), ("customers", "c_nationkey", "c_name", "customer")))
_NATIONS = (("s_nationkey", "s_name", "supplier"), ("c_nationkey", "c_name", "customer"))
_CITY_LINE = "concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment)"
_ID_LINE = "'CT' || CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || c_mktsegment"
_STRICT_FIELDS = [f for f in O.ORDER_FIELDS if f[1] != "TIME"]
_SINK_FIRST = "SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders"
_SINK_SECOND = ("SELECT o_orderkey, o_orderstatus, 'R-' || o_orderpriority AS o_orderpriority, "
                "CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_orderstatus = 'F'")
_SESSION_DATA = f"SELECT {O.SESSION_RECODED} AS value FROM events"

_WORDS = (f"(SELECT w AS k, doc_id AS v FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '{D.WORD_SPLIT}')) AS w "
          f"FROM documents) WHERE w <> '')")

ORACLE: dict[str, str] = {
    "split_lines": "SELECT o_orderpriority AS k, o_orderkey AS v FROM orders",
    "word_doc_groups": O.group_line_sql("k", "v", _WORDS),
    "word_counts": (f"SELECT k, k || ':' || CAST(count(*) AS VARCHAR) AS line FROM {_WORDS} GROUP BY k"),
    "longest_words": O.group_line_sql("k", "v", _WORDS, f"WHERE length(k) = (SELECT max(length(k)) FROM {_WORDS})"),
    "text_source_lines": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
    "group_by_key": O.group_line_sql("o_orderpriority", "o_custkey", "orders"),
    "group_by_key_chunks": (f"WITH p AS (SELECT o_orderpriority AS k, o_custkey AS v, row_number() OVER "
                            f"(PARTITION BY o_orderpriority ORDER BY o_custkey) - 1 AS r FROM orders) "
                            f"SELECT k, CAST(r // {CHUNK_SIZE} AS BIGINT) AS chunk, "
                            f"string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) AS txt FROM p GROUP BY k, r // {CHUNK_SIZE}"),
    "sum_per_key": ("SELECT l_returnflag || l_linestatus AS k, l_returnflag || l_linestatus || ':' || "
                    "CAST(CAST(sum(l_partkey) AS BIGINT) AS VARCHAR) AS line FROM lineitem "
                    "GROUP BY l_returnflag, l_linestatus"),
    "global_max": "SELECT CAST(max(length(p_name)) AS BIGINT) AS max_len FROM part",
    "key_length": "SELECT p_name AS k, CAST(length(p_name) AS BIGINT) AS n FROM part",
    "max_length_filter": O.group_line_sql("p_name", "p_partkey", "part",
                                          "WHERE length(p_name) = (SELECT max(length(p_name)) FROM part)"),
    "cogroup": O.cogroup_sql(*_NATIONS),
    "cogroup_blank_empty": O.cogroup_sql(*_NATIONS, blank_empty=True),
    "multi_output": _MULTI,
    "skip_header_prefix": f"SELECT {O.SESSION_LINE} AS value FROM events",
    "field_upper": "SELECT upper(event_type) AS value FROM events",
    "recode_rows": _SESSION_DATA,
    "field_equals_filter": f"SELECT {_CITY_LINE} AS value FROM customer WHERE c_mktsegment = '{D.CITY}'",
    "id_prefix_filter": f"SELECT {_ID_LINE} AS value FROM customer WHERE starts_with({_ID_LINE}, '{D.ID_PREFIX}')",
    "project_field": "SELECT c_name AS name FROM customer",
    "cast_integer": O.cast_sql("INTEGER", O.RAW_INTEGER, "orders", "o_orderkey"),
    "cast_boolean": O.cast_sql("BOOLEAN", O.RAW_BOOLEAN, "orders", "o_orderkey"),
    "cast_date": O.cast_sql("DATE", O.RAW_DATE, "orders", "o_orderkey"),
    "cast_datetime": O.cast_sql("DATETIME", O.RAW_DATETIME, "events", "event_id"),
    "cast_timestamp": O.cast_sql("TIMESTAMP", O.RAW_TIMESTAMP, "events", "event_id"),
    "cast_float": (f"SELECT key, raw, CASE WHEN NOT isnan(value) THEN value END AS value, "
                   f"coalesce(isnan(value), false) AS is_nan "
                   f"FROM ({O.cast_sql('FLOAT', O.RAW_FLOAT, 'lineitem', 'l_orderkey')})"),
    "cast_numeric": O.cast_sql("NUMERIC", O.RAW_NUMERIC, "lineitem", "l_orderkey"),
    "cast_time": O.cast_sql("TIME", O.RAW_TIME, "events", "event_id"),
    "staging_reset_on_error": O.staging_sql(O.ORDER_FIELDS, O.RAW_ORDERS_DIRTY, "orders"),
    "staging_typed": O.staging_sql(O.ORDER_FIELDS, O.RAW_ORDERS_CLEAN, "orders"),
    "staging_strict": O.staging_sql(_STRICT_FIELDS, O.RAW_ORDERS_CLEAN, "orders", on_error="strict"),
    "staging_schema_string": O.staging_sql(O.LINEITEM_FIELDS, O.RAW_LINEITEM, "lineitem"),
    "load_timestamp": "SELECT o_orderkey, TRUE AS record_loaded FROM orders",
    "partition_id": (f"SELECT '{STAGING_TABLE}$' || strftime(o_orderdate, '%Y%m%d') AS partition_id, "
                     "CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1"),
    "table_source": "SELECT * FROM orders",
    "sql_query_source": SOURCE_QUERY,
    "pruned_source": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "partition_overwrite": (f"WITH a AS ({_SINK_FIRST}), b AS ({_SINK_SECOND}) "
                            "SELECT * FROM a WHERE o_orderdate NOT IN (SELECT o_orderdate FROM b) "
                            "UNION ALL SELECT * FROM b"),
    "ingestion_partition": "SELECT o_orderkey, TRUE AS is_today FROM orders",
    "table_sink_append": ("SELECT p_partkey, p_name, p_size FROM part UNION ALL "
                          "SELECT p_partkey, p_name, p_size FROM part"),
    "table_sink_truncate": "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 25",
    "text_roundtrip": "SELECT concat_ws(',', CAST(c_custkey AS VARCHAR), c_name) AS value FROM customer",
    "header_roundtrip": (f"{_SESSION_DATA} UNION ALL SELECT '{jobs.SESSION_HEADER}' AS value "
                         f"FROM range({HEADER_SHARDS})"),
    "tagged_sink": f"SELECT line AS value, tag FROM ({_MULTI})",
    "incremental_staging": O.staging_sql(O.ORDER_FIELDS, O.RAW_ORDERS_CLEAN, "orders"),
    "incremental_staging_no_day": O.staging_sql(O.ORDER_FIELDS, O.RAW_ORDERS_DIRTY, "orders"),
    "null_key_chunks": O.chunk_sql("CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END", "o_custkey", "orders", CHUNK_SIZE),
    "hot_key_chunks": O.chunk_sql("l_returnflag", "l_partkey", "lineitem", CHUNK_SIZE),
    "cogroup_chunks": _COGROUP_CHUNKS,
    "multi_output_chunks": _MULTI_CHUNKS,
    "tagged_sink_chunks": f"SELECT line AS value, tag FROM ({_MULTI_CHUNKS})",
    "cogroup_empty_string": ("SELECT CAST(n_nationkey AS VARCHAR) AS k, CAST(n_nationkey AS VARCHAR) || ' : [];' || coalesce('[' || "
                             "(SELECT string_agg(c_name, ', ' ORDER BY c_name) FROM customer WHERE c_nationkey = n_nationkey "
                             "AND c_nationkey > 9) || ']', '') AS line FROM nation"),
    "header_null_lines": (f"SELECT CASE WHEN c_mktsegment = '{D.CITY}' THEN c_name ELSE '' END AS value FROM customer "
                          f"UNION ALL SELECT 'name' FROM range({HEADER_SHARDS})"),
    "table_sink_truncate_partitioned": "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part WHERE p_size > 25",
    "catalog_source": "SELECT * FROM orders",
    "catalog_sink": ("SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 25 UNION ALL "
                     "SELECT p_partkey, p_name, p_size FROM part"),
    "catalog_partition_overwrite": (
        "WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders), "
        "b AS (SELECT * FROM o WHERE month < DATE '1995-01-01' AND o_orderstatus = 'F') "
        "SELECT o_orderkey, o_orderstatus, 'first' AS load, month FROM o WHERE month NOT IN (SELECT month FROM b) "
        "UNION ALL SELECT o_orderkey, o_orderstatus, 'second', month FROM b"),
    "partition_divert": ("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS month, "
                         "o_orderstatus = 'P' AS rejected FROM orders"),
    "large_keys": f"SELECT k, count(*) AS n FROM {_WORDS} GROUP BY k HAVING count(*) > {LARGE_WORD}",
    "group_line_shards": f"SELECT unnest(string_split(line, ', ')) AS value FROM ({O.group_line_sql('o_orderpriority', 'o_custkey', 'orders')})",
    "word_line_shards": f"SELECT k, CAST(sum(length(line)) AS BIGINT) AS chars, count(*) AS n_lines FROM ({O.group_line_sql('k', 'v', _WORDS)}) GROUP BY k",
    "cogroup_line_shards": f"SELECT unnest(string_split(line, ', ')) AS value FROM ({O.cogroup_sql(*_NATIONS)})",
    "user_element_filter": f"SELECT {_ID_LINE} AS value FROM customer WHERE starts_with({_ID_LINE}, '{D.ID_PREFIX}')",
    "user_element_expand": (f"SELECT doc_id, CAST(i - 1 AS BIGINT) AS n, w[i] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM "
                            f"(SELECT doc_id, regexp_split_to_array(text, '[ \\t\\n\\r]+') AS w FROM documents)) WHERE length(w[i]) >= {LONG_WORD}"),
    "cast_integer_digits": O.cast_digits_sql(_digits_raw("o_custkey", "VARCHAR"), "INTEGER"),
    "cast_time_digits": O.cast_digits_sql(_clock_raw("VARCHAR"), "TIME"),
    "named_shards": (f"SELECT printf('customers-%05d-of-%05d.csv', i, {SEGMENT_SHARDS}) AS file, 'segment,name' AS value FROM range({SEGMENT_SHARDS}) r(i) "
                     "UNION ALL SELECT '', c_mktsegment || ',' || c_name FROM customer"),
    "routed_tables": (
        "WITH o AS (SELECT o_orderkey, o_orderstatus AS s, o_orderdate, date_trunc('month', o_orderdate) AS m FROM orders), "
        "again AS (SELECT * FROM o WHERE s = 'P' OR year(o_orderdate) < 1995) "
        "SELECT o_orderkey, 'first' AS load, CASE s WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'pending' END AS tab FROM o "
        "WHERE s <> 'F' OR m NOT IN (SELECT m FROM again WHERE s = 'F') UNION ALL "
        "SELECT o_orderkey, 'second', CASE s WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'pending' END FROM again"),
}
