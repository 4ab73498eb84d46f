"""Inputs derived from the driver's parquet tables for the registered queries.

Every derived input is computed by Spark from whole tables (no sampling, no id subsets): lines
built with ``concat``, all-string "raw" tables built with ``cast``/``date_format``, and bad values
chosen by the data itself (a status/priority/event type), so the work grows with the tables.
Each Spark expression here has a DuckDB twin in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom import schema as sch

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as any input is read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lines_of(df: DataFrame, expr: str) -> DataFrame:
    return df.select(F.expr(expr).alias("value"))


def with_line(spark: SparkSession, lines: DataFrame, line: str) -> DataFrame:
    """``lines`` plus one extra literal line (a header or comment), as in a real text file."""
    return lines.unionByName(spark.range(1).select(F.lit(line).alias("value")))


# ---- keyed text inputs -----------------------------------------------------------------------
PRIORITY_CUST_LINES = "concat(o_orderpriority, ', ', CAST(o_custkey AS STRING))"
PRIORITY_ORDER_LINES = "concat(o_orderpriority, ', ', CAST(o_orderkey AS STRING))"
FLAG_PART_LINES = "concat(l_returnflag, l_linestatus, ', ', CAST(l_partkey AS STRING))"
PART_NAME_LINES = "concat(p_name, ', ', CAST(p_partkey AS STRING))"

# Words of a document: maximal runs of characters other than space and line feed.
WORD_SPLIT = "[ \n]+"

# ---- delimited-line inputs ---------------------------------------------------------------------
SESSION_LINES = (
    "concat_ws(',', CAST(event_id AS STRING), CAST(user_id AS STRING), event_type, props, "
    "CAST(CAST(value AS DECIMAL(12,2)) AS STRING), date_format(ts, 'yyyy-MM-dd HH:mm:ss'), "
    "right(CAST(user_id AS STRING), 1))"
)
CUSTOMER_CITY_LINES = "concat_ws(',', CAST(c_custkey AS STRING), c_name, CAST(c_nationkey AS STRING), c_mktsegment)"
CUSTOMER_ID_LINES = "concat('CT', CAST(c_custkey AS STRING), ',', c_name, ',', c_mktsegment)"
CUSTOMER_HEADER_UPPER = "ID,Name,Last Name,City"
CUSTOMER_COMMENT = "#CT1 id,name,segment"
CITY = "BUILDING"
ID_PREFIX = "CT1"

# ---- typed-parse inputs (raw strings with good and bad forms chosen by the data) -------------------
RAW_INTEGER = """CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(o_orderkey AS STRING)
  WHEN '2-HIGH' THEN concat('+', CAST(o_custkey AS STRING))
  WHEN '3-MEDIUM' THEN concat(' ', CAST(o_orderkey AS STRING), ' ')
  WHEN '4-NOT SPECIFIED' THEN concat(CAST(o_orderkey AS STRING), '.7')
  ELSE CASE o_orderstatus
    WHEN 'F' THEN concat('-', CAST(o_orderkey AS STRING))
    WHEN 'O' THEN concat(CAST(o_orderkey AS STRING), '9999999999999999999')
    ELSE NULL END
END"""

RAW_BOOLEAN = """CASE o_orderpriority
  WHEN '1-URGENT' THEN 'true' WHEN '2-HIGH' THEN 'TRUE' WHEN '3-MEDIUM' THEN 'yes'
  WHEN '4-NOT SPECIFIED' THEN '1'
  ELSE CASE o_orderstatus WHEN 'F' THEN 'False' WHEN 'O' THEN 'tRuE' ELSE NULL END
END"""

RAW_DATE = """CASE o_orderpriority
  WHEN '1-URGENT' THEN date_format(o_orderdate, 'yyyy-MM-dd')
  WHEN '2-HIGH' THEN date_format(o_orderdate, 'yyyy-M-d')
  WHEN '3-MEDIUM' THEN date_format(o_orderdate, 'yyyy')
  WHEN '4-NOT SPECIFIED' THEN concat(date_format(o_orderdate, 'yyyy-MM'), '-30')
  ELSE concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T10:00')
END"""

RAW_DATETIME = """CASE event_type
  WHEN 'click' THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
  WHEN 'view' THEN date_format(ts, "yyyy-MM-dd'T'HH:mm")
  WHEN 'purchase' THEN date_format(ts, "yyyy-MM-dd't'HH:mm:ss")
  WHEN 'signup' THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
  ELSE concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '+01:00')
END"""

RAW_TIMESTAMP = """CASE event_type
  WHEN 'click' THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), 'Z')
  WHEN 'view' THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+05:30')
  WHEN 'purchase' THEN concat(date_format(ts, "yyyy-MM-dd't'HH:mm"), 'z')
  WHEN 'signup' THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
  ELSE concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '-08:00')
END"""

PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING)"
RAW_FLOAT = f"""CASE l_returnflag
  WHEN 'A' THEN {PRICE}
  WHEN 'N' THEN CASE l_linestatus WHEN 'O' THEN concat(' ', {PRICE}, 'd') ELSE concat({PRICE}, 'e2') END
  ELSE CASE l_linenumber
    WHEN 1 THEN 'NaN' WHEN 2 THEN '-Infinity' WHEN 3 THEN 'nan' WHEN 4 THEN '1e400'
    WHEN 5 THEN concat('.', CAST(l_partkey AS STRING)) WHEN 6 THEN concat({PRICE}, 'F')
    ELSE CASE l_linestatus WHEN 'F' THEN concat(' -0x', CAST(l_partkey AS STRING), '.8cP-3d') ELSE concat({PRICE}, 'x') END END
END"""

RAW_NUMERIC = f"""CASE l_returnflag
  WHEN 'A' THEN {PRICE}
  WHEN 'N' THEN CASE l_linestatus WHEN 'O' THEN concat({PRICE}, 'E-3') ELSE concat(' ', {PRICE}) END
  ELSE CASE l_linenumber
    WHEN 1 THEN concat('.', CAST(l_partkey AS STRING)) WHEN 2 THEN concat(CAST(l_partkey AS STRING), '.')
    WHEN 3 THEN concat('1', repeat('0', 40)) WHEN 4 THEN concat('-', {PRICE}, '12345678')
    WHEN 5 THEN concat('+', {PRICE}, 'e+2') WHEN 6 THEN concat('-0.00E', CAST(l_partkey AS STRING))
    ELSE 'abc' END
END"""

RAW_TIME = """CASE event_type
  WHEN 'click' THEN date_format(ts, 'HH:mm:ss')
  WHEN 'view' THEN concat(CAST(hour(ts) + 24 AS STRING), ':', CAST(minute(ts) AS STRING), ':', CAST(second(ts) AS STRING))
  WHEN 'purchase' THEN concat(CAST(hour(ts) AS STRING), ':', CAST(minute(ts) AS STRING))
  WHEN 'signup' THEN concat('-', CAST(hour(ts) AS STRING), ':', CAST(minute(ts) + 60 AS STRING), ':', CAST(second(ts) AS STRING))
  ELSE concat(CAST(hour(ts) AS STRING), ':', CAST(minute(ts) AS STRING), ':', CAST(second(ts) AS STRING), ':1')
END"""

# ---- staging inputs: orders / lineitem as all-string raw tables ------------------------------------
ORDER_FIELDS = [
    sch.Field("o_orderkey", "INTEGER"),
    sch.Field("o_custkey", "LONG"),
    sch.Field("o_orderstatus", "STRING"),
    sch.Field("o_totalprice", "NUMERIC"),
    sch.Field("o_orderdate", "DATE"),
    sch.Field("record_load_ts", "TIMESTAMP"),
    sch.Field("o_orderpriority", "STRING"),
    sch.Field("is_urgent", "BOOLEAN"),
    sch.Field("order_ts", "TIMESTAMP"),
    sch.Field("order_dt", "DATETIME"),
    sch.Field("price_f", "FLOAT"),
    sch.Field("order_clock", "TIME"),
]

# Clean raw orders (every value parses).
RAW_ORDERS_CLEAN = {
    "o_orderkey": "CAST(o_orderkey AS STRING)",
    "o_custkey": "CAST(o_custkey AS STRING)",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)",
    "o_orderdate": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "o_orderpriority": "o_orderpriority",
    "is_urgent": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'false' END",
    "order_ts": "concat(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00')",
    "order_dt": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm\")",
    "price_f": "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING)",
    "order_clock": "concat(CAST(dayofmonth(o_orderdate) AS STRING), ':', CAST(month(o_orderdate) AS STRING), ':0')",
}

# Raw orders with bad values picked by (status, priority) combinations; NULLs included.
RAW_ORDERS_DIRTY = dict(RAW_ORDERS_CLEAN)
RAW_ORDERS_DIRTY.update({
    "o_orderkey": "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN concat('x', CAST(o_orderkey AS STRING)) ELSE CAST(o_orderkey AS STRING) END",
    "o_orderstatus": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END",
    "o_totalprice": "CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END",
    "o_orderdate": "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN NULL ELSE date_format(o_orderdate, 'yyyy-MM-dd') END",
    "is_urgent": "CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'false' END",
    "order_ts": "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") ELSE concat(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\"), '+02:00') END",
    "price_f": "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'nan' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END",
    "order_clock": "CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN '10:20' ELSE concat(CAST(dayofmonth(o_orderdate) AS STRING), ':', CAST(month(o_orderdate) AS STRING), ':0') END",
})

LINEITEM_SCHEMA_STRING = (
    "l_orderkey:INTEGER|l_linenumber:INTEGER|l_quantity:NUMERIC|l_extendedprice:FLOAT|"
    "l_returnflag:STRING|l_shipdate:DATE|record_load_ts:TIMESTAMP|l_shipday:DATETIME"
)
RAW_LINEITEM = {
    "l_orderkey": "CAST(l_orderkey AS STRING)",
    "l_linenumber": "CAST(l_linenumber AS STRING)",
    "l_quantity": "CAST(CAST(l_quantity AS DECIMAL(15,2)) AS STRING)",
    "l_extendedprice": "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING)",
    "l_returnflag": "l_returnflag",
    "l_shipdate": "date_format(l_shipdate, 'yyyy-MM-dd')",
    "l_shipday": "date_format(l_shipdate, \"yyyy-MM-dd'T'HH:mm:ss\")",
}


def raw_frame(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(name) for name, e in exprs.items()])
