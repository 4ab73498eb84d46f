"""DuckDB SQL twins of the registered queries (the correctness oracle).

The raw-string derivations mirror ``testdata.py`` (``strftime`` where Spark uses ``date_format``);
the typed parses, the reset rule and the schemas are modelled here on their own.
"""

from __future__ import annotations

# ---- schemas of the staged tables ------------------------------------------------------------------
ORDER_FIELDS = [
    ("o_orderkey", "INTEGER"), ("o_custkey", "LONG"), ("o_orderstatus", "STRING"), ("o_totalprice", "NUMERIC"),
    ("o_orderdate", "DATE"), ("record_load_ts", "TIMESTAMP"), ("o_orderpriority", "STRING"), ("is_urgent", "BOOLEAN"),
    ("order_ts", "TIMESTAMP"), ("order_dt", "DATETIME"), ("price_f", "FLOAT"), ("order_clock", "TIME"),
]

LINEITEM_FIELDS = [
    ("l_orderkey", "INTEGER"), ("l_linenumber", "INTEGER"), ("l_quantity", "NUMERIC"), ("l_extendedprice", "FLOAT"),
    ("l_returnflag", "STRING"), ("l_shipdate", "DATE"), ("record_load_ts", "TIMESTAMP"), ("l_shipday", "DATETIME"),
]

# ---- raw-string derivations (DuckDB dialect) -------------------------------------------------
RAW_INTEGER = """CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(o_orderkey AS VARCHAR)
  WHEN '2-HIGH' THEN '+' || CAST(o_custkey AS VARCHAR)
  WHEN '3-MEDIUM' THEN ' ' || CAST(o_orderkey AS VARCHAR) || ' '
  WHEN '4-NOT SPECIFIED' THEN CAST(o_orderkey AS VARCHAR) || '.7'
  ELSE CASE o_orderstatus
    WHEN 'F' THEN '-' || CAST(o_orderkey AS VARCHAR)
    WHEN 'O' THEN CAST(o_orderkey AS VARCHAR) || '9999999999999999999'
    ELSE NULL END
END"""

RAW_BOOLEAN = """CASE o_orderpriority
  WHEN '1-URGENT' THEN 'true' WHEN '2-HIGH' THEN 'TRUE' WHEN '3-MEDIUM' THEN 'yes'
  WHEN '4-NOT SPECIFIED' THEN '1'
  ELSE CASE o_orderstatus WHEN 'F' THEN 'False' WHEN 'O' THEN 'tRuE' ELSE NULL END
END"""

RAW_DATE = """CASE o_orderpriority
  WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%-m-%-d')
  WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y')
  WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m') || '-30'
  ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T10:00'
END"""

RAW_DATETIME = """CASE event_type
  WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
  WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M')
  WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dt%H:%M:%S')
  WHEN 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+01:00'
END"""

RAW_TIMESTAMP = """CASE event_type
  WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'
  WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
  WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dt%H:%M') || 'z'
  WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
  ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-08:00'
END"""

PRICE = "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)"
RAW_FLOAT = f"""CASE l_returnflag
  WHEN 'A' THEN {PRICE}
  WHEN 'N' THEN CASE l_linestatus WHEN 'O' THEN ' ' || {PRICE} || 'd' ELSE {PRICE} || 'e2' END
  ELSE CASE l_linenumber
    WHEN 1 THEN 'NaN' WHEN 2 THEN '-Infinity' WHEN 3 THEN 'nan' WHEN 4 THEN '1e400'
    WHEN 5 THEN '.' || CAST(l_partkey AS VARCHAR) WHEN 6 THEN {PRICE} || 'F'
    ELSE CASE l_linestatus WHEN 'F' THEN ' -0x' || CAST(l_partkey AS VARCHAR) || '.8cP-3d' ELSE {PRICE} || 'x' END END
END"""

RAW_NUMERIC = f"""CASE l_returnflag
  WHEN 'A' THEN {PRICE}
  WHEN 'N' THEN CASE l_linestatus WHEN 'O' THEN {PRICE} || 'E-3' ELSE ' ' || {PRICE} END
  ELSE CASE l_linenumber
    WHEN 1 THEN '.' || CAST(l_partkey AS VARCHAR) WHEN 2 THEN CAST(l_partkey AS VARCHAR) || '.'
    WHEN 3 THEN '1' || repeat('0', 40) WHEN 4 THEN '-' || {PRICE} || '12345678'
    WHEN 5 THEN '+' || {PRICE} || 'e+2' WHEN 6 THEN '-0.00E' || CAST(l_partkey AS VARCHAR)
    ELSE 'abc' END
END"""

RAW_TIME = """CASE event_type
  WHEN 'click' THEN strftime(ts, '%H:%M:%S')
  WHEN 'view' THEN CAST(hour(ts) + 24 AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) || ':' || CAST(second(ts) AS VARCHAR)
  WHEN 'purchase' THEN CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR)
  WHEN 'signup' THEN '-' || CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) + 60 AS VARCHAR) || ':' || CAST(second(ts) AS VARCHAR)
  ELSE CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) || ':' || CAST(second(ts) AS VARCHAR) || ':1'
END"""

SESSION_LINE = (
    "concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, props, "
    "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), "
    "right(CAST(user_id AS VARCHAR), 1))"
)
SESSION_RECODED = (
    "concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type, props, "
    "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'), "
    "CASE right(CAST(user_id AS VARCHAR), 1) WHEN '1' THEN 'M' WHEN '2' THEN 'F' "
    "ELSE right(CAST(user_id AS VARCHAR), 1) END)"
)

_CLOCK = "CAST(dayofmonth(o_orderdate) AS VARCHAR) || ':' || CAST(month(o_orderdate) AS VARCHAR) || ':0'"
_PRICE_O = "CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR)"
RAW_ORDERS_CLEAN = {
    "o_orderkey": "CAST(o_orderkey AS VARCHAR)",
    "o_custkey": "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus": "o_orderstatus",
    "o_totalprice": _PRICE_O,
    "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d')",
    "o_orderpriority": "o_orderpriority",
    "is_urgent": "CASE WHEN o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'false' END",
    "order_ts": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+02:00'",
    "order_dt": "strftime(o_orderdate, '%Y-%m-%dT%H:%M')",
    "price_f": _PRICE_O,
    "order_clock": _CLOCK,
}
RAW_ORDERS_DIRTY = dict(RAW_ORDERS_CLEAN)
RAW_ORDERS_DIRTY.update({
    "o_orderkey": "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'x' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END",
    "o_orderstatus": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END",
    "o_totalprice": f"CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'n/a' ELSE {_PRICE_O} END",
    "o_orderdate": "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'O' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END",
    "is_urgent": "CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderpriority = '1-URGENT' THEN 'TRUE' ELSE 'false' END",
    "order_ts": "CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+02:00' END",
    "price_f": f"CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'nan' ELSE {_PRICE_O} END",
    "order_clock": f"CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O' THEN '10:20' ELSE {_CLOCK} END",
})
RAW_LINEITEM = {
    "l_orderkey": "CAST(l_orderkey AS VARCHAR)",
    "l_linenumber": "CAST(l_linenumber AS VARCHAR)",
    "l_quantity": "CAST(CAST(l_quantity AS DECIMAL(15,2)) AS VARCHAR)",
    "l_extendedprice": "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR)",
    "l_returnflag": "l_returnflag",
    "l_shipdate": "strftime(l_shipdate, '%Y-%m-%d')",
    "l_shipday": "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S')",
}


# ---- typed parses (DuckDB) ---------------------------------------------------------------------
# The acceptance rules are written out here for DuckDB, from the parsers' documentation; nothing is
# taken from the parsers under test.
_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_CLOCK_RULE = "[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{0,9})?)?"
_DECIMAL = "[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?"
_HEX = "[+-]?0x([0-9a-f]+[.]?[0-9a-f]*|[.][0-9a-f]+)p[+-]?[0-9]+[fd]?"


def _hex_value(t: str) -> str:
    """Value of a lower-case hex float literal: digits by position, then the binary exponent."""
    digits = f"regexp_extract({t}, '^[+-]?0x([0-9a-f.]*)p', 1)"
    whole = f"string_split({digits} || '.', '.')[1]"
    part = f"string_split({digits} || '.', '.')[2]"
    ranks = "list_transform(string_split({0}, ''), lambda c: strpos('0123456789abcdef', c) - 1)"
    total = (f"list_sum(list_transform(range(1, length({whole} || {part}) + 1), lambda i: "
             f"({ranks.format(f'({whole} || {part})')})[i] * pow(16.0, length({whole}) - i)))")
    power = f"CAST(regexp_extract({t}, 'p([+-]?[0-9]+)', 1) AS INTEGER)"
    return f"(CASE WHEN starts_with({t}, '-') THEN -1.0 ELSE 1.0 END * {total} * pow(2.0, {power}))"


def parse_sql(type_name: str, r: str) -> str:
    """DuckDB expression parsing raw string ``r`` as ``type_name`` (NULL on failure). TIMESTAMP is
    rendered as epoch microseconds (time-zone free)."""
    u = f"upper({r})"
    if type_name in ("INTEGER", "LONG"):
        return f"(CASE WHEN regexp_full_match({r}, '[-+]?[0-9]+') THEN TRY_CAST({r} AS BIGINT) END)"
    if type_name == "DATE":
        return f"(CASE WHEN regexp_full_match({r}, '{_DAY}') THEN TRY_CAST({r} AS DATE) END)"
    if type_name == "DATETIME":
        return f"(CASE WHEN regexp_full_match({u}, '{_DAY}T{_CLOCK_RULE}') THEN TRY_CAST({u} AS TIMESTAMP) END)"
    if type_name == "TIMESTAMP":
        fixed = f"regexp_replace({u}, 'T([0-9]{{2}}:[0-9]{{2}})(Z|[+-].*)$', 'T\\1:00\\2')"
        return (f"(CASE WHEN regexp_full_match({u}, '{_DAY}T{_CLOCK_RULE}(Z|[+-][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}})?)') "
                f"THEN epoch_us(TRY_CAST({fixed} AS TIMESTAMPTZ)) END)")
    if type_name == "STRING":
        return r
    if type_name == "BOOLEAN":
        return f"coalesce(lower({r}) = 'true', false)"
    if type_name == "FLOAT":
        t = f"trim({r})"
        low = f"lower({t})"
        return (f"(CASE WHEN {t} IN ('NaN', '+NaN', '-NaN') THEN CAST('NaN' AS DOUBLE) "
                f"WHEN {t} IN ('Infinity', '+Infinity') THEN CAST('Infinity' AS DOUBLE) "
                f"WHEN {t} = '-Infinity' THEN CAST('-Infinity' AS DOUBLE) "
                f"WHEN regexp_full_match({low}, '{_DECIMAL}[fd]?') THEN TRY_CAST(rtrim({low}, 'fd') AS DOUBLE) "
                f"WHEN regexp_full_match({low}, '{_HEX}') THEN {_hex_value(low)} END)")
    if type_name == "NUMERIC":
        low = f"lower({r})"
        zero = f"length(replace(replace(regexp_replace({low}, 'e.*', ''), '0', ''), '.', '')) = 0"
        unsigned = f"ltrim({low}, '+-')"
        return (f"(CASE WHEN regexp_full_match({low}, '{_DECIMAL}') THEN CASE WHEN {zero.replace(low, unsigned)} "
                f"THEN CAST(0 AS DECIMAL(38,9)) ELSE TRY_CAST({r} AS DECIMAL(38,9)) END END)")
    if type_name == "TIME":
        part = [f"TRY_CAST(string_split({r}, ':')[{i}] AS INTEGER)" for i in (1, 2, 3)]
        secs = (f"(((CAST({part[0]} AS BIGINT) * 3600 + CAST({part[1]} AS BIGINT) * 60 "
                f"+ CAST({part[2]} AS BIGINT)) % 86400 + 86400) % 86400)")
        ok = (f"regexp_full_match({r}, '[+-]?[0-9]+:[+-]?[0-9]+:[+-]?[0-9]+') AND "
              + " AND ".join(f"{p} IS NOT NULL" for p in part))
        return (f"(CASE WHEN {ok} THEN printf('%02d:%02d:%02d', {secs} // 3600, ({secs} % 3600) // 60, "
                f"{secs} % 60) END)")
    raise ValueError(type_name)


_CANNOT_FAIL = ("STRING", "BOOLEAN")


def staging_sql(fields: list[tuple[str, str]], raw_exprs: dict[str, str], source: str, on_error: str = "reset") -> str:
    """Oracle for ``stage`` + ``comparable``: typed values, and the reset rule played step by step.

    Step i sets column i; if its value failed, the step clears columns 0..i instead. Each step is a query of
    its own over the one before it."""
    raw_cols = ", ".join(f"{e} AS {n}" for n, e in raw_exprs.items())
    names = ["record_loaded" if n == "record_load_ts" else n for n, _ in fields]
    vals, bad = [], []
    for i, (name, kind) in enumerate(fields):
        if name == "record_load_ts":
            vals.append(f"TRUE AS v{i}")
            bad.append("FALSE")
            continue
        src = name if name in raw_exprs else "CAST(NULL AS VARCHAR)"
        vals.append(f"{parse_sql(kind, src)} AS v{i}")
        bad.append("FALSE" if kind in _CANNOT_FAIL else f"v{i} IS NULL")
    ctes = [f"raw AS (SELECT {raw_cols} FROM {source})", f"s AS (SELECT {', '.join(vals)} FROM raw)"]
    if on_error == "reset":
        last = "s"
        for i, (name, _) in enumerate(fields):
            if bad[i] == "FALSE":
                continue
            cleared = ", ".join(f"CASE WHEN failed THEN NULL ELSE v{j} END AS v{j}" for j in range(i + 1))
            rest = "".join(f", v{j}" for j in range(i + 1, len(fields)))
            ctes.append(f"t{i} AS (SELECT {cleared}{rest} FROM (SELECT *, {bad[i]} AS failed FROM {last}))")
            last = f"t{i}"
    else:
        last = "s"
    outs = [f"coalesce(v{i}, FALSE) AS {n}" if n == "record_loaded" else f"v{i} AS {n}" for i, n in enumerate(names)]
    return f"WITH {', '.join(ctes)} SELECT {', '.join(outs)} FROM {last}"


def cast_sql(type_name: str, raw: str, source: str, key: str) -> str:
    return (f"SELECT {key} AS key, raw, {parse_sql(type_name, 'raw')} AS value "
            f"FROM (SELECT {key}, {raw} AS raw FROM {source})")


# First digits of the scripts whose digits the JVM's integer parsers take (those the queries use).
_OTHER_DIGITS = (0x660, 0x966, 0xFF10)


def cast_digits_sql(raw: str, type_name: str) -> str:
    """The cast of a raw value in which digits of other scripts count as ASCII ones."""
    plain = "raw"
    for first in _OTHER_DIGITS:
        plain = f"translate({plain}, '{''.join(chr(first + i) for i in range(10))}', '0123456789')"
    return (f"SELECT key, raw, {parse_sql(type_name, 'plain')} AS value FROM (SELECT key, raw, {plain} AS plain FROM "
            f"(SELECT o_orderkey AS key, {raw} AS raw FROM orders))")


def group_line_sql(key: str, value: str, source: str, where: str = "") -> str:
    return (f"SELECT {key} AS k, {key} || ':[' || string_agg(CAST({value} AS VARCHAR), ', ' ORDER BY {value}) || ']' AS line "
            f"FROM {source} {where} GROUP BY {key}")


def cogroup_sql(left: tuple[str, str, str], right: tuple[str, str, str], blank_empty: bool = False) -> str:
    """left/right = (key expr, value expr, table)."""
    def side(tag: int) -> str:
        agg = f"string_agg(v, ', ' ORDER BY v) FILTER (WHERE tag = {tag})"
        if blank_empty:
            return f"coalesce('[' || {agg} || ']', '')"
        return f"'[' || coalesce({agg}, '') || ']'"
    (lk, lv, lt), (rk, rv, rt) = left, right
    return (f"WITH u AS (SELECT CAST({lk} AS VARCHAR) AS k, 0 AS tag, CAST({lv} AS VARCHAR) AS v FROM {lt} "
            f"UNION ALL SELECT CAST({rk} AS VARCHAR), 1, CAST({rv} AS VARCHAR) FROM {rt}) "
            f"SELECT k, k || ' : ' || {side(0)} || ';' || {side(1)} AS line FROM u GROUP BY k")


def chunk_sql(key: str, value: str, source: str, size: int) -> str:
    return (f"SELECT k, CAST(r // {size} AS BIGINT) AS chunk, string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) AS txt "
            f"FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY v) - 1 AS r "
            f"FROM (SELECT {key} AS k, {value} AS v FROM {source})) GROUP BY k, r // {size}")
