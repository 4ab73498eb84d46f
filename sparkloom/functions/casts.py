"""Typed parsing of raw string columns with the acceptance rules of the JVM parsers.

``try_cast`` alone is both looser (accepts ``' 12 '``, ``'2022'`` as a date, ``'yes'`` as true) and
sometimes tighter (rejects ``'...T13:25Z'``) than the parsers a staging job is specified against,
so every cast is ``when(raw matches guard, try_cast(...))``. A failed parse yields NULL; a
successful parse never does (for every type except STRING), so "failed" is "result IS NULL".

Everything is a Catalyst expression: row-local, codegen'd, no Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions._col import as_col
from sparkloom.functions.strings import ascii_digits, jtrim

# The schema type names a staging schema may use, and the Spark type each maps to.
SPARK_TYPES: dict[str, T.DataType] = {
    "INTEGER": T.LongType(),
    "LONG": T.LongType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "FLOAT": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "TIME": T.StringType(),
}

# Types whose parse can never fail (NULL passes through / NULL is false).
NEVER_FAIL = frozenset({"STRING", "BOOLEAN"})

# Acceptance patterns (Java regex, evaluated by the JVM). `\z` rather than `$`: `$` would also
# match before a final newline.
INT_RE = r"^[+-]?[0-9]+\z"
ANY_INT_RE = r"^[+-]?\p{Nd}+\z"  # a digit that ``ascii_digits`` leaves makes the cast fail
DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
# The fraction may be empty ("13:25:01." parses as 13:25:01), as in the ISO time parser.
_NTZ_BODY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{0,9})?)?"
NTZ_RE = rf"^{_NTZ_BODY}\z"
TS_RE = rf"^{_NTZ_BODY}(Z|[+-][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}})?)\z"
NUM_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
NUM_ZERO_RE = r"^[+-]?[0.]+([eE][+-]?[0-9]+)?\z"
FLOAT_DEC_RE = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?\z"
FLOAT_HEX_RE = r"^[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+[fFdD]?\z"
FLOAT_NAN_RE = r"^[+-]?NaN\z"
FLOAT_INF_RE = r"^([+-]?)Infinity\z"
OTHER_DIGIT_RE = r"[\p{Nd}&&[^0-9]]"
TIME_RE = r"^([+-]?[0-9]+):([+-]?[0-9]+):([+-]?[0-9]+)\z"


def parse_integer(c) -> Column:
    """``Long.parseLong``: optional sign, decimal digits of any script, 64-bit range (overflow fails)."""
    v = as_col(c)
    # ASCII first; only what has other characters is translated and tested once more.
    return F.when(v.rlike(INT_RE), v.try_cast("bigint")).when(v.rlike(ANY_INT_RE), ascii_digits(v).try_cast("bigint"))


def parse_date(c) -> Column:
    """``LocalDate.parse``: strict ``yyyy-MM-dd`` with a real calendar date."""
    v = as_col(c)
    return F.when(v.rlike(DATE_RE), v.try_cast("date"))


def parse_datetime(c) -> Column:
    """``LocalDateTime.parse``: ``yyyy-MM-ddTHH:mm[:ss[.f{1,9}]]``, case-insensitive ``T``, no zone."""
    v = F.upper(as_col(c))
    return F.when(v.rlike(NTZ_RE), F.regexp_replace(v, r"\.\z", "").try_cast("timestamp_ntz"))


def parse_timestamp(c) -> Column:
    """ISO offset date-time to an instant: offset (``Z`` or ``+HH:MM[:SS]``) is mandatory."""
    v = F.upper(as_col(c))
    with_seconds = F.regexp_replace(F.regexp_replace(v, r"\.(Z|[+-])", "$1"), r"T([0-9]{2}:[0-9]{2})(Z|[+-].*)\z", "T$1:00$2")
    return F.when(v.rlike(TS_RE), with_seconds.try_cast("timestamp"))


def parse_boolean(c) -> Column:
    """``Boolean.parseBoolean``: case-insensitive ``true``; everything else (NULL too) is false."""
    return F.coalesce(F.lower(as_col(c)) == F.lit("true"), F.lit(False))


def parse_float(c) -> Column:
    """``Double.parseDouble``: trims chars <= U+0020; ``NaN``/``Infinity`` (case-sensitive, signed);
    decimal or hex literal with optional ``f/F/d/D`` suffix; out-of-range rounds to +-Infinity/0."""
    t = jtrim(as_col(c))
    unsuffixed = F.regexp_replace(t, r"[fFdD]\z", "")
    return (  # the common decimal form is tested first
        F.when(t.rlike(FLOAT_DEC_RE), unsuffixed.try_cast("double"))
        .when(t.rlike(FLOAT_NAN_RE), F.lit(float("nan")))
        .when(t.rlike(FLOAT_INF_RE),
              F.when(F.startswith(t, F.lit("-")), F.lit(float("-inf"))).otherwise(F.lit(float("inf"))))
        .when(t.rlike(FLOAT_HEX_RE), t.try_cast("double"))
    )


def parse_numeric(c, precision: int = 38, scale: int = 9) -> Column:
    """``new BigDecimal(s)``: sign, digits, optional fraction and exponent; stored at (38, 9)."""
    v = as_col(c)
    dec = f"decimal({precision},{scale})"
    # A zero mantissa is zero whatever the exponent ("0E100"); try_cast would size it by the
    # exponent and overflow.
    zero = v.rlike(NUM_ZERO_RE)
    return F.when(v.rlike(NUM_RE), F.when(zero, F.lit(0).cast(dec)).otherwise(v.try_cast(dec)))


def parse_time(c) -> Column:
    """``java.sql.Time.valueOf``: ``h:m:s`` as three ints (decimal digits of any script), rolled over leniently to ``HH:mm:ss``."""
    v = as_col(c)
    v = F.when(v.rlike(OTHER_DIGIT_RE), ascii_digits(v)).otherwise(v)
    parts = F.split(v, ":")
    h, m, s = (F.get(parts, i).try_cast("int") for i in range(3))
    secs = h.cast("bigint") * 3600 + m.cast("bigint") * 60 + s.cast("bigint")
    day = F.pmod(secs, F.lit(86400))

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    text = F.concat_ws(":", two(F.floor(day / 3600)), two(F.floor((day % 3600) / 60)), two(day % 60))
    ok = v.rlike(TIME_RE) & h.isNotNull() & m.isNotNull() & s.isNotNull()
    return F.when(ok, text)


def parse_string(c) -> Column:
    return as_col(c).cast("string")


_PARSERS = {
    "INTEGER": parse_integer,
    "LONG": parse_integer,
    "DATE": parse_date,
    "DATETIME": parse_datetime,
    "TIMESTAMP": parse_timestamp,
    "STRING": parse_string,
    "BOOLEAN": parse_boolean,
    "FLOAT": parse_float,
    "NUMERIC": parse_numeric,
    "TIME": parse_time,
}


def is_supported(type_name: str) -> bool:
    return type_name in _PARSERS


def parse_as(c, type_name: str) -> Column:
    """Parse ``c`` as schema type ``type_name``; NULL on failure."""
    try:
        return _PARSERS[type_name](c)
    except KeyError:
        raise ValueError(
            f"Data type {type_name} is not supported; use one of {sorted(_PARSERS)}"
        ) from None


def parse_failed(value: Column, type_name: str) -> Column:
    """True where the parse of a value of ``type_name`` failed (NULL result)."""
    if type_name in NEVER_FAIL:
        return F.lit(False)
    return value.isNull()
