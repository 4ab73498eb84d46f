"""Schema-driven typed staging: all-string raw rows -> typed rows, with a chosen error mode.

``on_error``:
  * ``"reset"``      - reference parity. A row is built field by field in schema order; a failed
                       field throws away everything built so far (itself included), later fields are
                       still set. So every column up to the *last* failing position is NULL.
  * ``"null_field"`` - only the failed field is NULL.
  * ``"strict"``     - the first bad value fails the job (TIME and unknown types pass through).
  * ``"reject"``     - like ``null_field`` plus an ``_errors`` array naming the failed fields; use
                       ``split_rejects`` to route good and bad rows.

Implementation: chained projections. The first computes each typed value once; the next reads it
twice (the value, and whether it is NULL, for the position of the last failure), so Catalyst keeps
the two apart instead of parsing twice; the last applies the mask. The strict check is a filter, which
no consumer can prune away. Row-local: no shuffle, no UDF; the scan reads only the schema's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.casts import is_supported, parse_as, parse_failed
from sparkloom.schema import RECORD_LOAD_TS, Field

MODES = ("reset", "null_field", "strict", "reject")
# The types the strict (legacy) mode parses; anything else is copied through as is.
_STRICT_TYPES = frozenset({"INTEGER", "LONG", "NUMERIC", "DATE", "DATETIME", "TIMESTAMP", "BOOLEAN", "FLOAT"})


def _v(i: int) -> str:
    return f"__v{i}"


def stage(
    raw: DataFrame,
    fields: list[Field],
    on_error: str = "reset",
    load_time: Column | None = None,
) -> DataFrame:
    """Cast the all-string ``raw`` frame to ``fields`` (output = exactly the schema's columns, in order)."""
    if on_error not in MODES:
        raise ValueError(f"on_error must be one of {MODES}")
    if not fields:
        raise ValueError("empty staging schema")
    raw_types = dict(raw.dtypes)
    load_time = F.current_timestamp() if load_time is None else load_time

    values: list[Column] = []
    fails: list[Column] = []
    for i, fld in enumerate(fields):
        if fld.name == RECORD_LOAD_TS:
            values.append(load_time.cast("timestamp").alias(_v(i)))
            fails.append(F.lit(False))
            continue
        present = fld.name in raw_types
        if present and raw_types[fld.name] != "string" and not (on_error == "strict" and fld.type not in _STRICT_TYPES):
            raise TypeError(f"raw column {fld.name} must be string, got {raw_types[fld.name]}")
        src = F.col(fld.name) if present else F.lit(None).cast("string")

        if on_error == "strict":
            if fld.type not in _STRICT_TYPES and fld.type != "STRING":
                values.append(src.alias(_v(i)))
                fails.append(F.lit(False))
                continue
        if not is_supported(fld.type):
            if on_error == "reset":  # parity: an unknown type is a failed field
                values.append(F.lit(None).cast("string").alias(_v(i)))
                fails.append(F.lit(True))
                continue
            raise ValueError(f"Data type {fld.type} of field {fld.name} is not supported")
        values.append(parse_as(src, fld.type).alias(_v(i)))
        fails.append(parse_failed(F.col(_v(i)), fld.type))

    parsed = raw.select(*values)
    n = len(fields)
    names = [f.name for f in fields]

    if on_error == "reset":
        # Position of the last failed field, computed once per row in its own projection (with
        # hundreds of columns, inlining it into every output column would be quadratic).
        last_fail = F.greatest(F.lit(-1), F.lit(-1), *[F.when(fails[i], F.lit(i)).otherwise(F.lit(-1)) for i in range(n)])
        masked = parsed.select(*[F.col(_v(i)) for i in range(n)], last_fail.alias("__last_fail"))
        return masked.select(*[F.when(F.col("__last_fail") < F.lit(i), F.col(_v(i))).alias(names[i]) for i in range(n)])
    if on_error == "strict":
        first = F.coalesce(*[F.when(fails[i], F.lit(f"{names[i]} as {fields[i].type}")) for i in range(n)])
        checked = parsed.where(F.when(first.isNotNull(), F.raise_error(F.concat(F.lit("cannot parse field "), first)).cast("boolean"))
                               .otherwise(F.lit(True)))
        return checked.select(*[F.col(_v(i)).alias(names[i]) for i in range(n)])
    out = [F.col(_v(i)).alias(names[i]) for i in range(n)]
    if on_error == "reject":
        errors = F.array_compact(F.array(*[F.when(fails[i], F.lit(names[i])) for i in range(n)]))
        out.append(errors.alias("_errors"))
    return parsed.select(*out)


def split_rejects(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``_errors``, rejected rows with ``_errors``) of a ``reject``-mode frame."""
    ok = F.size("_errors") == F.lit(0)
    return staged.where(ok).drop("_errors"), staged.where(~ok)
