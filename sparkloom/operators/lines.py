"""Delimited-line operators (text ETL): header skips, field filters, field projection, recode.

Lines are ``DataFrame[value: string]`` (what ``spark.read.text`` yields). Every operator is a
row-local Catalyst expression - a narrow stage, no shuffle. Field access follows ``String.split``
(trailing empty fields dropped) and an out-of-range field fails the job, as the dataflow jobs do.
Quoted CSV is not interpreted (neither do the jobs this mirrors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.strings import get_field, java_split

LINE = "value"


def _fields(line: Column, sep: str) -> Column:
    return java_split(line, sep)


def skip_prefix(lines: DataFrame, prefix: str, col: str = LINE) -> DataFrame:
    """drop every line whose lower-cased form starts with ``prefix`` (not only the first)."""
    return lines.where(~F.startswith(F.lower(F.col(col)), F.lit(prefix)))


def field_equals(lines: DataFrame, header: str, index: int, value: str, sep: str = ",", col: str = LINE) -> DataFrame:
    """drop NULL lines and lines equal (lower-cased) to ``header``; keep lines whose field
    ``index`` equals ``value`` exactly (case-sensitive, untrimmed). The header test guards the
    field access, as in the element function (a short header line never fails the job)."""
    line = F.col(col)
    parts = _fields(line, sep)
    keep = F.when(line.isNull() | (F.lower(line) == F.lit(header)), F.lit(False)).otherwise(
        get_field(parts, index, line) == F.lit(value))
    return lines.where(keep)


def id_prefix(lines: DataFrame, record_id: str, comment: str = "#", col: str = LINE) -> DataFrame:
    """not NULL, not a ``#`` comment, and the line starts with ``record_id`` (a prefix test,
    so ``CT1`` also matches ``CT10``)."""
    line = F.col(col)
    return lines.where(line.isNotNull() & ~F.startswith(line, F.lit(comment)) & F.startswith(line, F.lit(record_id)))


def field_upper(lines: DataFrame, index: int, sep: str = ",", col: str = LINE, out: str = LINE) -> DataFrame:
    """Field ``index`` upper-cased."""
    line = F.col(col)
    return lines.select(F.upper(get_field(_fields(line, sep), index, line)).alias(out))


# The gender recode of the session CSV (field 6: "1" -> "M", "2" -> "F").
SEX_CODES = {"1": "M", "2": "F"}


def recode_field(lines: DataFrame, index: int = 6, codes: dict[str, str] | None = None, keep: int = 7,
                 sep: str = ",", col: str = LINE, out: str = LINE) -> DataFrame:
    """Keep the first ``keep`` fields (all must exist), map field ``index`` through ``codes``
    (unlisted values unchanged), re-join with ``sep``."""
    codes = SEX_CODES if codes is None else codes
    line = F.col(col)
    parts = F.col("_parts")
    kept = [get_field(parts, i, line) for i in range(keep)]
    recoded = kept[index]
    mapped = None
    for src, dst in codes.items():
        mapped = (F.when(recoded == F.lit(src), F.lit(dst)) if mapped is None
                  else mapped.when(recoded == F.lit(src), F.lit(dst)))
    kept[index] = recoded if mapped is None else mapped.otherwise(recoded)
    return lines.select(line, _fields(line, sep).alias("_parts")).select(F.concat_ws(sep, *kept).alias(out))


def project(df: DataFrame, *names: str) -> DataFrame:
    """Object field projection (``Customer::getName``) - a column selection Catalyst pushes to the scan."""
    return df.select(*names)
