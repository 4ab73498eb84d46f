"""String column builders with the exact semantics of the JVM string methods the jobs rely on.

All of them are plain Catalyst expressions (regexp / split / array functions), so they stay in
whole-stage codegen and need no Python on the executors.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions._col import as_col

# The characters Character.isWhitespace accepts (what String.strip removes): TAB, LF,
# VT, FF, CR, FS, GS, RS, US, and the Unicode space, line and paragraph separators except the
# no-break spaces U+00A0, U+2007 and U+202F.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"
    "\u0020\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2008\u2009\u200a"
    "\u2028\u2029\u205f\u3000"
)
# String.trim removes every char <= U+0020.
TRIM_CHARS = "".join(chr(c) for c in range(0x21))


def strip(c) -> Column:
    """``String.strip()``: remove leading/trailing Unicode whitespace (not no-break spaces)."""
    return F.btrim(as_col(c), F.lit(STRIP_CHARS))


def jtrim(c) -> Column:
    """``String.trim()``: remove leading/trailing chars <= U+0020."""
    return F.btrim(as_col(c), F.lit(TRIM_CHARS))


def java_split(c, sep: str = ",") -> Column:
    """``String.split(sep)`` (limit 0) for a literal separator.

    Unlike Spark's ``split``, trailing empty fields are dropped: ``"a,b,,"`` -> 2 fields,
    ``","`` -> 0 fields, ``""`` -> one empty field. For a one-character separator, dropping the
    trailing empty fields is right-trimming that character (no regex pass)."""
    v = as_col(c)
    s = re.escape(sep)
    if len(sep) == 1:
        body = F.rtrim(v, F.lit(sep))
        return (
            F.when(v == F.lit(""), F.array(F.lit("")))
            .when(body == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(body, s))
        )
    # Longer separators: split left to right keeping every field, then drop the trailing empty
    # fields (a right-anchored regex would align the separators from the wrong end).
    parts = F.split(v, s, -1)
    trailing = F.aggregate(
        F.reverse(parts), F.struct(F.lit(0).alias("n"), F.lit(True).alias("open")),
        lambda acc, x: F.when(acc["open"] & (x == F.lit("")), F.struct((acc["n"] + 1).alias("n"), F.lit(True).alias("open")))
        .otherwise(F.struct(acc["n"].alias("n"), F.lit(False).alias("open"))))["n"]
    return F.when(v == F.lit(""), F.array(F.lit(""))).otherwise(F.slice(parts, 1, F.size(parts) - trailing))


def get_field(parts, index: int, line) -> Column:
    """Element ``index`` (0-based) of a split array; out of range fails the job (like ``arr[i]``)."""
    parts, line = as_col(parts), as_col(line)
    return F.when(F.size(parts) > F.lit(index), F.get(parts, index)).otherwise(
        F.raise_error(F.concat(F.lit(f"Index {index} out of bounds for line: "), F.coalesce(line, F.lit("NULL")))))


def field(c, index: int, sep: str = ",") -> Column:
    """Field ``index`` (0-based) of ``java_split(c, sep)``; out of range fails the job."""
    return get_field(java_split(c, sep), index, c)


def utf16_length(c) -> Column:
    """``String.length()`` counts UTF-16 code units; Spark's ``length`` counts code points.
    ASCII strings (bytes == code points) take the cheap path; others are measured in UTF-16."""
    v = as_col(c)
    n = F.length(v).cast("bigint")
    return F.when(F.octet_length(v) == n, n).otherwise(
        (F.octet_length(F.encode(v, "UTF-16BE")) / F.lit(2)).cast("bigint"))


def _decimal_digits() -> tuple[str, str]:
    """Every decimal digit beyond ASCII that fits in one UTF-16 unit, and the ASCII digit it stands for (from the Unicode
    character classes). The JVM's integer parsers look at UTF-16 units, so digits beyond those are not digits to them."""
    import unicodedata

    digits = [chr(c) for c in range(128, 0x10000) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


OTHER_DIGITS, THEIR_ASCII = _decimal_digits()


def ascii_digits(c) -> Column:
    """Decimal digits of any script as ASCII digits, one ``translate``; everything else as it is."""
    return F.translate(as_col(c), OTHER_DIGITS, THEIR_ASCII)
