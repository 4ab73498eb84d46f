"""Text renderings of keyed results (``key:[a, b]``, ``key:value``, ``key : [..];[..]``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions._col import as_col

# List rendering ("[a, b]") and the separators of the keyed line formats.
LIST_OPEN, LIST_SEP, LIST_CLOSE = "[", ", ", "]"
KEY_SEP = ":"
COGROUP_KEY_SEP, COGROUP_SIDE_SEP = " : ", ";"


def join_values(values) -> Column:
    """Array -> ``a, b, c`` (elements rendered as strings; a NULL element prints as ``null``)."""
    return F.array_join(as_col(values).cast("array<string>"), LIST_SEP, "null")


def format_list(values) -> Column:
    return F.concat(F.lit(LIST_OPEN), join_values(values), F.lit(LIST_CLOSE))


def format_group(key, values) -> Column:
    """``key:[v1, v2]``."""
    return F.concat(as_col(key), F.lit(KEY_SEP), format_list(values))


def format_group_text(key, joined) -> Column:
    """``key:[<joined>]`` where ``joined`` is already ``v1, v2``."""
    return F.concat(as_col(key), F.lit(KEY_SEP + LIST_OPEN), as_col(joined), F.lit(LIST_CLOSE))


def format_kv(key, value) -> Column:
    """``key:value``."""
    return F.concat(as_col(key), F.lit(KEY_SEP), as_col(value).cast("string"))


def format_cogroup_text(key, sides: list, empty: list | None = None) -> Column:
    """``key : [a, b];[c]``; a side whose ``empty`` condition holds renders as nothing instead of ``[]``."""
    rendered = []
    for i, s in enumerate(sides):
        body = F.concat(F.lit(LIST_OPEN), as_col(s), F.lit(LIST_CLOSE))
        rendered.append(F.when(empty[i], F.lit("")).otherwise(body) if empty else body)
    return F.concat(as_col(key), F.lit(COGROUP_KEY_SEP), F.concat_ws(COGROUP_SIDE_SEP, *rendered))
