"""Keyed operators: group by key, co-group, sum per key, global max, scalar filter, multi-output.

Skew policy: any key - or any single (key, value) pair - may hold a large share of all rows.

A grouped list per key is one output row, so it fits small groups only: a key with a third of 100 TB
cannot be a row. The list forms (``group_by_key``, ``group_lines``, ``cogroup``, ``cogroup_lines``) are for
inputs whose groups fit in a row. A light pass first sketches the keys' sizes (``operators.sketch``: never too low).
Keys of up to ``LARGE_KEY`` rows are grouped in one shuffle. Larger ones ride the same shuffle, dealt by the task they come
from, and then go through *sorted runs* so that no task sorts a whole group: copies of a pair collapse to a
count (partial aggregation), ``repartitionByRange(key, value)`` cuts a large key's value range over many
partitions, each partition sorts and formats its slice, and the formatted runs meet
in the output row. The size only picks the route; both give the same lists, and the input is read twice in all.

The bounded forms (``group_chunks``, ``cogroup_chunks``) return the same lists in chunks of a fixed
number of values: no row, group or task holds more, whatever the key. ``route_outputs`` and the tagged
sink work on chunk rows as on whole lines. A run (``group_runs`` / ``cogroup_runs``) is bounded by its
range partition's distinct pairs, not by their copies: use chunks where one pair repeats very often.

Numeric reductions (sum, max) use Spark's partial + final aggregation, so a hot key is reduced to
one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.casts import parse_integer
from sparkloom.functions.formatting import (
    LIST_SEP,
    format_cogroup_text,
    format_group_text,
    format_kv,
    join_values,
)
from sparkloom.functions.strings import get_field, java_split, strip, utf16_length
from sparkloom.operators.argmax import keep_greatest
from sparkloom.operators.exchange import above_exchange
from sparkloom.operators.sketch import bucket_of, count_sketch, heavy_buckets

RUN = "_run"
LARGE_KEY = 1_000_000


# --------------------------------------------------------------------------------------------
# Delimited line -> (key, value)
# --------------------------------------------------------------------------------------------
def parse_kv_lines(lines: DataFrame, line_col: str = "value", sep: str = ",",
                   key: str = "k", value: str = "v") -> DataFrame:
    """``"word, 12"`` -> (``word``, 12). Key is field 0 as is (not trimmed); value is field 1
    stripped and parsed as a 64-bit integer. A missing or malformed value fails the job."""
    line = F.col(line_col)
    split = lines.select(line.alias("_line"), java_split(line, sep).alias("_parts"))
    fields = split.select(get_field("_parts", 0, "_line").alias(key),
                          strip(get_field("_parts", 1, "_line")).alias("_raw"))
    parsed = parse_integer(F.col("_raw"))
    # The check is a filter: a consumer that reads only the key (or counts) must fail as well.
    bad = F.raise_error(F.concat(F.lit("For input string: "), F.coalesce(F.col("_raw"), F.lit("NULL"))))
    checked = fields.select(key, "_raw", parsed.alias(value)).where(F.when(F.col(value).isNull(), bad.cast("boolean")).otherwise(F.lit(True)))
    return checked.select(key, value)


# --------------------------------------------------------------------------------------------
# Sorted runs (the skew-safe building block of every grouped output)
# --------------------------------------------------------------------------------------------
def group_runs(df: DataFrame, key: str, value: str, tag: str | None = None, as_text: bool = False) -> DataFrame:
    """(key[, tag], _run, vs) where ``vs`` is a sorted slice of the key's values; the runs of a key,
    ordered by ``_run``, concatenate to the key's fully sorted value list (duplicates kept).
    ``as_text`` renders each slice as ``a, b, c`` in the run (column ``txt``) so the final assembly
    only joins strings.

    1. Copies of one (key, value) pair collapse to a count, map-side first (partial aggregation):
       even a single pair repeated across a third of all rows becomes one row per map task.
    2. The distinct pairs are range-partitioned on (key, value). The sampling for the range bounds
       reads the materialised output of step 1, so the upstream scan is not computed twice, and a
       hot key's value range is cut over as many partitions as its size needs.
    3. Each partition sorts its slice per key; the slice is expanded back to all copies.
    """
    keys = [key] + ([tag] if tag else [])
    pairs = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranged = pairs.repartitionByRange(*keys, value)
    slices = ranged.groupBy(*keys, F.spark_partition_id().alias(RUN)).agg(
        F.sort_array(F.collect_list(F.struct(value, "_n"))).alias("_vn"))
    if as_text:
        rendered = F.transform("_vn", lambda x: F.array_join(
            F.array_repeat(F.coalesce(x[value].cast("string"), F.lit("null")), _copies(x["_n"])), LIST_SEP))
        return slices.select(*keys, RUN, F.array_join(rendered, LIST_SEP).alias("txt"))
    expanded = F.flatten(F.transform("_vn", lambda x: F.array_repeat(x[value], _copies(x["_n"]))))
    return slices.select(*keys, RUN, expanded.alias("vs"))


def _copies(n: Column) -> Column:
    """Copy count for ``array_repeat``; a count beyond the array limit fails loudly (a plain int cast
    would wrap in a non-ANSI session and silently drop values). ``group_chunks`` has no such limit."""
    return F.when(n <= F.lit(2_147_483_647), n.cast("int")).otherwise(
        F.raise_error(F.lit("a single (key, value) pair occurs too often for one list; use group_chunks")))


def _ordered(parts: Column, field_name: str) -> Column:
    """collect_list(struct(_run, x)) -> x's in run order."""
    return F.sort_array(parts)[field_name]


SALT = "_salt"


def _by_size(df: DataFrame, key: str, value: str, large_key: int) -> tuple[DataFrame, DataFrame]:
    """(rows of small keys, rows of large ones), both read from one exchange: small keys whole under ``(key, _salt)``,
    large ones spread by the task they come from. The list of large buckets is bounded by the sketch's width."""
    heavy = heavy_buckets(count_sketch(df, key), large_key).withColumn("_heavy", F.lit(True))
    marked = df.select(key, value, bucket_of(F.col(key)).alias("bucket")).join(F.broadcast(heavy), "bucket", "left")
    dealt = marked.select(key, value, F.when(F.col("_heavy"), F.spark_partition_id()).alias(SALT)).repartition(key, SALT)
    return dealt.where(above_exchange(F.col(SALT).isNull())), dealt.where(above_exchange(F.col(SALT).isNotNull()))


def _sorted_values(value: str) -> Column:
    """All values of a group, ascending, NULLs first and kept."""
    nulls = F.array_repeat(F.first(F.when(F.col(value).isNull(), F.col(value))), F.count_if(F.col(value).isNull()).cast("int"))
    return F.concat(nulls, F.sort_array(F.collect_list(value)))


def group_by_key(df: DataFrame, key: str = "k", value: str = "v", out: str = "vs", large_key: int = LARGE_KEY) -> DataFrame:
    """A1: (key, sorted array of all values; duplicates kept). Small groups only (one row per key)."""
    small, large = _by_size(df, key, value, large_key)
    whole = small.groupBy(key, SALT).agg(_sorted_values(value).alias(out)).select(key, out)
    runs = group_runs(large, key, value)
    grouped = runs.groupBy(key).agg(F.collect_list(F.struct(RUN, "vs")).alias("_p"))
    return whole.unionByName(grouped.select(F.col(key), F.flatten(_ordered(F.col("_p"), "vs")).alias(out)))


def group_lines(df: DataFrame, key: str = "k", value: str = "v", out: str = "line", large_key: int = LARGE_KEY) -> DataFrame:
    """A1 + P6: one ``key:[v1, v2, ...]`` line per key (values ascending). Small groups only."""
    small, large = _by_size(df, key, value, large_key)
    whole = small.groupBy(key, SALT).agg(join_values(_sorted_values(value)).alias("_txt")).select(key, "_txt")
    runs = group_runs(large, key, value, as_text=True)
    grouped = runs.groupBy(key).agg(F.collect_list(F.struct(RUN, "txt")).alias("_p"))
    joined = grouped.select(F.col(key), F.array_join(_ordered(F.col("_p"), "txt"), LIST_SEP).alias("_txt"))
    return whole.unionByName(joined).select(F.col(key), format_group_text(F.col(key), F.col("_txt")).alias(out))


def group_chunks(df: DataFrame, key: str = "k", value: str = "v", chunk_size: int = 10_000,
                 out: str = "txt") -> DataFrame:
    """A1 with bounded rows: (key, chunk, txt) where chunk ``c`` holds the values ranked
    ``[c*chunk_size, (c+1)*chunk_size)`` in the key's ascending value list, rendered ``a, b, c``.
    Joining a key's chunks in order with ``", "`` gives exactly the list of ``group_lines``, but no
    row, group or task ever holds more than ``chunk_size`` values - not even for a key (or a
    single repeated pair) holding a third of all rows.

    Ranks are computed without sorting any group in one place: pair counts (map-side), range split
    into runs, a running count inside each run (a run is one range partition's slice), the runs'
    offsets from a running sum over the (few) runs of each key, then each pair is cut into the
    chunks its rank interval covers. Runs the pair/range stages eagerly (checkpoint) when called."""
    return _chunks(df, [key], value, chunk_size, out)


# Chunk numbers of one pair are generated in blocks of this many (a pair may cover very many chunks).
_CHUNK_BLOCK = 4096


def _chunks(df: DataFrame, keys: list[str], value: str, chunk_size: int, out: str) -> DataFrame:
    from pyspark.sql import Window

    from sparkloom.session import checkpoint_root

    pairs = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    ranged = pairs.repartitionByRange(*keys, value).withColumn(RUN, F.spark_partition_id())
    in_run = Window.partitionBy(*keys, RUN).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_end", F.sum("_n").over(in_run))
    # The runs feed two branches (their sizes and the pairs themselves); both must see the same run
    # ids. A second range exchange would sample its own bounds, so the ranked pairs are written
    # once to the shared checkpoint folder (reliable checkpoint: also survives executor loss).
    checkpoint_root(df.sparkSession)
    local = local.checkpoint(eager=True)
    sizes = local.groupBy(*keys, RUN).agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy(*keys).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], F.col(RUN).alias("_orun"),
                           F.sum("_size").over(before).alias("_off")).where("_off is not null")
    # Only a key's second and later runs have an offset, and a partition holds at most one of those per
    # key it continues: no more rows than range partitions, so the broadcast is bounded.
    same = F.col(RUN) == F.col("_orun")
    for i, k in enumerate(keys):
        same = same & local[k].eqNullSafe(F.col(f"_o{i}"))
    ranked = local.join(F.broadcast(offsets), same, "left").select(
        *keys, value, "_n", (F.coalesce("_off", F.lit(0)) + F.col("_end") - F.col("_n")).alias("_start"))
    c = F.lit(chunk_size)
    first, last = F.floor(F.col("_start") / c), F.floor((F.col("_start") + F.col("_n") - 1) / c)
    blocks = ranked.select("*", first.alias("_c0"), last.alias("_c1")).select(
        "*", F.explode(F.sequence(F.floor(F.col("_c0") / _CHUNK_BLOCK), F.floor(F.col("_c1") / _CHUNK_BLOCK))).alias("_b"))
    chunk = F.explode(F.sequence(F.greatest("_c0", F.col("_b") * _CHUNK_BLOCK), F.least("_c1", (F.col("_b") + 1) * _CHUNK_BLOCK - 1)))
    pieces = blocks.select(*keys, value, "_n", "_start", chunk.alias("chunk"))
    lo = F.greatest(F.col("_start"), F.col("chunk") * c)
    hi = F.least(F.col("_start") + F.col("_n"), (F.col("chunk") + 1) * c)
    pieces = pieces.select(*keys, "chunk", value, (hi - lo).alias("_cnt"))
    rendered = F.transform(F.sort_array(F.collect_list(F.struct(value, "_cnt"))), lambda x: F.array_join(
        F.array_repeat(F.coalesce(x[value].cast("string"), F.lit("null")), x["_cnt"].cast("int")), LIST_SEP))
    return pieces.groupBy(*keys, "chunk").agg(F.array_join(rendered, LIST_SEP).alias(out))


def chunk_lines(chunks: DataFrame, key: str = "k", out: str = "line") -> DataFrame:
    """Chunk rows plus their text line ``key:chunk:[v1, v2, ...]`` (for the text sinks)."""
    return chunks.withColumn(out, F.concat(F.col(key), F.lit(":"), F.col("chunk").cast("string"), F.lit(":["), F.col("txt"), F.lit("]")))


# --------------------------------------------------------------------------------------------
# Co-group of N tagged inputs
# --------------------------------------------------------------------------------------------
def _tagged_union(inputs: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    tagged = [d.select(F.col(key).alias("k"), F.lit(t).alias("_tag"), F.col(value).cast("string").alias("v"))
              for t, d in inputs.items()]
    out = tagged[0]
    for d in tagged[1:]:
        out = out.unionByName(d)
    return out


def _has_tag(t: str):
    return lambda s: s["_tag"] == F.lit(t)


def cogroup_runs(inputs: dict[str, DataFrame], key: str = "k", value: str = "v") -> DataFrame:
    """(k, _tag, _run, txt): sorted, formatted slices per key and input, one shuffle for all inputs."""
    return group_runs(_tagged_union(inputs, key, value), "k", "v", tag="_tag", as_text=True)


def cogroup(inputs: dict[str, DataFrame], key: str = "k", value: str = "v") -> DataFrame:
    """(k, <tag>: sorted array<string> per input). Full-outer by key, lists per side, no cross product.
    Small groups only (one row per key); ``cogroup_chunks`` is the bounded form."""
    tagged = _tagged_union(inputs, key, value)
    runs = group_runs(tagged, "k", "v", tag="_tag")
    parts = F.collect_list(F.struct("_tag", RUN, "vs")).alias("_parts")
    grouped = runs.groupBy("k").agg(parts)
    cols = [F.col("k")]
    for t in inputs:
        mine = F.filter("_parts", _has_tag(t))
        cols.append(F.flatten(F.sort_array(mine)["vs"]).alias(t))
    return grouped.select(*cols)


def cogroup_lines(inputs: dict[str, DataFrame], key: str = "k", value: str = "v",
                  blank_empty: bool = False, out: str = "line") -> DataFrame:
    """``key : [a, b];[c]`` per key (``blank_empty``: a side without values prints nothing).
    Small groups only; ``cogroup_chunks`` is the bounded form."""
    runs = cogroup_runs(inputs, key, value)
    grouped = runs.groupBy("k").agg(F.collect_list(F.struct("_tag", RUN, "txt")).alias("_parts"))
    sides, empty = [], []
    for t in inputs:
        mine = F.filter("_parts", _has_tag(t))
        sides.append(F.array_join(F.sort_array(mine)["txt"], LIST_SEP))
        empty.append(F.size(mine) == F.lit(0))
    return grouped.select(F.col("k"), format_cogroup_text(F.col("k"), sides, empty if blank_empty else None).alias(out))


def cogroup_chunks(inputs: dict[str, DataFrame], key: str = "k", value: str = "v", chunk_size: int = 10_000) -> DataFrame:
    """J1 with bounded rows: (k, tag, chunk, txt), the ``group_chunks`` of every input by key.

    A key's rows, ordered by (tag, chunk), are its lists; an input without the key has no rows."""
    chunks = _chunks(_tagged_union(inputs, key, value), ["k", "_tag"], "v", chunk_size, "txt")
    return chunks.withColumnRenamed("_tag", "tag")


# --------------------------------------------------------------------------------------------
# A2 / A3 / P5 / F4
# --------------------------------------------------------------------------------------------
def sum_per_key(df: DataFrame, key: str = "k", value: str = "v", out: str = "total") -> DataFrame:
    """A2: per-key sum (partial aggregation before the shuffle; 64-bit overflow raises under ANSI)."""
    return df.groupBy(key).agg(F.sum(value).cast("bigint").alias(out))


def sum_lines(df: DataFrame, key: str = "k", value: str = "v", out: str = "line") -> DataFrame:
    """U1 composite (P1 -> A2 -> P7): ``key:sum`` per key."""
    return sum_per_key(df, key, value, "_sum").select(F.col(key), format_kv(F.col(key), F.col("_sum")).alias(out))


def key_length(df: DataFrame, key: str = "k", out: str = "n") -> Column:
    """P5: ``(long) key.length()`` - UTF-16 code units, like the JVM string length."""
    return utf16_length(F.col(key)).alias(out)


def global_max(df: DataFrame, col: Column | str, out: str = "max_value") -> DataFrame:
    """A3: one-row global maximum (partial max per task, then a single tiny merge)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.agg(F.max(c).alias(out))


def filter_by_max_length(df: DataFrame, key: str = "k", materialize: bool = False) -> DataFrame:
    """Keep pairs whose key length equals the global maximum key length, in one pass over the input.

    Tasks drop what is shorter than the longest key they have seen; the maximum over the few rows left (the broadcast
    singleton of the dataflow model) is an uncorrelated scalar subquery that shares their exchange. With ``materialize`` an
    expensive input is written once to the shared checkpoint folder first (reliable checkpoint, lineage cut there)."""
    if materialize:
        from sparkloom.session import checkpoint_root

        checkpoint_root(df.sparkSession)  # ensure a shared checkpoint folder is configured
        df = df.checkpoint(eager=True)
    return keep_greatest(df, utf16_length(F.col(key)))


# --------------------------------------------------------------------------------------------
# overlapping multi-output routing
# --------------------------------------------------------------------------------------------
# The three output tags of the routing operator.
TAG_BELOW, TAG_ABOVE, TAG_MARKER = "below", "above", "marker"


def route_tags(key: Column, cutoff: int, marker: str) -> Column:
    """Array of tags for a key: ``below`` if length < cutoff else ``above``; plus ``marker`` when the
    lower-cased key starts with ``marker`` (the marker itself is not lower-cased)."""
    size_tag = F.when(utf16_length(key) < F.lit(cutoff), F.lit(TAG_BELOW)).otherwise(F.lit(TAG_ABOVE))
    marker_tag = F.when(F.lower(key).startswith(F.lit(marker)), F.lit(TAG_MARKER))
    return F.array_compact(F.array(size_tag, marker_tag))


def route_outputs(grouped: DataFrame, key: str, cutoff: int, marker: str, tag: str = "tag") -> DataFrame:
    """One pass, overlapping outputs: each row is emitted once per tag it belongs to."""
    return grouped.select(F.explode(route_tags(F.col(key), cutoff, marker)).alias(tag), "*")


def split_outputs(routed: DataFrame, tag: str = "tag") -> dict[str, DataFrame]:
    """Named outputs over one plan (each a filter of the routed frame)."""
    return {t: routed.where(F.col(tag) == F.lit(t)).drop(tag) for t in (TAG_BELOW, TAG_ABOVE, TAG_MARKER)}
