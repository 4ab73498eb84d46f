"""Filter interaction audit: what each filter removes under every order of application.

Filters that are applied one after another share their work: a row that two of them fail is booked on
the first. For k filters there are k! orders. A row's failures are a mask of k bits, and its removal step
depends on the mask alone: it falls at step s if s - 1 passed filters stand first and then a failed one.
All orders with that beginning have neighbouring Lehmer ranks, so a mask's removals at (step, filter) cover whole
*intervals* of the lexicographic list of orders. Each mask's counts are added at the start of its
intervals and taken off at the ends; one prefix sum over the ranks gives every order at once.

On Spark: flags are row-local expressions; rows collapse to (part, mask) counts, map-side first, at most 2**k rows a
part whatever the part's share of the table; the difference arrays (k! x k) are filled per part.

Copies: ``repeats`` marks every row whose text a smaller id holds too. The least id of each text is one
partial aggregation; rows look it up by (text digest, id), a key that no group of copies makes hot. Digests
are SHA-256.

Defined cases: a null part is the empty string; null flags count as passed; null weights as 0; a null
text is empty; null ids come after all others and do not repeat each other; rows that repeat an id and text are rows of their own
and neither is the smaller one; an empty table gives no rows; very long texts are one value of a row-local expression.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

_LAST = (1 << 63) - 1
# The contract's word and symbol classes.
WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"


def intervals(k: int) -> list[tuple[int, int, int, int, int]]:
    """(mask, step, filter, start, end): orders start..end-1 remove a row of the mask by the filter at the step (from 0)."""
    out = []
    for step in range(k):
        width = math.factorial(k - step - 1)
        for place, begin in enumerate(itertools.permutations(range(k), step + 1)):  # lexicographic: place = rank / width
            passed, failed = sum(1 << f for f in begin[:-1]), begin[-1]
            free = [f for f in range(k) if not passed >> f & 1 and f != failed]
            for more in range(1 << len(free)):
                mask = 1 << failed | sum(1 << f for i, f in enumerate(free) if more >> i & 1)
                out.append((mask, step, failed, place * width, (place + 1) * width))
    return out


def removal_table(counts: np.ndarray, k: int, spans: np.ndarray) -> np.ndarray:
    """Sums of ``counts`` (2**k x weights) removed at each (order, step), weights last."""
    n = math.factorial(k)
    diff = np.zeros((n + 1, k, counts.shape[1]), np.int64)
    mask, step, _, start, end = spans.T
    np.add.at(diff, (start, step), counts[mask])
    np.subtract.at(diff, (end, step), counts[mask])
    return np.cumsum(diff[:n], axis=0)


def audit(flagged: DataFrame, filters: Sequence[str], part: str = "part", weights: Mapping[str, str] | None = None,
          scratch: Scratch | None = None) -> DataFrame:
    """One row per part, order and step.

    ``filters`` names boolean failure columns by one letter each (at most 7); ``weights`` maps an output name to
    a column whose sum over the rows removed at the step is returned besides the counts. With ``scratch`` the (part, mask)
    counts are written there and its earlier tables removed.
    """
    k, names = len(filters), list(filters)
    if not 1 <= k <= 7 or len(set(names)) < k or any(len(x) != 1 for x in names):
        raise ValueError("audit takes 1 to 7 filters, each named by a letter of its own")
    order_of = sorted(range(k), key=lambda i: names[i])  # lexicographic in the letters
    names = [names[i] for i in order_of]
    extra = dict(weights or {})
    mask = sum((F.when(F.col(f), F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(names)), F.lit(0))
    counts = flagged.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
                            *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(f"w{i}") for i, c in enumerate(extra.values())])
    counts = counts.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(extra))])
    if scratch is not None:
        counts = scratch.write(counts, "audit-counts")
        scratch.close(keep=1)
    spans = np.array(intervals(k), np.int64)
    orders = np.array(list(itertools.permutations(range(k))), np.int64)
    labels = ["".join(names[f] for f in o) for o in orders]
    fields = ["kept", "removed", "redundant", "unique_fails", *extra, "shapley"]

    def totals(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << k, 1 + len(extra)), np.int64)
        for b in batches:
            cells = np.stack([np.asarray(b[c]).astype(np.int64) for c in ["n", *[f"w{i}" for i in range(len(extra))]]], axis=1)
            np.add.at(total, np.asarray(b["mask"]).astype(np.int64), cells)
        gone = removal_table(total, k, spans)
        removed = gone[:, :, 0]
        fails = np.array([total[[m for m in range(1 << k) if m >> f & 1], 0].sum() for f in range(k)])
        share = np.array([removed[orders == f].sum() for f in range(k)])
        only = np.array([total[1 << f, 0] for f in range(k)])
        out = {"kept": total[:, 0].sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": fails[orders] - removed,
               "unique_fails": only[orders], **{c: gone[:, :, 1 + i] for i, c in enumerate(extra)}, "shapley": share[orders]}
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([key[0].as_py()] * orders.size, pa.string()),
            "filter_order": pa.array([x for x in labels for _ in range(k)], pa.string()),
            "step": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(labels))),
            **{c: pa.array(out[c].reshape(-1)) for c in fields}})

    schema = "part string, filter_order string, step int, " + ", ".join(f"`{c}` long" for c in fields)
    return counts.groupBy("part").applyInArrow(totals, schema)


def repeats(rows: DataFrame, id_col: str, digest: str, out: str) -> DataFrame:
    """Rows with a flag: a row with a smaller id has the same digest. ``id_col`` may not be null."""
    first = rows.groupBy(F.col(digest).alias("_digest")).agg(F.min(id_col).alias("_first"))
    same = (rows[id_col] == first["_first"]) & (rows[digest] == first["_digest"])
    return rows.join(first, same, "left").withColumn(out, F.col("_first").isNull()).drop("_digest", "_first")


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the text filters: short, repetitive, shouting, symbols."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    words = F.filter(F.split(whole, WORD_GAP), lambda w: w != "")
    n, capitals = F.size(words), F.length(whole) - F.length(F.regexp_replace(whole, "[A-Z]+", ""))
    return {"A": n < 200, "B": F.size(F.array_distinct(words)) * 100 < n * 50, "C": capitals * 100 > F.length(whole) * 2,
            "D": whole.rlike(SYMBOLS)}


def document_flags(df: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, A..E, good, toxic) of every row: the five filters' failures and the labels (any row of the id counts).

    Texts are read once; what is left of a row (digest, flags) is written to the shared folder and read twice.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256))
    slim = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.col(id_col).isNull().alias("no_id"), F.col(part).cast("string").alias("part"),
                     digest.alias("digest"), *[c.alias(name) for name, c in text_failures(F.col(text)).items()])
    slim = scratch.write(slim, "audit-rows")
    told = labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    flagged = repeats(slim, "id", "digest", "E")
    return flagged.join(told, (F.col("id") == F.col("_id")) & ~F.col("no_id"), "left").select("part", "A", "B", "C", "D", "E", "good", "toxic")
