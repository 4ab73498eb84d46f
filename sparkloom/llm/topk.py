"""Exact top-k search: exhaustive term-at-a-time accumulation.

Vectors are sparse rows (dimension, integer weight). Candidates are packed into blocks of postings
lists (dimension -> rows, weights), queries into blocks of at most ``query_block`` rows. Every
candidate block meets every query block: the stated query set against all rows, in blocks, joined on
a grid (query slot x part); nothing is broadcast by a hint and no block holds more than its fixed
number of rows.
In a task, a term's postings are scattered into the dense score array (queries x rows of the block);
``argpartition`` keeps k per query and block, ties resolved by the id, and a window merges the blocks.

Defined cases: null vectors and vectors with a null or non-finite component take no part; absent
dimensions weigh 0 (vectors of unequal length are allowed); an empty vector scores 0 everywhere;
rows that repeat an id are candidates of their own, a query excludes every row of its own id, and
query rows that share an id share one ranking;
null ids take no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

_PACKED = "ids binary, lens binary, weights binary"


def quantise(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    def finite(x: Column) -> Column:
        d = x.cast("double")
        return F.coalesce(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), F.lit(False))

    return vector.isNotNull() & F.forall(vector, finite)


def _pack(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lens, weights, n = [], [], [], 0

        def out() -> pa.RecordBatch:
            cells = [np.concatenate(x).tobytes() for x in (ids, lens, weights)]
            return pa.RecordBatch.from_pydict({k: pa.array([c], pa.binary()) for k, c in zip(("ids", "lens", "weights"), cells, strict=True)})

        for b in batches:
            for a in range(0, b.num_rows, size):
                part = b.slice(a, size)
                if n and n + part.num_rows > size:
                    yield out()
                    ids, lens, weights, n = [], [], [], 0
                v = part["vec"]
                off = np.asarray(v.offsets).astype(np.int64)
                ids.append(np.asarray(part["id"]).astype(np.int64))
                lens.append(np.diff(off).astype(np.int32))
                weights.append(np.asarray(v.values)[off[0]:off[-1]].astype(np.int64))
                n += part.num_rows
        if n:
            yield out()

    return pack


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, and the non-zero (row, dimension, weight) entries."""
    ids, lens = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lens"], np.int32).astype(np.int64)
    w = np.frombuffer(row["weights"], np.int64)
    rows = np.repeat(np.arange(len(ids)), lens)
    dims = np.arange(len(w)) - np.repeat(np.cumsum(lens) - lens, lens)
    at = np.flatnonzero(w)
    return ids, rows[at], dims[at], w[at]


def accumulate(q: tuple, c: tuple) -> np.ndarray:
    """Dense scores (queries x candidates) by scattering each term's weighted postings."""
    (qid, qrow, qdim, qw), (cid, crow, cdim, cw) = q, c
    score = np.zeros((len(qid), len(cid)), np.int64)
    order, qorder = np.argsort(cdim, kind="stable"), np.argsort(qdim, kind="stable")
    crow, cdim, cw = crow[order], cdim[order], cw[order]
    qrow, qdim, qw = qrow[qorder], qdim[qorder], qw[qorder]
    for term in np.unique(qdim):
        post = slice(*np.searchsorted(cdim, [term, term + 1]))
        rows, weights = crow[post], cw[post]
        full = len(rows) == len(cid)  # every row has the term: rows is 0, 1, 2, ...
        for k in range(*np.searchsorted(qdim, [term, term + 1])):
            if full:
                score[qrow[k]] += qw[k] * weights
            else:
                score[qrow[k], rows] += qw[k] * weights
    return score


def best(score: np.ndarray, qid: np.ndarray, cid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query the k best (score descending, id ascending), own id left out."""
    order = np.argsort(cid, kind="stable")
    cid, out = cid[order], []
    for i, own in enumerate(qid):
        at = np.flatnonzero(cid != own)
        s = score[i, order[at]]
        if len(at) > k:  # all above the k-th score, then the smallest ids among its ties
            bar = np.partition(s, len(s) - k)[len(s) - k]
            top = np.flatnonzero(s > bar)
            keep = np.concatenate([top, np.flatnonzero(s == bar)[:k - len(top)]])
            at, s = at[keep], s[keep]
        out.append((np.full(len(at), own), cid[at], s))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def top_k(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
          scale: int = 1024, query_block: int = 512, row_block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each query row, integer inner product."""
    rows = df.filter(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), quantise(F.col(vector), scale).alias("vec"), is_query.alias("q"))
    asked = rows.filter("q").select("id", "vec")
    slots = max(1, -(-asked.count() // query_block))
    parts = max(1, 2 * shuffle_partitions(df.sparkSession) // slots)
    # A grid: a candidate block goes to one part of every query slot, a query block to all parts of its slot.
    queries = asked.mapInArrow(_pack(query_block), _PACKED).select(
        F.pmod(F.xxhash64("ids"), F.lit(slots)).alias("slot"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
        *[F.col(c).alias(f"q_{c}") for c in ("ids", "lens", "weights")])
    cands = rows.select("id", "vec").mapInArrow(_pack(row_block), _PACKED).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"),
        F.pmod(F.xxhash64("ids"), F.lit(parts)).alias("part"), "ids", "lens", "weights")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                q = _unpack({c: row[f"q_{c}"] for c in ("ids", "lens", "weights")})
                c = _unpack(row)
                who, what, s = best(accumulate(q, c), q[0], c[0], k)
                yield pa.RecordBatch.from_pydict({"query_id": who, "vec_id": what, "score": s})

    found = cands.join(queries, ["slot", "part"]).mapInArrow(score, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
