"""Benchmark decontamination by the q-gram lemma.

Texts and benchmark items are compared in lower case with white space collapsed. An item is cut into
passages (``passage`` characters, one every ``step``; a short item is one passage); a document leaks an item if
a region of it lies within ``k = max_error * length`` edits of one of its passages. ``step=1`` (the registered query
and the pipeline) searches every passage; without ``step`` they overlap by half.

A region within k edits of a passage of m characters shares at least ``m - q + 1 - k q`` of its q-grams
with it, on diagonals (place in the text minus place in the passage) at most k apart. So: look up every
q-gram of the text among those of the items, count hits per item in overlapping diagonal bands (each run of k + 1
diagonals lies in one), keep the passages of which a band holds enough hits, and verify those by banded alignment.
The lemma loses nothing.

It is a map over the documents: no shuffle. The benchmark travels with the function in parts of about
``part_chars`` characters; a larger one means more passes over the documents, not a larger broadcast.
Long texts are worked off in overlapping pieces of ``PIECE`` characters.

Defined cases: a null or empty text leaks nothing; null or empty items match nothing; items under q
characters are searched exactly; repeated rows are judged each; equal matches go to the earliest place;
empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, release_memory

PIECE = 1 << 20
_TABLE = 22
_ONE = np.int64(1) << 40
U = np.uint64


def normalise(text: str | None) -> str:
    return " ".join((text or "").replace("\0", " ").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of every q-gram (sums of powers, built by doubling)."""
    if len(codes) < q:
        return np.zeros(0, U)
    base = codes.astype(U)
    got, have, power = None, 0, U(0x9E3779B97F4A7C15)
    width, at = 1, base
    with np.errstate(over="ignore"):
        while True:
            if q & width:
                n = len(codes) - q + 1
                part = at[have:have + n]
                got = part.copy() if got is None else got * power + part
                have += width
            if width * 2 > q:
                break
            at = at[:-width] * power + at[width:]
            power = power * power
            width *= 2
    got ^= got >> U(32)
    got *= U(0xD6E8FEB86659FD93)
    got ^= got >> U(29)
    return got


@dataclass
class Patterns:
    q: int
    max_error: float
    whole: np.ndarray  # code points of all items, one after the other
    item_at: np.ndarray  # start of each searched item in ``whole``
    at: np.ndarray  # start of each passage in ``whole``, ascending
    size: np.ndarray  # its length
    item: np.ndarray  # its item row
    same: np.ndarray  # the first passage of the same characters
    gram: np.ndarray  # distinct q-gram hashes of the items, sorted
    first: np.ndarray  # start of each one's postings
    place: np.ndarray  # postings: place in ``whole``
    table: np.ndarray  # which leading bits occur

    def allowed(self, size: np.ndarray) -> np.ndarray:
        """k of passages of that length."""
        return np.maximum(np.minimum((size * self.max_error).astype(np.int64), (size - self.q) // self.q), 0)

    @property
    def codes(self) -> list:
        return [self.whole[a:a + n] for a, n in zip(self.at, self.size, strict=True)]

    @property
    def budget(self) -> np.ndarray:
        return self.allowed(self.size)


def compile_patterns(texts: list, q: int = 12, max_error: float = 0.06, passage: int = 100, step: int | None = None) -> Patterns:
    """Passages start every ``step`` characters of an item (None: half a passage) and at its last ``passage`` ones."""
    codes, item_at, at, size, item, begin = [], [], [], [], [], 0
    for i, t in enumerate(texts):
        c = _codes(normalise(t))
        if not len(c):
            continue
        last = max(0, len(c) - passage)
        starts = np.r_[np.arange(0, last, step or max(1, passage // 2)), last]
        codes.append(c)
        item_at.append(begin)
        at.append(starts + begin)
        size.append(np.full(len(starts), min(len(c), passage)))
        item.append(np.full(len(starts), i))
        begin += len(c)
    flat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    at, size, item = flat(at), flat(size), flat(item)
    whole = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    grams = [_grams(c, q) for c in codes]
    place = flat([np.arange(len(g)) + a for g, a in zip(grams, item_at, strict=True)])
    hashed = np.concatenate(grams) if grams else np.zeros(0, U)
    order = np.argsort(hashed, kind="stable")
    gram, first = np.unique(hashed[order], return_index=True)
    table = np.zeros(1 << _TABLE, bool)
    table[(gram >> U(64 - _TABLE)).astype(np.int64)] = True
    return Patterns(q, max_error, whole, np.array(item_at, np.int64), at, size, item, _same(whole, at, size), gram,
                    np.r_[first, len(hashed)], place[order], table)


def _same(whole: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For every passage the first one that holds the same characters (found by hash, compared in full)."""
    same = np.arange(len(at))
    for n in np.unique(size):
        mine = np.flatnonzero(size == n)
        _, first, back = np.unique(_grams(whole, int(n))[at[mine]], return_index=True, return_inverse=True)
        twin = mine[first][back]
        ok = np.ones(len(mine), bool)
        for i in range(int(n)):
            ok &= whole[at[mine] + i] == whole[at[twin] + i]
        same[mine[ok]] = twin[ok]
    return same


def _bands(p: Patterns, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, first diagonal) of every band that reaches its passage's bound."""
    h = _grams(codes, p.q)
    at = np.flatnonzero(p.table[(h >> U(64 - _TABLE)).astype(np.int64)])
    g = np.minimum(np.searchsorted(p.gram, h[at]), max(len(p.gram) - 1, 0))
    real = p.gram[g] == h[at]
    at, g = at[real], g[real]
    count = p.first[g + 1] - p.first[g]
    step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    place = p.place[np.repeat(p.first[g], count) + step]
    who = np.searchsorted(p.item_at, place, "right") - 1
    size = p.size[np.searchsorted(p.at, p.item_at)][who]  # all passages of an item have one length
    budget = p.allowed(size)
    diagonal = np.repeat(at, count) - place + len(p.whole)  # never negative
    # Band b holds the diagonals [b, b + 2) * stride: each hit counts in two of them.
    band = diagonal // (budget + 1)
    who, band, place, size, budget = (np.concatenate(x) for x in ((who, who), (band, band - 1), (place, place), (size, size), (budget, budget)))
    order = np.lexsort((place, band, who))
    who, band, place, size, budget = (x[order] for x in (who, band, place, size, budget))
    # Hits i to i + bound - 1 of a band lie in the passages that start in [low, high].
    bound = size - p.q + 1 - budget * p.q
    end = np.arange(len(who)) + bound - 1
    ok = end < len(who)
    end = np.minimum(end, len(who) - 1)
    ok &= (who[end] == who) & (band[end] == band)
    low, high = place[end] - (size - p.q), place
    who, band, budget, low, high = (x[ok] for x in (who, band, budget, low, high))
    a = np.maximum(np.searchsorted(p.at, low), np.searchsorted(p.at, p.item_at)[who])
    z = np.searchsorted(p.at, high, "right")  # high lies in the item
    # Both ends ascend in a band: what the hit before has named is left out.
    again = np.r_[False, (who[1:] == who[:-1]) & (band[1:] == band[:-1])][:len(who)]
    a = np.where(again, np.maximum(a, np.r_[0, z[:-1]][:len(a)]), a)
    n = np.maximum(z - a, 0)
    passage = np.repeat(a, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(band * (budget + 1) - len(p.whole), n) + p.at[passage]
    return passage, first


def align(pattern: np.ndarray, codes: np.ndarray, first: np.ndarray, width: int, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Banded alignment of whole patterns (one a row, or one for all) inside a text: for bands of ``width`` diagonals
    from ``first`` on (edits, start, end) of the best region, edits ``budget + 1`` if none is within the budget."""
    pattern = np.atleast_2d(pattern)
    m, bands = pattern.shape[1], len(first)
    low = first - budget
    b = width + 2 * budget
    column = np.arange(b, dtype=np.int64)
    # Cost in the high bits, start in the low ones: the least of both is one minimum.
    state = np.broadcast_to(np.clip(low[:, None] + column, 0, len(codes)), (bands, b)).astype(np.int64)
    state = np.where(((low[:, None] + column) < 0) | ((low[:, None] + column) > len(codes)), (budget + 1) * _ONE, state)
    padded = np.concatenate([codes, np.full(1, 0xFFFFFFFF, np.uint32)])
    for i in range(m):
        at = low[:, None] + column + i
        inside = (at >= 0) & (at < len(codes))
        here = padded[np.where(inside, at, len(codes))]
        new = state + np.where(here == pattern[:, i, None], 0, _ONE)  # match or replace
        new[~inside] = (budget + 1) * _ONE
        new[:, :-1] = np.minimum(new[:, :-1], state[:, 1:] + _ONE)  # skip a pattern character
        # skip text characters: running minimum along the row
        new = np.minimum.accumulate(new - column * _ONE, axis=1) + column * _ONE
        state = np.minimum(new, (budget + 1) * _ONE)
    end = low[:, None] + column + m
    state = np.where(end > len(codes), (budget + 1) * _ONE, state)
    best = state.argmin(axis=1)
    value = state[np.arange(bands), best]
    return value // _ONE, value % _ONE, np.minimum(end[np.arange(bands), best], len(codes))


def matches(p: Patterns, codes: np.ndarray) -> np.ndarray:
    """Rows (passage, edits, start, end) of all verified regions of one array of code points."""
    out = [np.zeros((0, 4), np.int64)]
    reach = int((p.size + p.allowed(p.size)).max(initial=0))
    for a in range(0, max(len(codes), 1), PIECE):
        piece = codes[a:a + PIECE + reach + p.q]
        for part in (_near(p, piece), _short(p, piece)):
            out.append(part + [0, 0, a, a])
    return np.concatenate(out)


def _near(p: Patterns, piece: np.ndarray) -> np.ndarray:
    if len(piece) < p.q or not len(p.gram):
        return np.zeros((0, 4), np.int64)
    who, first = _bands(p, piece)
    out = np.zeros((len(who), 4), np.int64)
    ok = np.zeros(len(who), bool)
    for m in np.unique(p.size[who]):
        mine = np.flatnonzero(p.size[who] == m)
        k = int(p.allowed(m))
        # Passages of the same characters in the same band are aligned once.
        (same, low), back = np.unique(np.stack([p.same[who[mine]], first[mine]]), axis=1, return_inverse=True)
        told = [align(p.whole[p.at[same[x:x + 2000], None] + np.arange(m)], piece, low[x:x + 2000], 2 * (k + 1), k)
                for x in range(0, len(same), 2000)]
        told = np.concatenate([np.stack(t, axis=1) for t in told])[back.reshape(-1)]
        out[mine] = np.column_stack([who[mine], told])
        ok[mine] = told[:, 0] <= k
    return out[ok]


def _short(p: Patterns, piece: np.ndarray) -> np.ndarray:
    """Places of the items under q characters, which allow no edits."""
    out = [np.zeros((0, 4), np.int64)]
    for m in np.unique(p.size[p.size < p.q]):
        mine = np.flatnonzero(p.size == m)
        hashed = _grams(p.whole, int(m))[p.at[mine]]
        order = np.argsort(hashed, kind="stable")
        mine, hashed, h = mine[order], hashed[order], _grams(piece, int(m))
        a, z = np.searchsorted(hashed, h), np.searchsorted(hashed, h, "right")
        place = np.repeat(np.arange(len(h)), z - a)
        who = mine[np.arange(len(place)) - np.repeat(np.cumsum(z - a) - z, z - a)]
        ok = (p.whole[p.at[who, None] + np.arange(m)] == piece[place[:, None] + np.arange(m)]).all(axis=1)
        who, place = who[ok], place[ok]
        out.append(np.column_stack([who, np.zeros(len(who), np.int64), place, place + m]))
    return np.concatenate(out)


_APART = 0xFFFFFFFE  # no code point


def _leaks(p: Patterns, texts: list) -> dict:
    """{(row, item): (passages, edits, start, end)}; edits, start and end of the best passage.

    Between two texts stand more separators than any passage may have edits; they match nothing, so no region reaches from one text to the next.
    """
    apart = np.full(int(p.budget.max(initial=0)) + 1, _APART, np.uint32)
    parts, starts, size, at = [], [], [], 0
    for t in texts:
        c = _codes(normalise(t))
        starts.append(at)
        size.append(len(c))
        parts += [c, apart]
        at += len(c) + len(apart)
    if not parts:
        return {}
    starts, size = np.array(starts), np.array(size)
    who, edits, start, end = matches(p, np.concatenate(parts)).T
    # A region may begin or end in separators (each one an edit): its text is the one it ends in, its places are that text's.
    row = np.searchsorted(starts, start, "right") - 1
    row = np.where(start >= starts[row] + size[row], np.minimum(row + 1, len(starts) - 1), row)
    start, end, item = np.maximum(start, starts[row]), np.minimum(end, starts[row] + size[row]), p.item[who]
    order = np.lexsort((who, end, start, edits, item, row))
    who, edits, start, end, row, item = (x[order] for x in (who, edits, start, end, row, item))
    passages = np.unique(np.stack([row, item, who]), axis=1)[:2]
    best = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1])][:len(row)])
    _, n = np.unique(passages, axis=1, return_counts=True)
    values = np.stack([n, edits[best], start[best] - starts[row[best]], end[best] - starts[row[best]]], axis=1)
    return {(r, i): tuple(v) for r, i, v in zip(row[best].tolist(), item[best].tolist(), values.tolist(), strict=True)}


def _slices(texts: list, size: int = 1 << 21) -> Iterator[tuple[int, list]]:
    a, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= size:
            yield a, texts[a:i + 1]
            a, n = i + 1, 0
    if a < len(texts):
        yield a, texts[a:]


def _parts(benchmark: DataFrame, item_id: str, text: str, part_chars: int) -> Iterator[tuple[list, list, bool]]:
    """The benchmark in parts of about that many characters: (ids, texts, whether it is the only part) each."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(text).cast("string").alias("text")).filter("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-chars // part_chars))
    for k in range(n):
        rows = (items if n == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k)).orderBy("item", "text").collect()
        yield [r["item"] for r in rows], [r["text"] for r in rows], n == 1


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", part_chars: int = 1_000_000, **how) -> DataFrame:
    """(id, item_id, n_passages, edits, start, end): one row per document and item that it leaks.

    Places count characters of the normalised text, for the passage with the fewest edits.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col(id_col).alias(id_col), F.col(text).cast("string").alias("_text"))
    schema = rows.selectExpr(f"`{id_col}`", "cast(null as long) as item_id", "0L as n_passages", "0L as edits", "0L as start", "0L as `end`").schema
    arrow = to_arrow_schema(schema)
    out, scratch = None, Scratch(docs.sparkSession)
    for ids, texts, alone in _parts(benchmark, item_id, item_text, part_chars):
        p = compile_patterns(texts, **how)

        def look(batches: Iterator[pa.RecordBatch], p=p, ids=ids) -> Iterator[pa.RecordBatch]:
            release_memory()
            for b in batches:
                for a, some in _slices(b["_text"].to_pylist()):
                    found = sorted(_leaks(p, some).items())
                    if found:
                        at = pa.array([a + row for (row, _), _ in found], pa.int64())
                        rest = [[ids[i] for (_, i), _ in found], *zip(*(v for _, v in found), strict=True)]
                        yield pa.RecordBatch.from_arrays([b.column(0).take(at), *(pa.array(c, pa.int64()) for c in rest)], schema=arrow)

        part = rows.mapInArrow(look, schema)
        if not alone:  # written part by part, so that one part's patterns are held at a time
            part = scratch.write(part, "leaks")
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               part_chars: int = 1_000_000, **how) -> DataFrame:
    """The rows of ``docs`` that leak no item, all columns as they are."""
    scratch = Scratch(docs.sparkSession)
    for _, texts, alone in _parts(benchmark, item_id, item_text, part_chars):
        p = compile_patterns(texts, **how)
        place = docs.columns.index(text)

        def keep(batches: Iterator[pa.RecordBatch], p=p, place=place) -> Iterator[pa.RecordBatch]:
            release_memory()
            for b in batches:
                gone = np.zeros(b.num_rows, bool)
                for a, some in _slices(b.column(place).to_pylist()):
                    gone[[a + row for row, _ in _leaks(p, some)]] = True
                yield b.filter(pa.array(~gone))

        docs = docs.mapInArrow(keep, docs.schema)
        if not alone:
            docs = scratch.write(docs, "no-leaks")
            scratch.close(keep=1, forget=False)
    return docs
