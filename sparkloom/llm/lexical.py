"""Ranked lexical search over bit-sliced Bloom signatures, rescored exactly.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. A document's score for an
item is an integer: the sum over the item's terms, once each, of

    w * ((1000000000 * tf) div (1000 * tf + 8 * m)),  w = floor(1000 ln((2N + 2) / (2df + 1))),  m = 10 + (90 n N) div L

Index. Texts (different ones; copies collapse to a count first) are dealt to blocks of rows of similar size. A block is a bit
matrix: one *slice* (a bitmap over the block's rows) per signature position. A term that occurs at least 2**j times in a row sets
two positions hashed from (term, j) there, for each level j. So the AND of a term's slices holds every row that has the term that
often, and some more: signatures overestimate. The width follows the rows' size (``bits`` per entry), so long texts do not saturate.
Next to it stand the compressed texts, lengths and greatest term counts, and per input slice the vocabulary with its document
frequencies, from which N, L and df are summed.

Search. A level bounds tf, so a term's slices bound its share of the score; weighted sums over an item's terms bound
every row of a block. Each task keeps per item the k best exact scores so far; a row is left out only if its bound is below the k-th of them,
all others are decompressed and scored exactly (the rows with the greatest bounds first). The tasks' k best meet in a window.
Copies come back at the end: a text stands for at most its k smallest ids.

Memory: a block holds at most ``BLOCK_BYTES`` of text or one text; items travel in parts of ``part_bytes`` of text, one search each, so neither the
driver nor a task ever holds a larger query set. Results are k rows an item.

Defined cases: null and empty texts have no terms and are no documents; null ids come last among equal scores; rows that repeat an id
and text are ranked one by one; rows of ``items`` that repeat id and text are one item, other texts under the same id are items of their own;
an item without terms, or whose terms no document holds, has no rows; empty tables give no rows; a very long text is a block of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, mix64

U = np.uint64
# The contract's bytes between terms.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LEVELS = 8
HASHES = 2
SLICE_BYTES = 6 << 20
BLOCK_BYTES = 3 << 20
BLOCK_ROWS = 1024
CELLS = 4 << 20  # term x row cells of a search step
GROUP_TERMS = 4096  # terms of items searched together
_LAST = (1 << 63) - 1
INDEX = ("firsts binary, copies binary, digests binary, lens binary, peaks binary, width int, slices binary, texts array<binary>, "
         "vocab array<string>, df array<long>, docs long, tokens long")
_NAMES = [f.split()[0] for f in INDEX.split(", ")]
_HITS = "item int, digest binary, first_id long, score long"


def terms_of(text: str | None) -> list[str]:
    """The distinct terms of one text."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return sorted({t for t in re.split(GAP, low) if t})


def term_counts(texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """(vocabulary, row, vocabulary number, occurrences) of the distinct terms of every text, rows ascending."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts), GAP)
    flat, offs = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    code = flat.dictionary_encode()
    vocab = code.dictionary.to_pylist()
    number = np.asarray(code.indices).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(offs))
    if "" in vocab:
        real = number != vocab.index("")
        number, row = number[real], row[real]
    key, n = np.unique(row * max(len(vocab), 1) + number, return_counts=True)
    return vocab, key // max(len(vocab), 1), key % max(len(vocab), 1), n


def positions(hashes: np.ndarray, level: int, k: int, width: int) -> np.ndarray:
    """Signature position of hashed terms at a level."""
    salt = U((level * HASHES + k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix64(hashes + salt) % U(width)).astype(np.int64)


def hashes_of(words: list) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], U)


def _empty() -> dict:
    return {"firsts": b"", "copies": b"", "digests": b"", "lens": b"", "peaks": b"", "width": 0, "slices": b"", "texts": [],
            "vocab": [], "df": [], "docs": 0, "tokens": 0}


def _row(**cells) -> pa.RecordBatch:
    row = _empty() | cells
    types = [pa.binary()] * 5 + [pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in zip(_NAMES, types, strict=True)], names=_NAMES)


class _Block:
    """Rows of one size class that wait for a signature matrix."""

    def __init__(self):
        self.meta, self.digests, self.texts, self.entries, self.rows, self.bytes = [], [], [], [], 0, 0

    def matrix(self, width: int) -> bytes:
        bits = np.zeros((width, self.rows), bool)
        row, hashed, tf = (np.concatenate(x) for x in zip(*self.entries, strict=True))
        for level in range(LEVELS):
            at = np.flatnonzero(tf >= 1 << level)
            for k in range(HASHES):
                bits[positions(hashed[at], level, k, width), row[at]] = True
        return np.packbits(bits, axis=1).tobytes()

    def close(self, width: int) -> pa.RecordBatch:
        first, copies, n, peak = np.concatenate(self.meta, axis=1)
        return _row(firsts=first.tobytes(), copies=copies.tobytes(), digests=b"".join(self.digests), lens=n.tobytes(), peaks=peak.tobytes(),
                    width=width, slices=self.matrix(width), texts=self.texts)


def _build(bits: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        open_blocks: dict[int, _Block] = {}
        for b in batches:
            size = np.asarray(pc.binary_length(b["text"])).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1).tolist(), b.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(x, y - x)
                vocab, row, number, tf = term_counts(part["text"])
                if not len(row):
                    continue
                copies = np.asarray(part["copies"]).astype(np.int64)
                held = np.bincount(number, weights=copies[row], minlength=len(vocab)).astype(np.int64)
                n = np.bincount(row, weights=tf, minlength=part.num_rows).astype(np.int64)
                yield _row(vocab=[v for v, c in zip(vocab, held.tolist(), strict=True) if c], df=held[held > 0].tolist(),
                           docs=int(copies[n > 0].sum()), tokens=int((copies * n).sum()))
                peak = np.zeros(part.num_rows, np.int64)
                np.maximum.at(peak, row, tf)
                entries = np.bincount(row, weights=np.minimum(np.log2(tf).astype(np.int64) + 1, LEVELS), minlength=part.num_rows).astype(np.int64)
                kind = np.ceil(np.log2(np.maximum(entries, 32))).astype(np.int64)
                hashed = hashes_of(vocab)[number]
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
                first = np.asarray(part["first_id"]).astype(np.int64)
                for r in np.flatnonzero(n):
                    k = int(kind[r])
                    block = open_blocks.setdefault(k, _Block())
                    if block.rows and (block.bytes + size[x + r] > BLOCK_BYTES or block.rows >= BLOCK_ROWS):
                        yield block.close(bits << k)
                        block = open_blocks[k] = _Block()
                    mine = slice(bounds[r], bounds[r + 1])
                    block.entries.append((np.full(mine.stop - mine.start, block.rows), hashed[mine], tf[mine]))
                    block.meta.append(np.array([[first[r]], [copies[r]], [n[r]], [peak[r]]]))
                    block.digests.append(part["digest"][int(r)].as_py())
                    block.texts.append(press.compress(part["text"][int(r)].as_buffer()))
                    block.rows, block.bytes = block.rows + 1, block.bytes + int(size[x + r])
        for k, block in open_blocks.items():
            yield block.close(bits << k)

    return build


def build_index(df: DataFrame, id_col: str = "doc_id", text: str = "text", bits: int = 12) -> DataFrame:
    """Blocks of bit-sliced signatures (and vocabulary rows) of every different text; the caller writes the table."""
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.col(text).cast("string").alias("text"))
    docs = docs.filter("text is not null and text <> ''")
    texts = docs.groupBy(_digest(F.col("text")).alias("digest")).agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"))
    return texts.mapInArrow(_build(bits), INDEX)


def _digest(text):
    return F.unhex(F.sha2(text.cast("string").cast("binary"), 256))


@dataclass
class Group:
    """Items searched together: their numbers, the terms (hash, weight) and each item's places among the terms."""

    items: list
    words: list
    hashes: np.ndarray
    weight: np.ndarray
    places: list


def groups_of(items: list, weight: dict) -> list[Group]:
    """Groups of (number, terms) with at most ``GROUP_TERMS`` terms together (or one item)."""
    out, now, words = [], [], {}
    for number, terms in items:
        terms = [t for t in terms if weight.get(t, 0) > 0]
        if not terms:
            continue
        if now and len(words) + len(terms) > GROUP_TERMS:
            out.append((now, words))
            now, words = [], {}
        now.append((number, np.array([words.setdefault(t, len(words)) for t in terms])))
    if now:
        out.append((now, words))
    return [Group([n for n, _ in now], list(words), hashes_of(list(words)), np.array([weight[t] for t in words], np.int64), [p for _, p in now])
            for now, words in out]


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Block:
    """Rows ``lo`` to ``hi`` (``lo`` a multiple of 8) of one block of the index: bounds and exact scores."""

    def __init__(self, row: dict, total_docs: int, total_tokens: int, lo: int, hi: int):
        self.first, n, peak = (np.frombuffer(row[c], np.int64)[lo:hi] for c in ("firsts", "lens", "peaks"))
        self.rows, self.width, self.texts = len(self.first), row["width"], row["texts"][lo:hi]
        self.digests = [row["digests"][i * 32:i * 32 + 32] for i in range(lo, lo + self.rows)]
        self.bits = np.frombuffer(row["slices"], np.uint8).reshape(self.width, -1)[:, lo // 8:-(-hi // 8)]
        self.m = np.array([10 + 90 * x * total_docs // total_tokens for x in n.tolist()], np.int64)
        # Greatest gain of a term seen up to each level: tf is below 2**(level + 1), and never above the row's greatest count.
        caps = [np.minimum((1 << (j + 1)) - 1, peak) if j < LEVELS - 1 else peak for j in range(LEVELS)]
        self.steps = np.diff(np.array([gain(c, self.m) for c in caps]), axis=0, prepend=0)

    def bounds(self, g: Group) -> np.ndarray:
        """Upper bounds (items x rows) as weighted sums of slices."""
        share = np.zeros((len(g.words), self.rows), np.int64)
        live, held = np.arange(len(g.words)), None
        for level in range(LEVELS):
            for k in range(HASHES):
                found = self.bits[positions(g.hashes[live], level, k, self.width)]
                held = found if held is None else held & found
            some = held.any(axis=1)
            live, held = live[some], held[some]
            if not len(live):
                break
            share[live] += np.unpackbits(held, axis=1, count=self.rows) * self.steps[level]
        share *= g.weight[:, None]
        return np.array([share[p].sum(axis=0) for p in g.places])

    def exact(self, g: Group, rows: np.ndarray, number: dict, press) -> np.ndarray:
        """Gains times weights (rows x terms) from the texts themselves."""
        texts = pa.array([press.decompress(self.texts[r]).decode() for r in rows], pa.string())
        vocab, at, code, tf = term_counts(texts)
        place = np.array([number.get(w, -1) for w in vocab], np.int64)[code] if len(code) else code
        ok = place >= 0
        out = np.zeros((len(rows), len(g.words)), np.int64)
        out[at[ok], place[ok]] = gain(tf[ok], self.m[rows[at[ok]]]) * g.weight[place[ok]]
        return out


class _Best:
    """The k best (score, then least id) of every item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.first, self.digest = k, np.zeros(0, np.int64), np.zeros(0, np.int64), []

    @property
    def bar(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, first: np.ndarray, digest: list) -> None:
        s, f, d = np.r_[self.score, score], np.r_[self.first, first], self.digest + digest
        order = np.lexsort((f, -s))[:self.k]
        self.score, self.first, self.digest = s[order], f[order], [d[i] for i in order]


def _steps(batch: pa.RecordBatch, groups: list[Group], numbers: list[dict]) -> Iterator[tuple[dict, Group, dict, int, int]]:
    """(index row, group, its term numbers, row range) with at most ``CELLS`` cells, eight rows at least."""
    for x in range(batch.num_rows):
        row = batch.slice(x, 1).to_pylist()[0]
        rows = len(row["texts"])
        for g, number in zip(groups, numbers, strict=True):
            step = max(8, CELLS // len(g.words) // 8 * 8)
            for lo in range(0, rows, step):
                yield row, g, number, lo, min(lo + step, rows)


def _search(groups: list[Group], total_docs: int, total_tokens: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        best = {i: _Best(k) for g in groups for i in g.items}
        numbers = [{w: i for i, w in enumerate(g.words)} for g in groups]
        for b in batches:
            for row, g, number, lo, hi in _steps(b, groups, numbers):
                block = Block(row, total_docs, total_tokens, lo, hi)
                upper = block.bounds(g)
                cells = np.zeros((block.rows, len(g.words)), np.int64)
                known = np.zeros(block.rows, bool)
                done = np.zeros(upper.shape, bool)
                for turn in range(2):  # the greatest bounds raise the bar, then all that still reach it
                    want = []
                    for i, (item, top) in enumerate(zip(g.items, upper, strict=True)):
                        at = np.flatnonzero((top >= best[item].bar) & ~done[i])
                        if turn == 0 and len(at) > k:
                            at = at[np.argpartition(-top[at], k - 1)[:k]]
                        want.append(at)
                        done[i, at] = True
                    fresh = np.unique(np.concatenate(want))
                    fresh = fresh[~known[fresh]]
                    for a in range(0, len(fresh), 256):
                        some = fresh[a:a + 256]
                        cells[some] = block.exact(g, some, number, press)
                    known[fresh] = True
                    for i, (item, at) in enumerate(zip(g.items, want, strict=True)):
                        if len(at):
                            score = cells[np.ix_(at, g.places[i])].sum(axis=1)
                            ok = score >= best[item].bar
                            if ok.any():
                                at = at[ok]
                                best[item].add(score[ok], block.first[at], [block.digests[r] for r in at])
        rows = [(i, d, f, s) for i, t in best.items() for d, f, s in zip(t.digest, t.first.tolist(), t.score.tolist(), strict=True)]
        if rows:
            item, digest, first, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(digest, pa.binary()), pa.array(first, pa.int64()),
                                              pa.array(score, pa.int64())], names=["item", "digest", "first_id", "score"])

    return search


def _weights(index: DataFrame, words: list, total_docs: int) -> dict:
    """w of every word some document holds."""
    spark = index.sparkSession
    asked = spark.createDataFrame([(w,) for w in words], "word string")
    seen = index.filter("docs > 0").select(F.explode(F.arrays_zip("vocab", "df")).alias("t")).select(F.col("t.vocab").alias("word"), F.col("t.df").alias("df"))
    # The asked words of one part are bounded (part_bytes of items), whatever the index holds.
    held = seen.join(F.broadcast(asked), "word", "left_semi").groupBy("word").agg(F.sum("df").alias("df"))
    return {r["word"]: int(np.floor(1000 * np.log((2 * total_docs + 2) / (2 * r["df"] + 1)))) for r in held.collect()}


def search(df: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           bits: int = 12, part_bytes: int = 4 << 20) -> DataFrame:
    """(item id, rank, id, score): the k best documents of every item, equal scores by ascending id."""
    spark, scratch = df.sparkSession, Scratch(df.sparkSession)
    schema = "item int, {} {}, rank int, {} {}, score long".format(item_id, dict(items.dtypes)[item_id], id_col, dict(df.dtypes)[id_col])
    index = scratch.write(build_index(df, id_col, text, bits), "signatures")
    size = index.agg(F.sum("docs").alias("n"), F.sum("tokens").alias("l")).first()
    asked = items.select(F.col(item_id).alias("id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text")).distinct()
    weighs = asked.agg(F.sum(F.octet_length("text"))).first()[0]
    parts = -(-int(weighs or 0) // part_bytes)
    out = None
    for p in range(parts if size["n"] else 0):
        mine = asked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == p).collect()
        terms = [terms_of(r["text"]) for r in mine]
        weight = _weights(index, sorted({t for ts in terms for t in ts}), size["n"])
        groups = groups_of(list(enumerate(terms)), weight)
        if not groups:
            continue
        blocks = index.filter("width > 0").select("firsts", "digests", "lens", "peaks", "width", "slices", "texts")
        hits = blocks.mapInArrow(_search(groups, size["n"], size["l"], k), _HITS)
        order = Window.partitionBy("item").orderBy(F.desc("score"), "first_id")
        hits = scratch.write(hits.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("item", "digest", "score"), "hits")
        names = spark.createDataFrame([(i, r["id"]) for i, r in enumerate(mine)], f"item int, {item_id} {dict(items.dtypes)[item_id]}")
        ranked = _with_copies(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")), hits, k)
        ranked = ranked.join(F.broadcast(names), "item").select("item", item_id, "rank", F.col("id").alias(id_col), "score")
        ranked = scratch.write(ranked, "ranked")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = spark.createDataFrame([], schema)
    out = scratch.write(out, "lexical")
    scratch.close(keep=1)
    return out.drop("item")


def _with_copies(docs: DataFrame, hits: DataFrame, k: int) -> DataFrame:
    """(item, rank, id, score): every text replaced by its k smallest ids, ranked again."""
    # At most k texts an item of a bounded part: the list of texts is small, whatever the number of documents.
    texts = F.broadcast(hits.select("digest").distinct())
    rows = docs.select("id", _digest(F.col("text")).alias("digest")).join(texts, "digest")
    least = Window.partitionBy("digest").orderBy(F.asc_nulls_last("id"))
    rows = rows.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= k).drop("place")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = hits.join(F.broadcast(rows), "digest").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("item", "rank", "id", "score")
