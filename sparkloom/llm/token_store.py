"""Token ids in a binary format: one wavelet matrix per shard.

A shard file (little-endian):

    magic ``WMTX`` | u32 version | u64 documents | u64 tokens | u32 planes
    documents x i64 id | documents x u8 id is null | documents x i64 tokens of the document
    per plane, from the highest bit: u64 zeros | tokens bits (LSB first) | u32 ones before each block of 512

The planes are the succinct bit-planes of the ids: ``access``, ``rank`` (count in a prefix) and ``select``
(n-th occurrence) read O(planes) words each; ``decode`` rebuilds a whole shard.

``write_shards`` range-partitions the documents by id, encodes inside the tasks and writes the shard
files as rows of a Parquet folder (any store Spark writes to; the compression codec is Parquet's).
A shard closes after ``shard_tokens`` ids, so it is bounded whatever the documents' lengths (one
document is never cut). ``read_tokens`` reads them back.

Defined cases: a null or empty text has the end id only; null ids come first; rows that repeat an id
follow each other by text; an empty table gives no shards and no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import fragments as fr
from .common import ragged_take, shuffle_partitions

MAGIC, VERSION, BLOCK = b"WMTX", 1, 512
CACHE = 600_000
SHARDS = "part int, shard int, n_docs long, n_tokens long, data binary"
_HEAD = np.dtype([("magic", "S4"), ("version", "<u4"), ("docs", "<u8"), ("tokens", "<u8"), ("planes", "<u4")])


def pack(ids: np.ndarray, doc_ids: np.ndarray, null: np.ndarray, lens: np.ndarray) -> bytes:
    """The file image of a shard; ``ids`` are the documents' tokens one after the other."""
    n = len(ids)
    planes = max(1, int(ids.max()).bit_length()) if n else 1
    out = [np.array([(MAGIC, VERSION, len(doc_ids), n, planes)], _HEAD).tobytes(), doc_ids.astype("<i8").tobytes(),
           null.astype("u1").tobytes(), lens.astype("<i8").tobytes()]
    x = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    for bit in range(planes - 1, -1, -1):
        one = (x & x.dtype.type(1 << bit)) != 0
        packed = np.packbits(one, bitorder="little")
        padded = np.zeros(-(-n // BLOCK) * BLOCK // 8, np.uint8)
        padded[:len(packed)] = packed
        ones = np.bitwise_count(padded.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
        low = x[~one]
        out += [np.uint64(len(low)).tobytes(), packed.tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
        x = np.concatenate([low, x[one]])
    return b"".join(out)


class WaveletMatrix:
    """Reader of one shard file."""

    def __init__(self, data: bytes):
        head = np.frombuffer(data, _HEAD, 1)[0]
        if head["magic"] != MAGIC or head["version"] != VERSION:
            raise ValueError("not a wavelet-matrix shard of this version")
        docs, self.n, self.planes = int(head["docs"]), int(head["tokens"]), int(head["planes"])
        at = _HEAD.itemsize

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(data, kind, count, at)
            at += got.nbytes
            return got

        self.doc_ids, self.null, self.lens = take("<i8", docs), take("u1", docs) != 0, take("<i8", docs)
        self.starts = np.cumsum(self.lens) - self.lens
        self.levels = []
        for _ in range(self.planes):
            zeros = int(take("<u8", 1)[0])
            self.levels.append((zeros, take("u1", -(-self.n // 8)), take("<u4", -(-self.n // BLOCK))))

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        _, bits, ones = self.levels[level]
        if i <= 0:
            return 0
        block = (i - 1) // BLOCK
        part = bits[block * BLOCK // 8:-(-i // 8)]
        count = int(np.bitwise_count(part).sum())
        if i % 8:
            count -= int(part[-1] >> (i % 8)).bit_count()
        return int(ones[block]) + count

    def access(self, i: int) -> int:
        """The token at place i of the shard."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (zeros, bits, _) in enumerate(self.levels):
            one = bits[i >> 3] >> (i & 7) & 1
            value = value << 1 | int(one)
            i = zeros + self._rank1(level, i) if one else i - self._rank1(level, i)
        return value

    def _interval(self, token: int, end: int) -> tuple[int, int]:
        """The token's interval at the bottom, of those among the first ``end`` places."""
        a, b = 0, end
        if token >> self.planes:
            return 0, 0
        for level, (zeros, _, _) in enumerate(self.levels):
            ra, rb = self._rank1(level, a), self._rank1(level, b)
            a, b = (zeros + ra, zeros + rb) if token >> (self.planes - 1 - level) & 1 else (a - ra, b - rb)
        return a, b

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token among the first ``end`` places."""
        a, b = self._interval(token, end)
        return b - a

    def _select_bit(self, level: int, one: int, k: int) -> int:
        """Place of the k-th (from 0) bit with that value: binary search in the directory, then in a block."""
        _, bits, ones = self.levels[level]
        before = ones.astype(np.int64) if one else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, k, "right")) - 1
        part = np.unpackbits(bits[block * BLOCK // 8:(block + 1) * BLOCK // 8], bitorder="little")
        part = part[:min(BLOCK, self.n - block * BLOCK)]
        return block * BLOCK + int(np.flatnonzero(part == one)[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of a token."""
        a, b = self._interval(token, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(self.planes - 1, -1, -1):
            one = token >> (self.planes - 1 - level) & 1
            i = self._select_bit(level, one, i - self.levels[level][0] if one else i)
        return i

    def decode(self) -> np.ndarray:
        """All tokens of the shard, planes undone from the last to the first."""
        x = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for level in range(self.planes - 1, -1, -1):
            zeros, bits, _ = self.levels[level]
            one = np.unpackbits(bits, count=self.n, bitorder="little").view(bool)
            y = np.empty_like(x)
            y[~one] = x[:zeros]
            y[one] = x[zeros:] | x.dtype.type(1 << (self.planes - 1 - level))
            x = y
        return x


# The byte-level pattern for characters below U+0250, whose classes no Unicode version changes.
_SPACE, _LETTER, _NUMBER = "\\t-\\r \\x85\\xa0", "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc\xbd\xbe"
_PART = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_KNOWN = re.compile("[\x00-\u024f]*")
_WORD = re.compile(f" ?[{_LETTER}]+")


def parts(unit: str) -> list:
    """A fragment cut further, where the library's own pattern cuts: a word and its punctuation repeat more
    often than both together. Fragments with other characters or a possible special string stay whole."""
    return [unit] if "<|" in unit or not _KNOWN.fullmatch(unit) else _PART.findall(unit)


# Characters that stand for the bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: b if b in _PLAIN else 256 + sum(x not in _PLAIN for x in range(b)) for b in range(256)}


@lru_cache(maxsize=4)
def cuts_known(spec: str) -> bool:
    """Whether the tokenizer is byte-level BPE with the pattern above and nothing before or after it: only then may texts be
    cut at spaces and single words go to the bare model. Any other one encodes whole texts."""
    t = json.loads(spec)
    pre, model, post = t.get("pre_tokenizer") or {}, t["model"], t.get("post_processor")
    level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    special = all("<|" in x["content"] and not (x["lstrip"] or x["rstrip"] or x["single_word"]) for x in t.get("added_tokens", []))
    return level and plain and special and not t.get("normalizer") and (post is None or post.get("type") == "ByteLevel")


def _ids_of(new: list, spec: str) -> dict:
    """{part: its ids as bytes}. Single words go straight to the library's BPE model (they are what its own
    pattern cuts); anything else through its whole pipeline."""
    t = fr.tokenizer(spec)
    words, rest, out = [p for p in new if _WORD.fullmatch(p)], [p for p in new if not _WORD.fullmatch(p)], {}
    for a in range(0, len(rest), 20_000):
        some = rest[a:a + 20_000]
        out.update((u, array("I", e.ids).tobytes()) for u, e in zip(some, t.encode_batch_fast(some, add_special_tokens=False), strict=True))
    cut = t.model.tokenize
    for w in words:
        out[w] = array("I", [x.id for x in cut(w.encode().decode("latin-1").translate(_BYTE_CHARS))]).tobytes()
    return out


def _class(chars) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


_LOW = [chr(c) for c in range(0x250)]
_GAP_CHARS = _class(chr(c) for c in range(0x3001) if chr(c).isspace())
_OPENS, _ENDS = rf"\A(?:\z|[{_GAP_CHARS}])", rf"(?:\A|[{_GAP_CHARS}])\z"
# A word and what follows it up to the fragment's end, neither letter, number nor space ("<" may open a special string).
_SIMPLE = (rf"\A(?P<word> ?[{_class(c for c in _LOW if re.match(f'[{_LETTER}]', c))}]+)"
           rf"(?P<rest>[{_class(c for c in _LOW if not re.match(f'[{_SPACE}{_LETTER}{_NUMBER}<]', c))}]*)\z")


def _units(pieces: pa.Array, spaced: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``fragments.fragments`` for byte-level BPE, in Arrow: (distinct fragments, number of each occurrence's, bounds per piece)."""
    words = pc.split_pattern(pieces, " ")
    offs = np.asarray(words.offsets).astype(np.int64)
    offs = offs - offs[0]
    code = words.flatten().dictionary_encode()
    vocab, num = code.dictionary, np.asarray(code.indices).astype(np.int64)
    ends, opens = (np.asarray(pc.match_substring_regex(vocab, x)).astype(bool) for x in (_ENDS, _OPENS))
    first = np.zeros(len(num), bool)
    first[offs[:-1]] = True
    lead = np.ones(len(num), bool)
    lead[offs[:-1]] = spaced
    start = np.ones(len(num), bool)
    start[1:] = first[1:] | ~(ends[num[:-1]] | opens[num[1:]])
    heads = np.flatnonzero(start)
    size = np.diff(np.r_[heads, len(num)])
    plain = size == 1
    key = (num * 2 + lead)[heads]
    used = np.zeros(2 * len(vocab), bool)
    used[key[plain]] = True
    at = np.flatnonzero(used)
    place = np.cumsum(used) - 1
    blank = pc.if_else(pa.array((at & 1).astype(bool)), pa.scalar(" "), pa.scalar(""))
    units = pc.binary_join_element_wise(blank, vocab.take(pa.array(at >> 1)), pa.scalar(""))
    out = np.empty(len(heads), np.int64)
    out[plain] = place[key[plain]]
    extra: dict = {}
    strings = vocab.to_pylist() if not plain.all() else []
    for i in np.flatnonzero(~plain):
        h = heads[i]
        unit = (" " if lead[h] else "") + " ".join(strings[k] for k in num[h:h + size[i]])
        out[i] = extra.setdefault(unit, len(units) + len(extra))
    return pa.concat_arrays([units, pa.array(list(extra), pa.string())]), out, np.searchsorted(heads, offs)


def _cut(units: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    """(distinct parts, part numbers of all fragments in order, bounds per fragment): ``parts`` of every fragment."""
    found = pc.extract_regex(units, _SIMPLE)
    fast = np.asarray(found.is_valid())
    word, rest = (pc.struct_field(found, x).filter(pa.array(fast)) for x in ("word", "rest"))
    more = np.asarray(pc.binary_length(rest)).astype(np.int64) > 0
    slow = [parts(u) for u in units.filter(pa.array(~fast)).to_pylist()]
    n = np.ones(len(units), np.int64)
    n[fast] += more
    n[~fast] = [len(x) for x in slow]
    bounds = np.r_[0, np.cumsum(n)]
    strings = pa.concat_arrays([word, rest.filter(pa.array(more)), pa.array([x for xs in slow for x in xs], pa.string())])
    code = strings.dictionary_encode()
    number = np.asarray(code.indices).astype(np.int64)
    seq = np.empty(int(bounds[-1]), np.int64)
    head = bounds[:-1][fast]
    seq[head] = number[:len(word)]
    seq[head[more] + 1] = number[len(word):len(word) + int(more.sum())]
    seq[ragged_take(np.arange(len(seq)), bounds[:-1][~fast], n[~fast])] = number[len(word) + int(more.sum()):]
    return code.dictionary.to_pylist(), seq, bounds


def encode_pieces(pieces: pa.Array, continued: np.ndarray, spec: str, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces, tokens per piece) by the tokenizers library, a distinct part of a distinct fragment at a time."""
    if not cuts_known(spec):
        got = [e.ids for e in fr.tokenizer(spec).encode_batch_fast(pieces.to_pylist(), add_special_tokens=False)]
        return np.array([x for ids in got for x in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)
    if not len(pieces):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    units, code, bounds = _units(pieces, continued)
    words, seq, cuts = _cut(units)
    fresh = _ids_of([w for w in words if w not in cache], spec)
    cells = [cache[w] if w in cache else fresh[w] for w in words]
    if len(cache) + len(fresh) <= CACHE:
        cache.update(fresh)
    size = np.array([len(c) >> 2 for c in cells], np.int64)
    flat = np.frombuffer(b"".join(cells), np.uint32)
    start = np.cumsum(size) - size
    del units, words, cells, fresh
    n = np.diff(cuts)[code]
    order = ragged_take(seq, cuts[code], n)
    lens = size[order]
    total = np.r_[0, np.cumsum(lens)][np.r_[0, np.cumsum(n)]]
    return ragged_take(flat, start[order], lens), total[bounds[1:]] - total[bounds[:-1]]


def write_shards(df: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
                 end_id: int = 0, shard_tokens: int = 500_000, slice_bytes: int = 6 << 20) -> None:
    """Encode every text, append ``end_id`` and write the shard files in ascending id order."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    parts = shuffle_partitions(df.sparkSession)
    ordered = rows.repartitionByRange(parts, "id").sortWithinPartitions("id", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, pid, seq = fr.seen("ids", spec), TaskContext.get().partitionId(), 0
        docs, ids, held = [], [], 0

        def close() -> pa.RecordBatch:
            doc, null, lens = (np.concatenate(x) for x in zip(*docs, strict=True))
            data = pack(np.concatenate(ids), doc, null, lens)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([pid], pa.int32()), "shard": pa.array([seq], pa.int32()),
                "n_docs": pa.array([len(doc)], pa.int64()), "n_tokens": pa.array([int(lens.sum())], pa.int64()),
                "data": pa.array([data], pa.binary())})

        for b in batches:
            number = np.asarray(b["id"].fill_null(0)).astype(np.int64)
            null = np.asarray(b["id"].is_null().cast(pa.uint8()))
            arr, at = b["text"], 0
            whole = 0 if cuts_known(spec) else int(pc.max(pc.binary_length(arr)).as_py() or 0)  # texts that may not be cut
            for who, pieces, continued in fr.balanced(arr, max(slice_bytes, whole)):
                got, n = encode_pieces(pieces, continued, spec, cache)
                if len(who) == 1 and who[0] == at - 1:  # a further piece of the text before: put it ahead of its end id
                    ids[-1] = np.concatenate([ids[-1][:-1], got, [np.uint32(end_id)]])
                    docs[-1][2][-1] += n[0]
                    held += int(n[0])
                    continue
                flat, lens = np.insert(got, np.cumsum(n), end_id), n + 1
                cum = np.r_[0, np.cumsum(lens)]
                x = 0
                while x < len(who):  # the documents that still fit in this shard, one at least
                    if held >= shard_tokens:
                        yield close()
                        docs, ids, held, seq = [], [], 0, seq + 1
                    y = max(x + 1, int(np.searchsorted(cum, cum[x] + shard_tokens - held, "right")) - 1)
                    ids.append(flat[cum[x]:cum[y]])
                    docs.append((number[who[x:y]], null[who[x:y]], lens[x:y]))
                    held += int(cum[y] - cum[x])
                    held = max(held, shard_tokens) if y < len(who) else held
                    x = y
                at = int(who[-1]) + 1
        if docs:
            yield close()

    ordered.mapInArrow(shards, SHARDS).write.mode("overwrite").parquet(path)


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, decoded from the shard files."""
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, shard, data in zip(b["part"].to_pylist(), b["shard"].to_pylist(), b["data"], strict=True):
                w = WaveletMatrix(data.as_buffer())
                ids = w.decode().astype("<u4")
                crc = [zlib.crc32(ids[s:s + k].tobytes()) for s, k in zip(w.starts, w.lens, strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(w.doc_ids, pa.int64(), mask=w.null), "part": pa.array([part] * n, pa.int32()),
                    "shard": pa.array([shard] * n, pa.int32()), "local": pa.array(w.starts, pa.int64()),
                    "n_tokens": pa.array(w.lens, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    found = shards.mapInArrow(documents, "doc_id long, part int, shard int, local long, n_tokens long, ids_crc32 long")
    size = shards.select("part", "shard", F.col("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = size.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    place = size.withColumn("skip", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(base, "part").select(
        "part", "shard", (F.col("base") + F.col("skip")).alias("base"))
    return found.join(place, ["part", "shard"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """(doc_id, n) of the documents that hold a token, by rank on the shard files alone."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b["data"]:
                w = WaveletMatrix(data.as_buffer())
                at = np.array([w.select(token, k) for k in range(w.rank(token, w.n))], np.int64)
                who, n = np.unique(np.searchsorted(w.starts, at, "right") - 1, return_counts=True)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(w.doc_ids[who], pa.int64(), mask=w.null[who]),
                                                  "n": pa.array(n, pa.int64())})

    return shards.mapInArrow(look, "doc_id long, n long")
