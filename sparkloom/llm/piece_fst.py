"""SentencePiece encoding and decoding with a weighted finite-state transducer.

``compile_model`` turns a model file into three machines:

* the normaliser: the dummy prefix, and the space to U+2581 (its only rewriting rules here);
* the pieces: a trie whose final states emit a piece at weight -score, with byte arcs for every
  character that is no piece by itself;
* for BPE models the neighbours: a piece may follow another only if merging their joined text by rank
  leaves exactly these two. A segmentation is the BPE one if and only if all its neighbours pass, so
  composition leaves one path, the library's (a plain sum of BPE scores would pick another).
  Unigram models need no such machine.

``encode`` composes each input with them and takes the shortest path in the tropical semiring, for all
distinct fragments of a slice side by side: all places walk the trie together, then path costs are
relaxed from left to right. Fragments start at a space after a character that is not a space; no piece
crosses that. Everything runs inside Arrow functions, without a shuffle; the machines' size is the
vocabulary's, and they are broadcast.

Defined cases: a null or empty text has no ids; every row is encoded on its own; an empty table gives no
rows; decoding gives the text back but for U+2581, which reads back as a space.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fragments as fr
from .common import ragged_take, release_memory

SPACE = "▁"
_NEVER = np.iinfo(np.int32).max
_CACHE_BITS = 21
CACHE = 250_000
SLICE = 4 << 20


@dataclass
class PieceTransducer:
    pieces: list
    bytes_of: np.ndarray  # id of the piece of each byte
    cost: np.ndarray  # weight of each piece
    edge_key: np.ndarray  # trie: (node << 21 | character), sorted
    edge_to: np.ndarray
    emits: np.ndarray  # piece of a node, -1: none
    single: np.ndarray  # characters that are pieces, sorted
    unk: int
    dummy_prefix: bool
    neighbours: tuple | None  # ranks, right ends and left ends of each piece's merges; joined pairs and their ranks
    cache: dict = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}


def _merges(text: str, rank: dict) -> tuple[list, list]:
    """BPE of one piece's text: (ranks of the merges in order, parts after each of them)."""
    parts, order, states = list(text), [], [list(text)]
    while len(parts) > 1:
        best = min(((rank.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1)))
        if best[0] == _NEVER:
            break
        i = best[1]
        parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2:]]
        order.append(best[0])
        states.append(parts)
    return order, states


def compile_model(path: str) -> PieceTransducer:
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as f:
        data = f.read()
    spec = proto.ModelProto()
    spec.ParseFromString(data)
    norm, kind = spec.normalizer_spec, spec.trainer_spec.model_type
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or kind not in (1, 2) \
            or spec.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only unigram and BPE models with the identity normaliser are compiled")
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
    usual = [i for i in range(len(pieces)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    cost = np.array([-sp.get_score(i) for i in range(len(pieces))])
    bytes_of = np.full(256, sp.unk_id(), np.int64)
    for i in range(len(pieces)):
        if sp.is_byte(i):
            bytes_of[int(pieces[i][1:-1], 16)] = i
    cost[bytes_of] = cost[usual].max() + 1.0 if usual else 1.0
    neighbours = None
    if kind == 2:  # BPE: ranks by score; pieces that merging never makes cannot stand in a path
        by_score = sorted(usual, key=lambda i: (cost[i], i))
        rank = {pieces[i]: r for r, i in enumerate(by_score) if len(pieces[i]) > 1}
        number = {pieces[i]: i for i in usual}
        wide = max(len(pieces[i]) for i in usual)
        ranks = np.full((len(pieces), wide + 1), _NEVER, np.int32)
        right, left = np.zeros((len(pieces), wide + 1), np.int32), np.zeros((len(pieces), wide + 1), np.int32)
        keep = []
        for i in usual:
            order, states = _merges(pieces[i], rank)
            if len(states[-1]) > 1 or any(s[k] not in number for s in states for k in (0, -1)):
                if len(pieces[i]) > 1:
                    continue
            keep.append(i)
            ranks[i, :len(order)] = order
            right[i, :len(states)] = [number[s[-1]] for s in states]
            left[i, :len(states)] = [number[s[0]] for s in states]
        joined = {}
        for i in usual:
            p = pieces[i]
            for k in range(1, len(p)):
                if p[:k] in number and p[k:] in number:
                    joined[number[p[:k]] << 32 | number[p[k:]]] = rank[p]
        keys = np.array(sorted(joined), np.int64)
        neighbours = (ranks, right, left, keys, np.array([joined[k] for k in keys.tolist()], np.int32))
        usual = keep
    nodes, edges, emits = 1, {}, [-1]
    for i in usual:
        node = 0
        for c in pieces[i]:
            key = node << 21 | ord(c)
            if key not in edges:
                edges[key] = nodes
                emits.append(-1)
                nodes += 1
            node = edges[key]
        emits[node] = i
    keys = np.array(sorted(edges), np.int64)
    single = np.array(sorted(ord(pieces[i]) for i in usual if len(pieces[i]) == 1), np.int64)
    return PieceTransducer(pieces, bytes_of, cost, keys, np.array([edges[k] for k in keys.tolist()], np.int64), np.array(emits, np.int64),
                           single, sp.unk_id(), norm.add_dummy_prefix, neighbours)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key, -1 if absent."""
    at = np.minimum(np.searchsorted(sorted_keys, keys), max(len(sorted_keys) - 1, 0))
    return np.where(sorted_keys[at] == keys, at, -1) if len(sorted_keys) else np.full(len(keys), -1)


def _pass(m: PieceTransducer, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether BPE over the joined text of two pieces leaves just them: both merge sequences run in step."""
    ranks, right, left, keys, joined = m.neighbours
    ok = np.ones(len(one), bool)
    live = np.arange(len(one))
    i, j = np.zeros(len(one), np.int64), np.zeros(len(one), np.int64)
    while len(live):
        a, b = one[live], two[live]
        x, y = i[live], j[live]
        at = _find(keys, right[a, x].astype(np.int64) << 32 | left[b, y])
        across = np.where(at >= 0, joined[at], _NEVER)
        own, other = ranks[a, x], ranks[b, y]
        bad = (across < own) & (across <= other) & (across < _NEVER)
        ok[live[bad]] = False
        ended = (own == _NEVER) & (other == _NEVER)
        first = own <= other
        i[live[first]] += 1
        j[live[~first]] += 1
        live = live[~(bad | ended)]
    return ok


def _allowed(m: PieceTransducer, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """``_pass`` through a direct-mapped cache of verdicts."""
    if "key" not in m.cache:
        m.cache["key"] = np.full(1 << _CACHE_BITS, -1, np.int64)
        m.cache["ok"] = np.zeros(1 << _CACHE_BITS, bool)
    key = one << 32 | two
    slot = ((one * 0x9E3779B1 + two * 0x85EBCA6B) >> 7) & ((1 << _CACHE_BITS) - 1)
    ok = m.cache["ok"][slot]
    miss = np.flatnonzero(m.cache["key"][slot] != key)
    if len(miss):
        new, back = np.unique(key[miss], return_inverse=True)
        verdict = _pass(m, new >> 32, new & 0xFFFFFFFF)
        ok[miss] = verdict[back]
        m.cache["key"][slot[miss]] = key[miss]
        m.cache["ok"][slot[miss]] = ok[miss]
    return ok


def shortest_paths(m: PieceTransducer, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, ids per text) for normalised texts."""
    lens = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    n = len(codes)
    end = np.cumsum(lens)
    begin = end - lens
    limit = np.repeat(end, lens)
    # Composition with the trie: all places walk together; arcs (from, to, piece).
    place, node, arcs = np.arange(n), np.zeros(n, np.int64), []
    step = 0
    while len(place):
        at = _find(m.edge_key, node << 21 | codes[place + step])
        go = at >= 0
        place, node = place[go], m.edge_to[at[go]]
        step += 1
        done = np.flatnonzero(m.emits[node] >= 0)
        arcs.append((place[done], place[done] + step, m.emits[node[done]]))
        more = place + step < limit[place]
        place, node = place[more], node[more]
    alone = np.flatnonzero(_find(m.single, codes) < 0)  # byte arcs; -1 stands for the bytes of a character
    arcs.append((alone, alone + 1, np.full(len(alone), -1)))
    a, b, piece = (np.concatenate(x) for x in zip(*arcs, strict=True))
    weight = np.where(piece >= 0, m.cost[piece], m.cost[m.bytes_of[0]] * 4)
    # Relaxation by the arcs' end inside the text. State n + k is no state: place k is (text's end of) character k - 1.
    shift = np.repeat(np.arange(len(texts)), lens)  # places are numbered with one more per text
    src, dst = a + shift[a], b + shift[a]
    cost, last, back = np.full(n + len(texts), np.inf), np.full(n + len(texts), -2, np.int64), np.zeros(n + len(texts), np.int64)
    first = begin + np.arange(len(texts))
    cost[first] = 0
    depth = b - np.repeat(begin, lens)[a]
    order = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[order], np.arange(1, int(lens.max()) + 2)) if n else np.zeros(1, np.int64)
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        e = order[x:y]
        total = cost[src[e]] + weight[e]
        if m.neighbours is not None:
            before = last[src[e]]
            ask = np.flatnonzero((before >= 0) & (piece[e] >= 0))
            bar = ask[~_allowed(m, before[ask], piece[e[ask]])]
            total[bar] = np.inf
        e, total = e[np.isfinite(total)], total[np.isfinite(total)]
        by = np.argsort(-total, kind="stable")  # the least cost is written last
        e, total = e[by], total[by]
        cost[dst[e]], last[dst[e]], back[dst[e]] = total, piece[e], src[e]
    # Back along the paths, all texts together.
    at, who, out = first + lens, np.arange(len(texts)), []
    while True:
        go = at > first[who]
        at, who = at[go], who[go]
        if not len(at):
            break
        out.append((who, at, last[at]))
        at = back[at]
    if not out:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    who, at, ids = (np.concatenate(x) for x in zip(*out, strict=True))
    by = np.argsort(at)
    who, at, ids = who[by], at[by], ids[by]
    raw = np.flatnonzero(ids == -1)
    if len(raw):
        chars = codes[at[raw] - who[raw] - 1].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        data = [c.encode("utf-8", "surrogatepass") for c in chars]
        width = np.ones(len(ids), np.int64)
        width[raw] = [len(x) for x in data]
        ids, who = np.repeat(ids, width), np.repeat(who, width)
        ids[ids == -1] = m.bytes_of[np.frombuffer(b"".join(data), np.uint8)]
    return ids, np.bincount(who, minlength=len(texts))


def encode_pieces(m: PieceTransducer, pieces: pa.Array, continued: np.ndarray, cache: dict) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all pieces, ids per piece)."""
    spaced = np.ones(len(pieces), bool) if m.dummy_prefix else continued
    units, code, bounds = fr.fragments(pieces, spaced, lambda w: not w or w[-1] == SPACE)
    if m.dummy_prefix:  # the prefix belongs to texts that hold something
        empty = np.asarray(pc.binary_length(pieces)) == 0
    new = [u for u in units if u not in cache]
    fresh = {}
    for a in range(0, len(new), 10_000):
        part = new[a:a + 10_000]
        ids, n = shortest_paths(m, [u.replace(" ", SPACE) for u in part])
        data, end = ids.astype("<u2" if len(m.pieces) <= 1 << 16 else "<u4").tobytes(), np.cumsum(n)
        w = 2 if len(m.pieces) <= 1 << 16 else 4
        fresh.update((u, data[(y - k) * w:y * w]) for u, y, k in zip(part, end.tolist(), n.tolist(), strict=True))
    cells = [fresh[u] if u in fresh else cache[u] for u in units]
    if len(cache) < CACHE:
        cache.update(fresh)
    kind = "<u2" if len(m.pieces) <= 1 << 16 else "<u4"
    flat = np.frombuffer(b"".join(cells), kind)
    size = np.array([len(c) for c in cells], np.int64) // np.dtype(kind).itemsize
    start = np.cumsum(size) - size
    lens = size[code]
    if m.dummy_prefix:
        lens = lens.copy()
        lens[bounds[:-1][empty]] = 0
    total = np.r_[0, np.cumsum(lens)]
    return ragged_take(flat, start[code], lens), total[bounds[1:]] - total[bounds[:-1]]


class Decoder:
    """Ids back to text: pieces with U+2581 as a space, byte pieces as bytes, the dummy prefix left out."""

    def __init__(self, m: PieceTransducer):
        words = [p.replace(SPACE, " ").encode() for p in m.pieces]
        for b, i in enumerate(m.bytes_of):
            if i != m.unk:
                words[i] = bytes([b])
        self.flat = np.frombuffer(b"".join(words), np.uint8)
        self.size = np.array([len(w) for w in words], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.skip = 1 if m.dummy_prefix else 0

    def __call__(self, ids: np.ndarray, bounds: np.ndarray) -> list:
        """The bytes of every text (``bounds``: limits of its ids)."""
        size = self.size[ids]
        data = ragged_take(self.flat, self.start[ids], size).tobytes()
        place = np.r_[0, np.cumsum(size)][bounds].tolist()
        return [data[x + self.skip:y] for x, y in zip(place[:-1], place[1:], strict=True)]


def _rows(m: PieceTransducer, texts: pa.Array, cache: dict) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, ids per row) in slices of whole rows; the pieces of a long text come together."""
    held: list = []
    for who, pieces, continued in fr.balanced(texts, SLICE):
        if held and held[0][0] != who[0]:
            yield held[0][0], held[0][0] + 1, np.concatenate([h[1] for h in held]), np.array([sum(len(h[1]) for h in held)])
            held = []
        ids, n = encode_pieces(m, pieces, continued, cache)
        if len(who) == 1:
            held.append((int(who[0]), ids))
        else:
            yield int(who[0]), int(who[-1]) + 1, ids, n
    if held:
        yield held[0][0], held[0][0] + 1, np.concatenate([h[1] for h in held]), np.array([sum(len(h[1]) for h in held)])


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text: str = "text", keep_text: bool = False,
           keep_ids: bool = True) -> DataFrame:
    """(id, [text], [ids], n_bytes, n_tokens, n_byte_tokens, ids_crc32, round_trip) of every row.

    ``round_trip``: decoding the ids gives the text back (U+2581 read as a space).
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = df.sparkSession.sparkContext.broadcast(compile_model(model_path))
    with open(model_path, "rb") as f:
        name = hashlib.sha256(f.read()).hexdigest()
    rows = df.select(F.col(id_col).alias(id_col), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    schema = rows.selectExpr(f"`{id_col}`", *["text"] * keep_text, *["array(0) as ids"] * keep_ids, "0L as n_bytes", "0L as n_tokens",
                             "0L as n_byte_tokens", "0L as ids_crc32", "true as round_trip").schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory(caches=False)
        m = shared.value
        cache, decode_ids = fr.seen("pieces", name), Decoder(m)
        is_byte = np.zeros(len(m.pieces), bool)
        is_byte[m.bytes_of] = True
        for b in batches:
            for x, y, ids, n in _rows(m, b["text"], cache):
                own, texts = b.column(0).slice(x, y - x), b["text"].slice(x, y - x)
                ids = ids.astype("<u4")
                offs = np.r_[0, np.cumsum(n)]
                cut = list(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True))
                plain = pc.replace_substring(texts, SPACE, " ").cast(pa.binary())
                same = [got == want.as_py() for got, want in zip(decode_ids(ids, offs), plain, strict=True)]
                cols = [own, *[texts] * keep_text]
                if keep_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids.view("<i4"))).cast(arrow.field("ids").type))
                cols += [pc.binary_length(texts).cast(pa.int64()), pa.array(n.astype(np.int64)),
                         pa.array([int(is_byte[ids[i:j]].sum()) for i, j in cut], pa.int64()),
                         pa.array([zlib.crc32(ids[i:j].tobytes()) for i, j in cut], pa.int64()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids (null ids: null) in place of them."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = df.sparkSession.sparkContext.broadcast(compile_model(model_path))
    rest = [c for c in df.columns if c not in (ids, out)]
    rows = df.select(*rest, ids)
    schema = rows.select(*rest, F.lit(None).cast("string").alias(out)).schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_ids = Decoder(shared.value)
        for whole in batches:
            for x in range(0, whole.num_rows, 1000):
                b = whole.slice(x, 1000)
                col = b.column(len(rest))
                offs = np.asarray(col.offsets).astype(np.int64)
                at = np.asarray(col.values)[offs[0]:offs[-1]].astype(np.int64)
                got = [t.decode("utf-8", "replace") for t in decode_ids(at, offs - offs[0])]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.string(), mask=np.asarray(col.is_null()))], schema=arrow)

    return rows.mapInArrow(run, schema)
