"""MinHash near-dedup with BagMinHash: weighted Jaccard over multisets of word shingles.

A text is the multiset of its five-word shingles (lower case, ASCII white space); the similarity of two is
sum(min) / sum(max) of their counts.

Signatures. Over (shingle, weight, time) runs a Poisson process of unit rate. The weight axis is cut
into doubling intervals (0, 1], (1, 2], (2, 4], ...; each has its own stream of points in time order at a
rate of its width, every point with a hashed place inside the interval and a hashed component. A text
sees the points at or below its shingles' counts, and component k of its signature is the earliest of
them that fell to k. Two texts agree in a component with probability equal to their similarity. Points
are drawn only up to a time by which all components are usually filled, and up to twice that for the rest.

Classes. Exact copies collapse first (128-bit digest), so all that follows runs on different texts.
Texts that share a band of the signature meet. A band's texts are dealt to *blocks* of bounded size, and a block is solved where it
lies: a multiset is a set of (shingle, occurrence), so the overlaps of all its texts are one product of a 0/1 matrix with its
transpose (rare elements are counted pair by pair), exact whole numbers; from the pairs at the threshold or above a task returns only
the links that join different components, at most one less than texts. Links make components, joins and partial aggregations.
The first ``first`` bands are solved, then of the others those whose texts are not of one component already; of bands with the same
texts one is solved. Where a band has several blocks, the texts outside its largest component (*stragglers*) meet all its
blocks afterwards, unless one component is left. So two near texts share a class unless no band of theirs is equal (about 7e-5
at similarity 0.8 with 24 bands of 5, far less above). No pair is dropped for an estimate and none is a row; only a band of very many texts that
are all unlike costs more than in proportion: each block of stragglers then meets each block.

Defined cases: texts of one to four words have one shingle, all of them; texts without words are near
their exact copies only; a null text is a copy of the empty one; null ids come last and a class of null
ids only has a null class id; rows that repeat an id and text are copies; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix64, ragged_take, release_memory
from .components import components

U = np.uint64
_MASK = (1 << 64) - 1
_LAST = np.iinfo(np.int64).max
SLICE_BYTES = 2 << 20  # text signed at a time
BLOCK_TEXTS, BLOCK_BYTES = 640, 2 << 20  # a block of a band, compressed
_SIGNED = "node binary, first_id long, bands array<long>, packed binary"


def bags(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hashes, counts, bounds per text) of every text's multiset, hashes ascending in a text."""
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
    flat, offs = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    offs = offs - offs[0]
    code = flat.dictionary_encode()
    hashed = np.array([xxhash.xxh64_intdigest(w) for w in code.dictionary.to_pylist()], U)
    number = np.asarray(code.indices).astype(np.int64)
    real = np.asarray(pc.binary_length(flat)) > 0
    w = hashed[number[real]] if len(number) else np.zeros(0, U)
    bounds = np.r_[0, np.cumsum(real)][offs]
    size = np.diff(bounds)
    n = np.where(size > 0, np.maximum(size - words + 1, 1), 0)
    padded = np.r_[w, np.zeros(words, U)]
    at = ragged_take(np.arange(len(w) + 1), bounds[:-1], n)
    left = np.repeat(bounds[1:], n) - at  # words from here to the end
    h = np.zeros(len(at), U)
    for k in range(words):
        h = np.where(left > k, h * U(0x9E3779B97F4A7C15) + padded[at + k] + U(1), h)
    h = mix64(h)
    of = np.repeat(np.arange(len(size)), n)
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    head = np.flatnonzero(new)
    return h[head], np.diff(np.r_[head, len(h)]), np.searchsorted(of[head], np.arange(len(size) + 1))


def signatures(h: np.ndarray, count: np.ndarray, bounds: np.ndarray, m: int) -> np.ndarray:
    """BagMinHash signatures (texts x m); a text without shingles has zeros."""
    texts = len(bounds) - 1
    weight = np.add.reduceat(np.r_[count, 0], np.minimum(bounds[:-1], len(count))) if texts else np.zeros(0)
    weight = np.where(np.diff(bounds) > 0, weight, 0)
    out = np.zeros((texts, m), U)
    todo = np.flatnonzero(weight > 0)
    span = m * (np.log(m) + 3.0)
    while len(todo):
        of = np.repeat(np.arange(len(todo)), np.diff(bounds)[todo])
        at = ragged_take(np.arange(len(h)), bounds[todo], np.diff(bounds)[todo])
        found, when = _points(h[at], count[at], of, span / weight[todo][of], len(todo), m)
        full = np.isfinite(when).all(axis=1)
        out[todo[full]] = found[full]
        todo, span = todo[~full], span * 2
    return out


def _points(h, count, of, until, texts, m) -> tuple[np.ndarray, np.ndarray]:
    """(hash, time) of the first point of each component before a time."""
    when = np.full(texts * m, np.inf)
    found = np.zeros(texts * m, U)
    hits = []
    level = 0
    live = np.arange(len(h))
    while len(live):
        floor, width = (0, 1) if level == 0 else (1 << (level - 1), 1 << (level - 1))
        seed = mix64(h[live] + U((level + 1) * 0xC2B2AE3D27D4EB4F & _MASK))
        time, k = np.zeros(len(live)), 0
        now, of_now, limit, top = live, of[live], until[live], count[live]
        while len(now):
            k += 1
            point = mix64(seed + U(k * 0x9E3779B97F4A7C15 & _MASK))
            time = time - np.log(((point >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / width
            go = time < limit
            now, seed, time, of_now, limit, top, point = now[go], seed[go], time[go], of_now[go], limit[go], top[go], point[go]
            extra = mix64(point ^ U(0xD6E8FEB86659FD93))
            slot = of_now * m + (extra % U(m)).astype(np.int64)
            if level:
                seen = floor + 1 + ((extra >> U(32)) % U(width)).astype(np.int64) <= top
                hits.append((slot[seen], time[seen], point[seen]))
            else:
                hits.append((slot, time, point))
        level += 1
        live = live[count[live] > (1 << (level - 1))]
    slot, time, point = (np.concatenate(x) for x in zip(*hits, strict=True))
    np.minimum.at(when, slot, time)
    first = time == when[slot]
    found[slot[first]] = point[first]
    return found.reshape(texts, m), when.reshape(texts, m)


def similarity(a: tuple, b: tuple) -> tuple[int, int]:
    """(sum of least counts, sum of greatest counts) of two multisets (hashes ascending, counts)."""
    at = np.minimum(np.searchsorted(b[0], a[0]), max(len(b[0]) - 1, 0))
    both = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    least = int(np.minimum(a[1][both], b[1][at[both]]).sum())
    return least, int(a[1].sum() + b[1].sum()) - least


def _sign(bands: int, rows: int, words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            size = np.asarray(pc.binary_length(b["text"])).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1).tolist(), b.num_rows]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                part = b.slice(x, y - x)
                h, count, bounds = bags(part["text"], words)
                sig = signatures(h, count, bounds, bands * rows).reshape(-1, bands, rows)
                key = np.zeros(sig.shape[:2], U) + np.arange(1, bands + 1, dtype=U) * U(0xBF58476D1CE4E5B9)
                for r in range(rows):
                    key = mix64(key * U(0x9E3779B97F4A7C15) + sig[:, :, r])
                some = np.diff(bounds) > 0
                lens = np.where(some, bands, 0)
                keys = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lens)].astype(np.int32)), pa.array(key[some].reshape(-1).view(np.int64)))
                packed = pa.array([press.compress(t.as_buffer()) for t in part["text"].cast(pa.binary())], pa.binary())
                yield pa.RecordBatch.from_arrays([part["node"], part["first_id"], keys, packed], names=["node", "first_id", "bands", "packed"])

    return sign


def elements(h: np.ndarray, count: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(element hashes, bounds per text) of multisets as sets: the i-th occurrence of a shingle is an element of its own."""
    if not len(count) or count.max() == 1:
        return h, bounds
    ends = np.cumsum(count)
    nth = np.arange(int(ends[-1])) - np.repeat(ends - count, count)
    e = np.repeat(h, count)
    again = nth > 0
    e[again] = mix64(e[again] + nth[again].astype(U) * U(0x9E3779B97F4A7C15))
    return e, np.r_[0, ends][bounds]


def overlaps(e: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sizes of all pairwise intersections of sets (upper triangle of a square matrix)."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    order = np.argsort(e, kind="stable")
    e, row = e[order], row[order]
    head = np.flatnonzero(np.r_[True, e[1:] != e[:-1]][:len(e)])
    held = np.diff(np.r_[head, len(e)])
    common = held >= _COMMON
    # Elements of few texts: their pairs are counted one by one.
    rare = np.repeat(~common & (held > 1), held)
    x, y = e[rare], row[rare]
    pairs = [np.zeros(0, np.int64)]
    for k in range(1, min(_COMMON, len(x))):
        same = x[k:] == x[:-k]
        if not same.any():
            break
        pairs.append(y[:-k][same] * n + y[k:][same])  # rows ascend within an element
    out = np.bincount(np.concatenate(pairs), minlength=n * n).reshape(n, n)
    # Elements of many texts: columns of a 0/1 matrix, whose product with its transpose counts all pairs.
    column = np.repeat(np.cumsum(common) - 1, held)
    wide = np.repeat(common, held)
    column, y, total = column[wide], row[wide], int(common.sum())
    starts = np.searchsorted(column, np.arange(0, total + _COLUMNS, _COLUMNS))
    for i, (a, z) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
        m = np.zeros((n, min(_COLUMNS, total - i * _COLUMNS)), np.float32)
        m[y[a:z], column[a:z] - i * _COLUMNS] = 1
        out += np.rint(m @ m.T).astype(out.dtype)
    return np.triu(out, 1)


_COMMON, _COLUMNS = 16, 1024


def links(e: np.ndarray, bounds: np.ndarray, label: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Pairs of texts that join the components ``label`` of one block as its near pairs do: for every component that is joined to one
    with a smaller number, a text of each."""
    if not (label != label[0]).any():
        return []
    n, size = len(label), np.diff(bounds)
    if n == 2:
        both = len(np.intersect1d(e[bounds[0]:bounds[1]], e[bounds[1]:bounds[2]], assume_unique=True))
        return [(0, 1)] if both >= threshold * (int(size.sum()) - both) else []
    both = overlaps(e, bounds)
    a, b = np.nonzero(both >= threshold * (size[:, None] + size[None, :] - both))
    at = a < b
    a, b = a[at], b[at]
    new = label[a] != label[b]
    low, high = np.minimum(label[a[new]], label[b[new]]), np.maximum(label[a[new]], label[b[new]])
    # Least label reachable: spread along the edges, jump, until nothing moves.
    root = np.arange(int(label.max()) + 1)
    while True:
        before = root.copy()
        np.minimum.at(root, high, before[low])
        np.minimum.at(root, low, before[high])
        root = root[root]
        if (root == before).all():
            break
    first = np.full(len(root), n)
    np.minimum.at(first, label, np.arange(n))
    joined = np.flatnonzero(root != np.arange(len(root)))
    return list(zip(first[root[joined]].tolist(), first[joined].tolist(), strict=True))


def _solve(threshold: float, words: int):
    """(a, b): the links of every block; rows (key, block, node, label, packed) come sorted by (key, block, node)."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        open_, held, size = zstandard.ZstdDecompressor(), [], 0

        def told() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            block = np.stack([np.asarray(rows["key"]), np.asarray(rows["block"]).astype(np.int64)])
            cut = np.r_[0, np.flatnonzero((block[:, 1:] != block[:, :-1]).any(axis=0)) + 1, rows.num_rows]
            node, label = rows["node"].to_pylist(), rows["label"].to_pylist()
            # A text is cut into shingles once for all blocks held.
            place = {}
            for i, x in enumerate(node):
                place.setdefault(x, i)
            own = {x: k for k, x in enumerate(place)}
            texts = pa.array([open_.decompress(rows["packed"][i].as_py()).decode() for i in place.values()], pa.string())
            e, bounds = elements(*bags(texts, words))
            out = []
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                names = list(dict.fromkeys(node[x:y]))  # a straggler may also stand in the block it meets
                of = dict(zip(node[x:y], label[x:y], strict=True))
                code: dict = {}
                number = np.array([code.setdefault(of[v], len(code)) for v in names])
                at = np.array([own[v] for v in names])
                lens = bounds[at + 1] - bounds[at]
                found = links(ragged_take(e, bounds[at], lens), np.r_[0, np.cumsum(lens)], number, threshold)
                out += [(names[i], names[j]) for i, j in found]
            a, b = zip(*out, strict=True) if out else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        last = None
        for batch in batches:
            key, block = np.asarray(batch["key"]), np.asarray(batch["block"]).astype(np.int64)
            if not batch.num_rows:
                continue
            new = np.r_[(key[0], block[0]) != last, (key[1:] != key[:-1]) | (block[1:] != block[:-1])]
            starts = np.flatnonzero(new).tolist()
            weight = np.cumsum(np.asarray(pc.binary_length(batch["packed"])).astype(np.int64))
            at = 0
            for x in starts:
                here = size + int(weight[x - 1] if x else 0) - int(weight[at - 1] if at else 0)
                if here >= BLOCK_BYTES or (here and x - at + sum(h.num_rows for h in held) >= 8 * BLOCK_TEXTS):
                    if x > at:
                        held.append(batch.slice(at, x - at))
                    yield told()
                    held, size, at = [], 0, x
            held.append(batch.slice(at))
            size += int(weight[-1]) - int(weight[at - 1] if at else 0)
            last = (key[-1], block[-1])
        if held:
            yield told()

    return solve


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the component of each node, its own name where it has no link."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _met(blocks: DataFrame, signed: DataFrame, threshold: float, words: int) -> DataFrame:
    """(a, b): links of the blocks (key, block, node, label), each solved in one task."""
    dealt = blocks.join(signed.select("node", "packed"), "node").select("key", "block", "node", "label", "packed")
    return dealt.repartition("key", "block").sortWithinPartitions("key", "block", "node").mapInArrow(_solve(threshold, words), "a binary, b binary")


def near_duplicates(df: DataFrame, threshold: float = 0.8, words: int = 5, bands: int = 24, rows: int = 5, first: int = 4,
                    id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(digest, class, class_id) of every distinct text; ``digest`` is ``digest_of(text)``, class id the least id.

    Inside, a text is named by its least id and its digest, so that the least name of a component is its class.
    """
    scratch = Scratch(df.sparkSession)
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # One row per different text (map-side first: copies cost one row per task).
    texts = docs.groupBy(digest_of(F.col("text")).alias("digest")).agg(F.min("id").alias("first_id"), F.first("text").alias("text"))
    texts = texts.select(F.concat(_ordered_bytes(F.col("first_id")), "digest").alias("node"), "first_id", "text")
    signed = scratch.write(texts.mapInArrow(_sign(bands, rows, words), _SIGNED), "bagminhash")
    edges, labels = None, None

    def linked(found: DataFrame) -> None:
        nonlocal edges, labels
        found = scratch.write(found, "links")
        if not found.isEmpty():
            edges = found if edges is None else edges.unionByName(found)
            before, labels = labels, scratch.write(components(edges, scratch), "labels")
            scratch.drop(before)

    for low, n in ((1, min(first, bands)), (first + 1, bands - first)):
        if n <= 0:
            continue
        entries = signed.select(F.explode(F.slice("bands", low, n)).alias("key"), "node", F.octet_length("packed").cast("long").alias("bytes"))
        # Bands of one component are done; of bands with the same texts one is enough.
        groups = _labelled(entries, labels).groupBy("key").agg(
            F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.bit_xor(F.xxhash64("node")).alias("set"),
            F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
        groups = groups.groupBy("n", "bytes", "set").agg(F.min("key").alias("key"))
        blocks = F.greatest(F.ceil(F.col("n") / BLOCK_TEXTS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
        groups = scratch.write(groups.select("key", blocks.alias("blocks")), "groups")
        members = scratch.write(entries.select("key", "node").join(groups, "key"), "members")
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
        linked(_met(_labelled(members, labels).select("key", block, "node", "label"), signed, threshold, words))
        wide = _labelled(members.filter("blocks > 1"), labels)
        sizes = wide.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(
            F.max(F.struct("n", "label")).alias("m"), F.sum("n").alias("all"), F.count("*").alias("labels")).filter("labels > 1")
        sizes = scratch.write(sizes.select("key", F.col("m.label").alias("most"), F.ceil((F.col("all") - F.col("m.n")) / BLOCK_TEXTS).cast("int").alias("turns")), "wide")
        if not sizes.isEmpty():
            # Blocks of stragglers (``turn``) meet every block of the band: copies of both, one group each.
            wide = wide.join(sizes, "key")
            turn = F.pmod(F.xxhash64("node", F.lit(1)), F.col("turns")).cast("int")
            asked = wide.filter("label <> most").select("key", turn.alias("turn"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"), "blocks", "node", "label")
            whole = wide.select("key", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), block.alias("b"), "blocks", "node", "label")
            met = asked.unionByName(whole).select("key", (F.col("turn").cast("long") * F.col("blocks") + F.col("b")).alias("block"), "node", "label").distinct()
            linked(_met(met, signed, threshold, words))
        scratch.drop(sizes)
        scratch.drop(groups, members)
    names = _labelled(signed.select("node"), labels).select("node", F.col("label").alias("class"))
    first_of = F.conv(F.hex(F.substring("class", 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))
    out = scratch.write(names.select(F.expr("substring(node, 9)").alias("digest"), "class",
                                     F.when(first_of != _LAST, first_of).alias("class_id")), "classes")
    scratch.close(keep=1)
    return out


_SIGN = -(1 << 63)


def _ordered_bytes(x):
    """Eight bytes that sort as the (signed) integer does."""
    return F.unhex(F.lpad(F.hex(x.bitwiseXOR(F.lit(_SIGN))), 16, "0"))


def digest_of(text):
    """Digest that stands for a text."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def classes(df: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(id, class_id) of every row."""
    found = near_duplicates(df, id_col=id_col, text=text, **how)
    return df.select(F.col(id_col).alias(id_col), digest_of(F.col(text)).alias("digest")).join(found, "digest").select(id_col, "class_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each class, the one with the least id, all columns as they are."""
    found = near_duplicates(df, id_col=id_col, text=text, **how)
    found = found.select(F.col("digest").alias("__digest"), F.col("class").alias("__class"), F.col("class_id").alias("__id"))
    kept = df.withColumn("__digest", digest_of(F.col(text))).join(found, "__digest")
    return kept.filter(F.col(id_col).eqNullSafe(F.col("__id"))).dropDuplicates(["__class"]).select(*df.columns)
