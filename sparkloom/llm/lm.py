"""LM scoring with a weighted backoff automaton.

The model is an n-gram model of any ``order`` from 2 with Dirichlet smoothing at every level down to add-one unigrams,
learned from all training texts: with c over training tokens, N tokens and V distinct ones, and h' the history h
without its first word,

    P(x) = (c(x) + 1) / (N + V + 1)          P(x | h) = (c(h x) + mu P(x | h')) / (c(h) + mu)

As an automaton: a state per seen history of up to ``order - 1`` words (a text's start counts as one) and the root (no
history); from a state an arc per seen n-gram, weighing log10 P(x | h), to the longest seen history that ends with x;
else the failure arc to the state of h', weighing log10(mu / (c(h) + mu)), down to the root, where every word has an arc
log10 P(x). One left-to-right traversal carries the state and adds up the weights.

No task needs the whole model. Documents live in blocks (a fixed hash of the row; one exchange that
Spark reuses), counts in buckets: a block sends its distinct words with their training counts, once
each, and gets back the corpus counts and exact word numbers; then the same for its distinct n-grams of all levels at
once, as word numbers; then it builds the automaton of just its own words and n-grams and scores its documents. Frequent
words and n-grams are thus summed per block before each exchange. The word counts are written to the
shared folder (the totals N and V need all of them before any score). A block holds about ``BLOCK_BYTES`` of text, or
less where the session has more shuffle partitions than that needs.

Defined cases: a null text is empty (its only token is the end); a text's words are the runs of
bytes other than ASCII white space, ASCII letters in lower case; rows that repeat an id are texts of
their own; a very long text is one block's, whole, and is read in lanes side by side; with nothing to learn from
N = V = 0; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.session import shared_dir

from .common import mix64, release_memory, shuffle_partitions

END = ""  # no word is empty
LANE = 64
#: Text of a block: about 3 million tokens, some 200 bytes each while their n-grams are sorted.
BLOCK_BYTES = 16 << 20
_WORDS = "bucket int, block int, words binary, counts binary"
_KNOWN = "block int, bucket int, counts binary, numbers binary, n long, v long"
_GRAMS = "bucket int, block int, words array<binary>, counts array<binary>"  # an entry per level, empty where none
_SEEN = "block int, bucket int, kind int, a binary, b binary"


class BackoffAutomaton:
    """States 0 (root) and 1..S (histories); arcs sorted by (state, word); failure arcs lead to ``back`` (the root without it)."""

    def __init__(self, root_weight: np.ndarray, root_target: np.ndarray, arc_state: np.ndarray, arc_word: np.ndarray,
                 arc_weight: np.ndarray, arc_target: np.ndarray, fail_weight: np.ndarray,
                 back: np.ndarray | None = None, order: int = 2):
        self.words = len(root_weight)
        key = arc_state * self.words + arc_word
        by_key = np.argsort(key)
        self.key, self.weight, self.target = key[by_key], arc_weight[by_key], arc_target[by_key]
        self.root_weight, self.root_target, self.fail = root_weight, root_target, fail_weight
        self.back = np.zeros(len(fail_weight), np.int64) if back is None else back
        self.order = order

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(weights, next states) after reading one word from each state."""
        weight, after = self.root_weight[word], self.root_target[word]
        fallen = np.zeros(len(state))
        live = np.arange(len(state))
        for _ in range(self.order - 1):  # no state is further from the root
            key = state * self.words + word[live]
            at = np.searchsorted(self.key, key)
            at[at == len(self.key)] = 0
            hit = (self.key[at] == key) & (state > 0) if len(self.key) else np.zeros(len(live), bool)
            done, arc = live[hit], at[hit]
            weight[done], after[done] = fallen[done] + self.weight[arc], self.target[arc]
            live, state = live[~hit], state[~hit]
            fallen[live] += self.fail[state]
            state = self.back[state]
        weight[live] += fallen[live]
        return weight, after

    def traverse(self, words: np.ndarray, bounds: np.ndarray, start: int) -> np.ndarray:
        """Weight of every token. Texts run in lanes of ``LANE`` tokens side by side; a lane inside a text
        reads the ``order - 1`` tokens before it first, which leads to the same state as reading the text from its start."""
        out = np.empty(len(words))
        lens = np.diff(bounds)
        lanes = -(-lens // LANE)
        inner = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(bounds[:-1], lanes) + inner * LANE
        end = np.minimum(at + LANE, np.repeat(bounds[1:], lanes))
        order = np.argsort(at - end, kind="stable")  # long lanes first
        at, end, inner = at[order], end[order], inner[order]
        read = inner * LANE  # tokens of the text before the lane
        state = np.where(read >= self.order - 1, 0, start)
        for j in range(self.order - 1, 0, -1):
            warm = np.flatnonzero(read >= j)
            state[warm] = self.step(state[warm], words[at[warm] - j])[1]
        size = end - at
        for i in range(int(size.max()) if len(size) else 0):
            live = int(np.searchsorted(-size, -i, "left"))  # lanes with more than i tokens
            out[at[:live] + i], state[:live] = self.step(state[:live], words[at[:live] + i])
        return out


class _Texts:
    """The tokens of a block: documents in a fixed order, words numbered by first occurrence."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        self.table = table.take(pc.sort_indices(table.select(["id", "text", "train"]),
                                                [("id", "ascending"), ("text", "ascending"), ("train", "ascending")]))
        text = self.table["text"].combine_chunks() if self.table.num_rows else pa.array([], pa.string())
        split = pc.ascii_split_whitespace(pc.ascii_lower(text))
        flat, offs = split.flatten(), np.asarray(split.offsets).astype(np.int64)
        real = np.asarray(pc.binary_length(flat)) > 0
        code = flat.dictionary_encode()
        number = np.asarray(code.indices).astype(np.int64)[real]
        inner = np.r_[0, np.cumsum(real)][offs]
        self.vocab = code.dictionary.to_pylist()
        if END not in self.vocab:
            self.vocab.append(END)
        n = len(offs) - 1
        self.bounds = inner + np.arange(n + 1)
        del flat, split, code
        self.words = np.full(len(number) + n, self.vocab.index(END), np.int64)
        inside = np.ones(len(self.words), bool)
        inside[self.bounds[1:] - 1] = False
        self.words[inside] = number
        self.train = np.asarray(self.table["train"].combine_chunks().cast(pa.uint8())).astype(bool) if n else np.zeros(0, bool)
        self.learn = np.repeat(self.train, np.diff(self.bounds))
        bucket = np.array([zlib.crc32(w.encode()) for w in self.vocab], np.int64)
        self.hash = bucket

    def grams(self, order: int) -> list[dict]:
        """Distinct n-grams of every level from 2 to ``order``: their history (an n-gram of the level below; a text's start is
        word ``len(vocab)``), last word, suffix (the n-gram of the level below that they end with) and training count."""
        size = len(self.vocab) + 1
        place = np.arange(len(self.words)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        below, levels = self.words, []
        for level in range(2, order + 1):
            at = np.flatnonzero(place >= level - 2)
            history = below[at - 1]
            if level == 2:
                history[place[at] == 0] = size - 1
            key = history * size + self.words[at]
            by_key = np.argsort(key)
            key, at = key[by_key], at[by_key]
            del by_key, history
            new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
            heads = np.flatnonzero(new)
            count = np.add.reduceat(self.learn[at].astype(np.int64), heads) if len(heads) else heads
            levels.append({"history": key[heads] // size, "word": key[heads] % size, "suffix": below[at[heads]], "count": count})
            below = np.full(len(self.words), -1, np.int64)
            below[at] = np.cumsum(new) - 1
        return levels


def _z(a: np.ndarray) -> bytes:
    """Numbers by byte planes, the high ones being nearly all zero, compressed."""
    a = np.ascontiguousarray(a)
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _u(data: bytes, kind: str = "<i8") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _table(schema: str, rows: list) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, cols, strict=True)})


def _by_bucket(bucket: np.ndarray):
    """(bucket, members in a stable order) of every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]) if len(order) else []
    for a, b in zip(heads, np.r_[heads[1:], len(order)] if len(heads) else [], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _send_words(buckets: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        release_memory()
        t = _Texts(table)
        count = np.bincount(t.words[t.learn], minlength=len(t.vocab))
        return _table(_WORDS, [
            (b, key[0].as_py(), zstandard.ZstdCompressor(level=1).compress("\n".join([t.vocab[i] for i in at]).encode()), _z(count[at]))
            for b, at in _by_bucket(t.hash % buckets)])

    return send


def _sum_words(buckets: int):
    def add(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        open_ = zstandard.ZstdDecompressor()
        words = [open_.decompress(r["words"]).decode().split("\n") for r in rows]
        code = pa.array([w for part in words for w in part], pa.string()).dictionary_encode()
        at = np.asarray(code.indices).astype(np.int64)
        total = np.zeros(len(code.dictionary), np.int64)
        np.add.at(total, at, np.concatenate([_u(r["counts"]) for r in rows]))
        cut = np.cumsum([0, *map(len, words)])
        number = np.arange(len(total)) * buckets + key[0].as_py()
        return _table(_KNOWN, [
            (r["block"], key[0].as_py(), _z(total[at[a:b]]), _z(number[at[a:b]]), int(total.sum()) * (i == 0), int((total > 0).sum()) * (i == 0))
            for i, (r, a, b) in enumerate(zip(rows, cut[:-1], cut[1:], strict=True))])

    return add


def _read_known(t: _Texts, rows: list, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Corpus counts and numbers of a block's words."""
    count, number = np.zeros(len(t.vocab), np.int64), np.zeros(len(t.vocab), np.int64)
    got = {r["bucket"]: r for r in rows}
    for b, at in _by_bucket(t.hash % buckets):
        count[at], number[at] = _u(got[b]["a"]), _u(got[b]["b"])
    return count, number


def _hash(words: list[np.ndarray]) -> np.ndarray:
    hashed = words[0].astype(np.uint64)
    for w in words[1:]:
        hashed = mix64(hashed * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64))
    return hashed


def _spelt(levels: list[dict], number: np.ndarray):
    """Per level its n-grams as columns of word numbers (the start is -1)."""
    wide = np.r_[number, -1]
    below = [wide]
    for g in levels:
        below = [*(w[g["history"]] for w in below), wide[g["word"]]]
        yield below


def _dealt(words: list[np.ndarray], buckets: int):
    """(bucket, its n-grams by their first word), by a hash of the whole n-gram: no word or history is hot."""
    order = np.argsort(words[0], kind="stable")
    bucket = (_hash(words) % np.uint64(buckets)).astype(np.int64)
    for b, at in _by_bucket(bucket[order]):
        yield b, order[at]


def _pack(words: list[np.ndarray], at: np.ndarray) -> bytes:
    """Columns of some n-grams, the first (ascending) as differences."""
    return _z(np.concatenate([np.diff(words[0][at], prepend=0), *(w[at] for w in words[1:])]))


def _unpack(data: bytes, level: int) -> np.ndarray:
    words = _u(data).reshape(level, -1).copy()
    np.cumsum(words[0], out=words[0])
    return words


def _send_grams(buckets: int, order: int):
    def send(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        release_memory()
        if not table.num_rows:
            return _table(_GRAMS, [])
        t = _Texts(table)
        _, number = _read_known(t, known.to_pylist(), buckets)
        levels = t.grams(order)
        parts: dict = {}
        for i, (g, words) in enumerate(zip(levels, _spelt(levels, number), strict=True)):
            for b, at in _dealt(words, buckets):
                parts.setdefault(b, [(b"", b"")] * len(levels))[i] = _pack(words, at), _z(g["count"][at].astype("<u4"))
        return _table(_GRAMS, [(b, key[0].as_py(), [w for w, _ in p], [c for _, c in p]) for b, p in parts.items()])

    return send


def _totals(words: list[np.ndarray], count: np.ndarray) -> np.ndarray:
    """The sum of the counts of all rows that hold the same n-gram, per row."""
    hashed = _hash(words)
    order = np.argsort(hashed)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([w[order[1:]] != w[order[:-1]] for w in words])
    if (new[1:] & (hashed[order[1:]] == hashed[order[:-1]])).any():  # two n-grams of one hash: sort by the words themselves
        order = np.lexsort(words[::-1])
        new[1:] = np.logical_or.reduce([w[order[1:]] != w[order[:-1]] for w in words])
    heads = np.flatnonzero(new)
    total = np.empty(len(order), np.int64)
    total[order] = np.repeat(np.add.reduceat(count[order], heads), np.diff(np.r_[heads, len(order)]))
    return total


def _sum_grams(key: tuple, table: pa.Table) -> pa.Table:
    release_memory()
    rows = table.to_pylist()
    answers: list = [[] for _ in rows]
    for i in range(len(rows[0]["words"])):
        own = [j for j, r in enumerate(rows) if r["words"][i]]
        if not own:
            continue
        words = [_unpack(rows[j]["words"][i], i + 2) for j in own]
        cut = np.cumsum([0, *(w.shape[1] for w in words)])
        total = _totals(list(np.concatenate(words, axis=1)), np.concatenate([_u(rows[j]["counts"][i], "<u4") for j in own]).astype(np.int64))
        for j, x, y in zip(own, cut[:-1], cut[1:], strict=True):
            answers[j].append(total[x:y])
    return _table(_SEEN, [(r["block"], r["bucket"], 1, _z(np.concatenate(t)), None) for r, t in zip(rows, answers, strict=True)])


def automaton(count: np.ndarray, starts: int, a: np.ndarray, b: np.ndarray, seen: np.ndarray, n: int, v: int, mu: float,
              higher: tuple = ()) -> BackoffAutomaton:
    """Automaton over words 0..W-1 with corpus counts; history W is the start of a text (seen ``starts`` times).

    Bigrams are (a, b) with their counts ``seen``; each further level is (histories, last words, suffixes, counts), histories
    and suffixes being places in the level below.
    """
    uni = (count + 1) / (n + v + 1)
    order = 2 + len(higher)
    history = np.r_[count, starts].astype(float)  # counts of the level below
    state = np.where(history > 0, np.arange(1, len(count) + 2), 0)
    root_target, prob, states = state[:-1], uni, len(count) + 2
    fail, back = [np.r_[0.0, np.log10(mu / (history + mu))]], [np.zeros(states, np.int64)]
    arcs = []
    for level, (h, word, suffix, seen) in enumerate([(a, b, b, seen), *higher], 2):
        live = seen > 0
        prob = (seen + mu * prob[suffix]) / (history[h] + mu)
        shorter = state[suffix]
        if level < order:
            own = np.zeros(len(seen), np.int64)
            own[live] = states + np.arange(int(live.sum()))
            states += int(live.sum())
            fail.append(np.log10(mu / (seen[live] + mu)))
            back.append(shorter[live])
        else:
            own = shorter
        arcs.append((state[h[live]], word[live], np.log10(prob[live]), own[live]))
        state, history = own, seen.astype(float)
    return BackoffAutomaton(np.log10(uni), root_target, *(np.concatenate(x) for x in zip(*arcs, strict=True)), np.concatenate(fail),
                            np.concatenate(back), order)


def _score(buckets: int, order: int, n: int, v: int, starts: int, mu: float, schema: pa.Schema):
    def score(key: tuple, table: pa.Table, back: pa.Table) -> pa.Table:
        release_memory()
        if not table.num_rows:
            return schema.empty_table()
        t = _Texts(table)
        rows = back.to_pylist()
        count, number = _read_known(t, [r for r in rows if r["kind"] == 0], buckets)
        levels = t.grams(order)
        got = {r["bucket"]: _u(r["a"]) for r in rows if r["kind"] == 1}
        used = dict.fromkeys(got, 0)
        for g, words in zip(levels, _spelt(levels, number), strict=True):
            g["seen"] = np.zeros(len(g["word"]), np.int64)
            for k, at in _dealt(words, buckets):
                g["seen"][at] = got[k][used[k]:used[k] + len(at)]
                used[k] += len(at)
        first, *rest = levels
        model = automaton(count, starts, first["history"], first["word"], first["seen"], n, v, mu,
                          tuple((g["history"], g["word"], g["suffix"], g["seen"]) for g in rest))
        del levels, first, rest, g, words, got, rows
        begin = len(t.vocab) + 1 if starts else 0
        weight = model.traverse(t.words, t.bounds, begin)
        heads = t.bounds[:-1]
        known = np.add.reduceat((count[t.words] > 0).astype(np.int64), heads)
        return pa.table([t.table["id"], pa.array(~t.train), pa.array(np.diff(t.bounds)), pa.array(known), pa.array(np.full(len(heads), n)),
                         pa.array(np.add.reduceat(model.root_weight[t.words], heads)), pa.array(np.add.reduceat(weight, heads))], schema=schema)

    return score


def score_texts(df: DataFrame, train: Column, id_col: str = "doc_id", text: str = "text", mu: float = 4.0, order: int = 2) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; learns where ``train`` holds."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if order < 2:
        raise ValueError("order must be 2 at least")
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                     F.coalesce(train, F.lit(False)).alias("train"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes"), F.count_if("train").alias("starts")).first()
    blocks = buckets = max(2 * shuffle_partitions(spark), -(-size["bytes"] // BLOCK_BYTES))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("int"))
    by_block = rows.groupBy("block")
    path = shared_dir(spark, "lm-words")
    by_block.applyInArrow(_send_words(buckets), _WORDS).groupBy("bucket").applyInArrow(_sum_words(buckets), _KNOWN) \
        .write.mode("overwrite").parquet(path)
    known = spark.read.schema(_KNOWN).parquet(path)
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    known = known.select("block", "bucket", F.lit(0).alias("kind"), F.col("counts").alias("a"), F.col("numbers").alias("b"))
    grams = by_block.cogroup(known.groupBy("block")).applyInArrow(_send_grams(buckets, order), _GRAMS)
    seen = grams.groupBy("bucket").applyInArrow(_sum_grams, _SEEN)
    schema = df.select(F.col(id_col).cast("long").alias(id_col)).selectExpr(
        "*", "false as held_out", "0L as n_tokens", "0L as n_known", "0L as train_tokens", "0D as base_score", "0D as score").schema
    back = known.unionByName(seen).groupBy("block")
    return by_block.cogroup(back).applyInArrow(
        _score(buckets, order, total["n"], total["v"], size["starts"], mu, to_arrow_schema(schema)), schema)
