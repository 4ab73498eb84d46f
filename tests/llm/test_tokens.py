"""Token counts and the token store against the libraries on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sparkloom.llm import fragments, queries, token_count, token_store
from sparkloom.session import shared_dir

from .cases import ODD_TEXTS, SF, documents, empty

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path, texts):
    t = Tokenizer.from_file(path)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def noise(n, seed=1):
    rng = random.Random(seed)
    alphabet = [" ", " ", "\n", "\t", "a", "Be", "the", ".", ",", "'", "s", "1", "é", " ", " ", "́", "<|endoftext|>", "你", "_"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("path,space", [(WORD, "dropped"), (BYTE, "leading"), (BYTE, None)])
def test_counts_equal_the_library_on_whole_texts(spark, path, space):
    texts = ODD_TEXTS + noise(400)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_count.token_counts(documents(spark, texts), path, white_space=space).collect()}
    assert got == {i: (len((t or "").encode()), len(x)) for i, (t, x) in enumerate(zip(texts, library(path, texts), strict=True))}


def test_counts_of_a_sentencepiece_model(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r.doc_id: r.n_tokens for r in token_count.token_counts(documents(spark), path).collect()}
    assert got == {i: len(sp.encode(t or "")) for i, t in enumerate(ODD_TEXTS)}


@pytest.mark.parametrize("path,space", [(WORD, "dropped"), (BYTE, "leading")])
def test_long_texts_are_cut_at_safe_places_only(path, space):
    texts = noise(30, 2) + [" ".join(noise(40, 3)), "word " * 500, "x" * 4000 + " y", "  " * 700 + "a"]
    arr = pa.array(texts, pa.string())
    n = np.zeros(len(texts), np.int64)
    with open(path) as f:
        spec = f.read()
    for who, pieces, continued in fragments.balanced(arr, 256):
        np.add.at(n, who, token_count.piece_lengths(pieces, spec, space, continued, {}))
    assert n.tolist() == [len(x) for x in library(path, texts)]


def test_store_equals_the_library_and_reads_back(spark):
    texts = ODD_TEXTS + noise(200, 5)
    df = documents(spark, texts).unionByName(spark.createDataFrame([(None, "null id", None, 1)], "doc_id long, text string, lang string, n_tokens long"))
    path = shared_dir(spark, "t")
    token_store.write_shards(df, path, BYTE, shard_tokens=300, slice_bytes=300)
    shards = spark.read.parquet(path)
    assert shards.count() > 8
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.read_tokens(shards).collect()}
    at, want = 0, {}
    for i, ids in [(None, library(BYTE, ["null id"])[0]), *enumerate(library(BYTE, texts))]:
        a = np.array([*ids, 0], "<u4")
        want[i] = (at, len(a), zlib.crc32(a.tobytes()))
        at += len(a)
    assert got == want
    token = library(BYTE, ["the"])[0][0]
    held = {r.doc_id: r.n for r in token_store.occurrences(shards, token).collect()}
    assert held == {i: n for i, ids in enumerate(library(BYTE, texts)) if (n := ids.count(token))}


def test_store_of_long_pieces_and_ties(spark):
    texts = ["long text of words " * 40, "dup", "b", None]
    rows = [(0, texts[0]), (1, "z"), (1, "a"), (2, None)]
    path = shared_dir(spark, "t")
    token_store.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), path, BYTE, slice_bytes=64)
    got = token_store.read_tokens(spark.read.parquet(path)).orderBy("start").collect()
    n = [len(x) + 1 for x in library(BYTE, [texts[0], "a", "z", ""])]
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(0, 0, n[0]), (1, n[0], n[1]), (1, n[0] + n[1], n[2]), (2, sum(n[:3]), n[3])]


def test_store_of_an_empty_table(spark):
    path = shared_dir(spark, "t")
    token_store.write_shards(empty(spark), path, BYTE)
    assert token_store.read_tokens(spark.read.schema(token_store.SHARDS).parquet(path)).count() == 0
    assert token_count.token_counts(empty(spark), WORD).count() == 0


@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (700, 3), (5000, 50257), (1024, 70000)])
def test_wavelet_matrix_access_rank_select(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n).astype(np.uint32)
    lens = np.array([n], np.int64)
    w = token_store.WaveletMatrix(token_store.pack(ids, np.array([7]), np.array([0]), lens))
    assert (w.decode() == ids).all() and w.doc_ids.tolist() == [7]
    for i in rng.integers(0, max(n, 1), 20 if n else 0):
        assert w.access(int(i)) == ids[i]
        t = int(ids[i])
        assert w.rank(t, int(i)) == (ids[:i] == t).sum()
        at = np.flatnonzero(ids == t)
        k = int(rng.integers(0, len(at)))
        assert w.select(t, k) == at[k]
    assert w.rank(top + 200000, n) == 0


def test_queries_on_the_given_table(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(rows)
    want = dict(zip(ids, map(len, library(WORD, [rows[i] for i in ids])), strict=True))
    got = queries.op9_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 2048) and r.n_bytes == len(rows[r.doc_id].encode()) for r in got)
    want, at = {}, 0
    for i, x in zip(ids, library(BYTE, [rows[i] for i in ids]), strict=True):
        a = np.array([*x, 0], "<u4")
        want[i] = (at, len(a), zlib.crc32(a.tobytes()))
        at += len(a)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_token_store(spark, SF).collect()} == want


def test_store_of_another_tokenizer_equals_its_library(spark):
    texts = [*ODD_TEXTS, "Hello World, it's 10 o'clock", *noise(60, 9), "long text " * 3000]
    path = shared_dir(spark, "shards-word")
    token_store.write_shards(documents(spark, texts), path, WORD, slice_bytes=2000)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_store.read_tokens(spark.read.schema(token_store.SHARDS).parquet(path)).collect()}
    want = [np.array([*ids, 0], "<u4") for ids in library(WORD, texts)]
    assert got == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(want)}
    with open(WORD) as w, open(BYTE) as b:
        assert not token_store.cuts_known(w.read()) and token_store.cuts_known(b.read())


def test_parts_of_fragments_are_cut_as_one_by_one():
    units = [" a", "a", "a,", " a.b", "a's", " \"a", "a<|endoftext|>", "a<b", "", " ", "1", " x1", "\n\n", "é!", "你好", " a?!)", "a\u0301", "\x00"]
    words, seq, bounds = token_store._cut(pa.array(units))
    assert [[words[k] for k in seq[x:y]] for x, y in zip(bounds[:-1], bounds[1:], strict=True)] == [token_store.parts(u) for u in units]


def test_caches_of_a_worker_are_named_by_content_and_few():
    fragments.release()
    one = fragments.seen("a", "x")
    one["k"] = 1
    assert fragments.seen("a", "x") is one and fragments.seen("a", "y") == {}
    fragments.seen("a", "z")
    assert fragments.seen("a", "x") == {} and len(fragments._SEEN) == 2
    fragments.release()
