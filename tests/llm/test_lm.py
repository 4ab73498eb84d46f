"""The backoff automaton against a plain dictionary model."""

import re
import zlib
from collections import Counter
from math import isclose, log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import lm, queries

from .cases import SF, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*WORD.findall(low), ""]


def brute(rows, held, mu=4.0):
    uni, big, hist = Counter(), Counter(), Counter()
    for i, t in rows:
        if not held(i):
            x = tokens(t)
            uni.update(x)
            big.update(zip([None, *x], x, strict=False))
            hist.update([None, *x[:-1]])
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, t in rows:
        x = tokens(t)
        base = sum(log10((uni[w] + 1) / (n + v + 1)) for w in x)
        h = {**uni, None: hist[None]}
        score = sum(log10((big[a, w] + mu * (uni[w] + 1) / (n + v + 1)) / (h.get(a, 0) + mu)) for a, w in zip([None, *x], x, strict=False))
        out.append((i, held(i), len(x), sum(uni[w] > 0 for w in x), n, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and isclose(g[5], w[5], rel_tol=1e-9) and isclose(g[6], w[6], rel_tol=1e-9)


def held7(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op5_lm_score(spark, SF).collect()
    same(got, brute_any(rows, held7, 3))
    held = [r for r in got if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)  # the n-grams help on unseen texts


def test_odd_rows_ties_and_nulls(spark):
    df = documents(spark).withColumn("score", F.lit("clash"))
    df = df.unionByName(df.filter("doc_id in (4, 9)")).unionByName(spark.createDataFrame([(None, "a b a", None, 1, "x")], df.schema))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    same(lm.score_texts(df, F.col("doc_id").isNull() | (F.col("doc_id") % 3 != 1)).collect(), brute(rows, lambda i: i is not None and i % 3 == 1))


def test_nothing_to_learn_and_empty(spark):
    df = documents(spark, ["a b", None])
    same(lm.score_texts(df, F.lit(False)).collect(), brute([(0, "a b"), (1, None)], lambda i: True))
    assert lm.score_texts(empty(spark), F.lit(True)).count() == 0


@pytest.mark.parametrize("lane", [1, 2, 5, 64])
def test_lanes_do_not_change_the_traversal(monkeypatch, lane):
    rng = np.random.default_rng(0)
    monkeypatch.setattr(lm, "LANE", lane)
    count = np.array([5, 0, 3, 1, 0])
    a, b = np.array([0, 0, 2, 5, 3]), np.array([2, 3, 0, 0, 0])
    m = lm.automaton(count, 2, a, b, np.array([2, 1, 3, 2, 0]), 9, 3, 4.0)
    words = rng.integers(0, 5, 200)
    bounds = np.array([0, 1, 70, 71, 200])
    got = m.traverse(words, bounds, 6)
    for x, y in zip(bounds[:-1], bounds[1:], strict=True):
        state = np.array([6])
        for i in range(x, y):
            w, state = m.step(state, words[i:i + 1])
            assert isclose(w[0], got[i])


def test_probabilities_sum_to_one():
    count = np.array([5, 2, 3])
    m = lm.automaton(count, 2, np.array([0, 0, 1, 2, 3]), np.array([1, 2, 0, 0, 0]), np.array([2, 3, 2, 3, 2]), 10, 3, 4.0)
    for state in range(5):
        w, _ = m.step(np.full(3, state), np.arange(3))
        unknown = m.fail[state] + log10(1 / (10 + 3 + 1))
        assert isclose((10 ** w).sum() + 10 ** unknown, 1.0)


def brute_any(rows, held, order, mu=4.0):
    """Scores by the recursion itself, over dictionaries of all n-grams up to ``order``."""
    grams, uni, hist = Counter(), Counter(), Counter()
    for i, t in rows:
        if not held(i):
            x = [None, *tokens(t)]
            uni.update(x[1:])
            for k in range(2, order + 1):
                for j in range(len(x) - k + 1):
                    grams[tuple(x[j:j + k])] += 1
                    hist[tuple(x[j:j + k - 1])] += 1
    n, v = sum(uni.values()), len(uni)

    def p(h, w):
        return (uni[w] + 1) / (n + v + 1) if not h else (grams[(*h, w)] + mu * p(h[1:], w)) / (hist[h] + mu)

    out = []
    for i, t in rows:
        x = [None, *tokens(t)]
        base = sum(log10(p((), w)) for w in x[1:])
        score = sum(log10(p(tuple(x[max(0, j - order + 1):j]), x[j])) for j in range(1, len(x)))
        out.append((i, held(i), len(x) - 1, sum(uni[w] > 0 for w in x[1:]), n, base, score))
    return out


@pytest.mark.parametrize("order", [2, 3, 4, 5])
def test_every_order_against_the_recursion(spark, order):
    texts = ["a b a b a c", "b a b c a b a", None, "", "a", "c c c c c c", "a b a b a d e", "d e a b", "x " * 300, "a b a b a c"] * 2
    df = documents(spark, texts)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = lm.score_texts(df, F.col("doc_id") % 3 != 1, order=order).collect()
    same(got, brute_any(rows, lambda i: i % 3 == 1, order))


@pytest.mark.parametrize("lane", [1, 2, 64])
def test_orders_over_whole_texts_and_lanes(spark, monkeypatch, lane):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(rng.choice(list("abcd"), rng.integers(0, 90)))) for i in range(40)]
    block = lm._Texts(lm.pa.table({"id": [i for i, _ in rows], "text": [t for _, t in rows], "train": [i % 4 > 0 for i, _ in rows]}))
    monkeypatch.setattr(lm, "LANE", lane)
    count = np.bincount(block.words[block.learn], minlength=len(block.vocab))
    for order in (2, 3, 4):
        first, *rest = block.grams(order)
        m = lm.automaton(count, 30, first["history"], first["word"], first["count"], int(count.sum()), int((count > 0).sum()), 4.0,
                         tuple((g["history"], g["word"], g["suffix"], g["count"]) for g in rest))
        got = np.add.reduceat(m.traverse(block.words, block.bounds, len(block.vocab) + 1), block.bounds[:-1])
        want = brute_any(rows, lambda i: i % 4 == 0, order)
        assert np.allclose(got, [w[6] for w in want])


def test_one_hash_for_all_keeps_n_grams_apart(monkeypatch):
    rng = np.random.default_rng(2)
    words = [rng.integers(-1, 4, 500) for _ in range(3)]
    count = rng.integers(0, 5, 500)
    want = Counter()
    for key, c in zip(zip(*words, strict=True), count, strict=True):
        want[key] += c
    for poor in (lm._hash, lambda w: np.zeros(len(w[0]), np.uint64)):
        monkeypatch.setattr(lm, "_hash", poor)
        assert lm._totals(words, count).tolist() == [want[k] for k in zip(*words, strict=True)]


def test_small_blocks_and_wrong_order(spark, monkeypatch):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    monkeypatch.setattr(lm, "BLOCK_BYTES", 500)
    same(lm.score_texts(df, F.col("doc_id") % 3 != 1, order=3).collect(), brute_any(rows, lambda i: i % 3 == 1, 3))
    with pytest.raises(ValueError):
        lm.score_texts(df, F.lit(True), order=1)
