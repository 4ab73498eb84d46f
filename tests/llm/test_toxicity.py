"""Toxicity: segments against brute force, word counts and log-odds against a plain loop, held-out results, odd rows."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import queries, toxicity

from .cases import ODD_TEXTS, SF, documents, empty


def maximal_segments(score):
    """By definition: the best segment (shortest among equals, leftmost), then the same left and right of it."""
    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += score[b]
                if total > 1e-12 and (found is None or total > found[2] + 1e-12):
                    found = (a, b + 1, total)
        return [] if found is None else [*best(lo, found[0]), found, *best(found[1], hi)]

    return best(0, len(score))


@pytest.mark.parametrize("seed", range(40))
def test_segments_against_the_definition(seed):
    rng = random.Random(seed)
    # Powers of two: no ties and exact sums.
    score = [rng.choice([-1, 1]) * (rng.randrange(1, 64) + rng.randrange(1 << 20) / (1 << 22)) * rng.choice([1, 1, .25]) for _ in range(rng.randrange(1, 40))]
    got = toxicity.segments(np.array(score))
    want = maximal_segments(score)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_words_of_texts():
    texts = [*ODD_TEXTS, "Idiot! an IDIOT's x_y z9"]
    vocab, number, bounds = toxicity.split_words(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        got = [vocab[k] for k in number[bounds[i]:bounds[i + 1]]]
        assert all(w and (re.fullmatch(r"[^\W_]+", w) or w.isalnum()) for w in got)
    assert got == ["idiot", "an", "idiot", "s", "x", "y", "z9"]


def corpus(n=600, seed=5):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha", "li", "mo") for b in ("ra", "ne", "to", "su", "pi", "kel", "ton", "mar", "x")]
    bad = ["vilga" + x for x in ("", "ra", "ne", "to")] + ["scorn" + x for x in ("ed", "er", "")]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 7 == 0
        t = [rng.choice(words) for _ in range(rng.randrange(30, 400))]
        if toxic:
            for _ in range(max(3, len(t) // 40)):
                t.insert(rng.randrange(len(t)), rng.choice(bad))
        docs.append((i, " ".join(t)))
        if i % 5:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, score int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_log_odds_against_a_plain_loop(spark):
    docs, labels = corpus()
    df, lab = frames(spark, docs, labels)
    prior, z_min, score_min = 5.0, 4.0, 2.5
    rows = [r for r in toxicity._sample(df, lab, F.lit(True), "doc_id", "text", "toxic", 20_000)[0].collect()]
    text_of, toxic_of = dict(docs), {i: t for i, _, t in labels}
    assert Counter((r.text, r.toxic) for r in rows) == Counter({(text_of[i], t): 1 for i, t in toxic_of.items()})
    n = [Counter(), Counter()]
    for r in rows:
        if r.part:
            n[r.toxic].update(set(re.findall(r"[a-z0-9]+", r.text)))
    learned = [r.toxic for r in rows if r.part]
    share = sum(learned) / len(learned)
    s = [Counter(), Counter()]
    for t in (0, 1):
        for w, c in n[t].items():
            s[t][w[:4]] += c
    model = toxicity.fit(df, lab)
    odds = share / (1 - share)
    named = {}
    for w in n[0] | n[1]:
        mean = (s[1][w[:4]] + prior * share) / (s[0][w[:4]] + s[1][w[:4]] + prior)
        one, none = n[1][w] + prior * mean, n[0][w] + prior * (1 - mean)
        score = math.log(one / none / odds)
        if abs(score) >= score_min and abs(score) / math.sqrt(1 / one + 1 / none) >= z_min:
            named[w] = score
    assert set(model.words) == set(named) and all(abs(model.words[w] - named[w]) < 1e-9 for w in named)
    roots = {}
    for w in s[0] | s[1]:
        one, none = s[1][w] + prior * share, s[0][w] + prior * (1 - share)
        score = math.log(one / none / odds)
        if abs(score) >= score_min and abs(score) / math.sqrt(1 / one + 1 / none) >= z_min:
            roots[w] = score
    assert set(model.stems) == set(roots) and all(abs(model.stems[w] - roots[w]) < 1e-9 for w in roots)
    assert {w for w in n[0] | n[1] if model.of(w) > 1} == {w for w in n[1] if w.startswith(("vilga", "scorn"))}
    assert model.of("vilgaunseen") > 1 > 0 > model.of("neverseen") and model.share == sum(toxic_of.values()) / len(toxic_of)


def test_finds_passages_and_bounds_the_sample(spark):
    docs, labels = corpus()
    df, lab = frames(spark, docs, labels)
    got = {r.doc_id: r for r in toxicity.predict(df, toxicity.fit(df, lab)).collect()}
    assert all((got[i].score >= .7) == (i % 7 == 0) and 0 <= got[i].score <= 1 for i, _ in docs)
    for i, t in docs:
        words = t.split()
        assert bool(got[i].passages) == (i % 7 == 0)
        for p in got[i].passages:
            assert words[p["first"]].startswith(("vilga", "scorn")) and words[p["end"] - 1].startswith(("vilga", "scorn"))
    small = toxicity.fit(df, lab, per_class=30)
    told = toxicity._sample(df, lab, F.lit(True), "doc_id", "text", "toxic", 30)[0].groupBy("toxic").count().collect()
    assert {r["toxic"]: r["count"] for r in told} == {0: 30, 1: 30} and small.share == toxicity.fit(df, lab).share


def test_copies_teach_once_and_odd_labels(spark):
    docs, labels = corpus(200)
    df, lab = frames(spark, docs, labels)
    again, more = frames(spark, [*docs, *[(1000 + i, docs[7][1]) for i in range(50)], (None, "vilga")],
                         [*labels, *[(1000 + i, 1, 1) for i in range(50)], (None, 1, 1), (5000, None, None), (8, 0, None)])
    assert toxicity.fit(again, more).words == toxicity.fit(df, lab).words
    assert toxicity.fit(df, lab.filter("toxic = 0")).share == 0
    none = toxicity.predict(df, toxicity.fit(df, lab.limit(0))).select("score", "passages").distinct().collect()
    assert [(r.score, r.passages) for r in none] == [(0.0, [])]


def test_odd_rows_and_empty(spark):
    docs, labels = corpus(200)
    model = toxicity.fit(*frames(spark, docs, labels))
    odd = documents(spark, [*ODD_TEXTS, "vilga vilgara vilga " * 20, "bara cene " * 300_000])
    got = {r.doc_id: r for r in toxicity.predict(odd.withColumn("passages", F.lit(1)), model).collect()}
    assert len(got) == len(ODD_TEXTS) + 2 and all(0 <= r.score <= 1 for r in got.values())
    assert got[len(ODD_TEXTS)].score > .9 and got[len(ODD_TEXTS) + 1].score < .5 and got[0].score == got[1].score
    assert toxicity.predict(empty(spark), model).count() == 0
    assert toxicity.fit(empty(spark), spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")).share == 0


def test_query_held_out(spark):
    got = {r.doc_id: r for r in queries.op12_toxicity(spark, SF.replace("0.001", "0.01")).collect()}
    labels = spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet").collect()
    assert all(r.held_out == (crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= .7) for i, r in got.items())
    held = [(got[x.doc_id].predicted, x.toxic) for x in labels if got[x.doc_id].held_out]
    assert sum(p == t for p, t in held) >= .95 * len(held)
    assert sum(p for p, t in held if t) >= .7 * sum(t for _, t in held)
