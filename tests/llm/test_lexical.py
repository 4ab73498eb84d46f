"""Lexical search: bounds hold, block and part cuts change nothing, results equal a plain loop over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from sparkloom.llm import lexical, queries

from .cases import ODD_TEXTS, SF, documents, empty


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    bags = [(i, Counter(tokens(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in {(i, t or "") for i, t in items}:
        scores = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(tokens(text)) if t in b)
            if s > 0:
                scores.append((-s, math.inf if i is None else i))
        for rank, (s, i) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if i == math.inf else i, -s] += 1
    return out


def rows(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def prose(seed, n, vocabulary=300, most=400):
    rng = random.Random(seed)
    words = [f"w{i}" if i % 7 else f"Wé{i}" for i in range(vocabulary)]
    weight = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rng.choices(words, weight, k=int(rng.paretovariate(.7) * 5) % most + 1)) for _ in range(n)]


def test_terms_as_the_pattern_says():
    for t in [*ODD_TEXTS, "Ab-cD_é9\x7f~x", "ÀB 1.5e3"]:
        assert lexical.terms_of(t) == sorted(set(tokens(t)))
        vocab, row, number, tf = lexical.term_counts(pa.array([t or ""]))
        assert {vocab[c]: n for c, n in zip(number, tf, strict=True)} == Counter(tokens(t))


def test_bounds_are_never_below_the_scores():
    texts = prose(1, 300)
    batch = pa.RecordBatch.from_pydict({"digest": [bytes(32)] * 300, "first_id": list(range(300)), "copies": [1] * 300, "text": texts})
    index = [b.to_pylist()[0] for b in lexical._build(12)([batch])]
    n, total = sum(r["docs"] for r in index), sum(r["tokens"] for r in index)
    assert (n, total) == (300, sum(len(tokens(t)) for t in texts))
    held = Counter()
    for r in index:
        held.update(dict(zip(r["vocab"], r["df"], strict=True)))
    assert held == Counter(t for x in texts for t in set(tokens(x)))
    groups = lexical.groups_of([(i, lexical.terms_of(t)) for i, t in enumerate(texts[:20])], {t: 1 + c for t, c in held.items()})
    press, slack = zstandard.ZstdDecompressor(), []
    for r in index:
        if r["width"]:
            for g in groups:
                block = lexical.Block(r, n, total, 0, len(r["texts"]))
                exact = block.exact(g, np.arange(block.rows), {w: i for i, w in enumerate(g.words)}, press)
                true = np.array([exact[:, p].sum(axis=1) for p in g.places])
                upper = block.bounds(g)
                assert (upper >= true).all()
                slack.append((upper.sum(), true.sum()))
    assert sum(u for u, _ in slack) < 2.5 * sum(t for _, t in slack)


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    texts = [*prose(2, 400), *ODD_TEXTS]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[3]) for i in range(40)] + [(None, texts[5]), (None, texts[5]), (7, texts[5]), (7, texts[7]), (8, texts[7])]
    docs += [(2000, " ".join(x or "" for x in texts) * 3), (2001, "lonely" * 10)]
    items = [(i, t) for i, t in enumerate(texts[:25])] + [(3, texts[3]), (3, texts[4]), (50, None), (51, "nowhere else"), (52, texts[3] + " lonely"), (None, "w1 w2"), (53, texts[5])]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int")
    asked = spark.createDataFrame(items, "item_id long, text string")
    how = {"part_bytes": 1000} if small else {}
    if small:
        monkeypatch.setattr(lexical, "GROUP_TERMS", 5)
    assert rows(lexical.search(df, asked, **how)) == brute(docs, items)


def test_row_ranges_change_nothing(monkeypatch):
    texts = prose(4, 200)
    batch = pa.RecordBatch.from_pydict({"digest": [i.to_bytes(32, "big") for i in range(200)], "first_id": list(range(200)), "copies": [1] * 200, "text": texts})
    blocks = [b for b in lexical._build(12)([batch]) if b["width"][0].as_py()]
    weight = {t: 5 for x in texts for t in tokens(x)}
    groups = lexical.groups_of([(i, lexical.terms_of(t)) for i, t in enumerate(texts[:30])], weight)

    def hits():
        return sorted(map(str, (r for b in lexical._search(groups, 200, 5000, 10)(blocks) for r in b.to_pylist())))

    whole = hits()
    monkeypatch.setattr(lexical, "CELLS", 1)
    assert hits() == whole and len(whole) > 200


def test_odd_rows_and_empty(spark):
    df = documents(spark)
    docs = [(r.doc_id, r.text) for r in df.collect()]
    items = [(i, t) for i, t in enumerate(ODD_TEXTS)]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows(lexical.search(df, asked)) == brute(docs, items)
    assert lexical.search(empty(spark), asked).count() == 0
    none = lexical.search(df, asked.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(queries.op13_lexical_search(spark, SF)) == brute(docs, items)
