"""BagMinHash signatures, exact overlaps, components, and near-duplicate classes against brute force."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import minhash, queries
from sparkloom.llm.components import components

from .cases import SF, documents, empty


def bag(text, words=5):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c.lower() if len(c.lower()) == 1 else c for c in text or "")
    w = [x for x in w.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if x]
    return Counter(tuple(w[i:i + words]) for i in range(max(len(w) - words + 1, 1))) if w else Counter()


def jaccard(a, b):
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 0.0


def brute_classes(rows, threshold=0.8):
    """{frozenset of row numbers} of the classes."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or jaccard(bags[i], bags[j]) >= threshold:
                parent[find(i)] = find(j)
    out = {}
    for i in range(len(rows)):
        out.setdefault(find(i), set()).add(i)
    return out.values()


def corpus(seed=3, groups=14, size=9):
    rng = random.Random(seed)

    def words(n):
        return [rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) + str(rng.randrange(60)) for _ in range(n)]

    rows, n = [], 0
    for g in range(groups):
        base = words(rng.randrange(30, 160))
        for _ in range(rng.randrange(1, size)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 9])):
                t[rng.randrange(len(t))] = "edit" + str(rng.randrange(1000))
            rows.append((n, " ".join(t)))
            n += 1
        if g % 3 == 0:  # a class by repeats: the multiset counts decide
            rows.append((n, " ".join(base + base)))
            rows.append((n + 1, " ".join((base + base)[:-1])))
            n += 2
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_signatures_estimate_the_weighted_similarity(seed):
    rng = np.random.default_rng(seed)
    n = 300
    a = rng.integers(0, 6, n)
    b = np.where(rng.random(n) < .7, a, rng.integers(0, 40, n))
    h = minhash.mix64(np.arange(n).astype(np.uint64) + np.uint64(seed * 1000))
    sig = minhash.signatures(np.r_[h[a > 0], h[b > 0]], np.r_[a[a > 0], b[b > 0]], np.r_[0, np.cumsum([(a > 0).sum(), (b > 0).sum()])], 4096)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / 4096) ** .5
    alone = minhash.signatures(h[b > 0], b[b > 0], np.array([0, (b > 0).sum()]), 4096)
    assert (alone[0] == sig[1]).all()  # whatever else is in the batch


def test_bags_and_exact_similarity():
    texts = ["a b c d e f a b c d e f a b c d e", "A b c d e f", "one two", "", " ", "x", "a b c d e f a b c d e f"]
    h, n, cut = minhash.bags(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert sorted(n[cut[i]:cut[i + 1]].tolist()) == sorted(bag(t).values())
        for j, u in enumerate(texts):
            least, most = minhash.similarity((h[cut[i]:cut[i + 1]], n[cut[i]:cut[i + 1]]), (h[cut[j]:cut[j + 1]], n[cut[j]:cut[j + 1]]))
            assert (least, most) == (sum((bag(t) & bag(u)).values()), sum((bag(t) | bag(u)).values()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(1, 20)] + [(50, 30), (60, 61)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys([*range(31), 50], 0), **dict.fromkeys(range(100, 120), 100), 60: 60, 61: 60}


def test_classes_against_brute_force(spark):
    rows = corpus()
    rows += [(None, rows[0][1]), (None, "only null ids here today"), (None, "only null ids here today"), (900, None), (901, ""), (902, " "), (5, rows[1][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, class_id string")
    got = minhash.classes(df).collect()
    text_class = {}
    want = Counter()
    for members in brute_classes(rows):
        ids = [rows[i][0] for i in members]
        least = min((i for i in ids if i is not None), default=None)
        want.update((i, least) for i in ids)
    assert Counter((r.doc_id, r.class_id) for r in got) == want
    del text_class
    kept = minhash.keep_first(df)
    assert kept.columns == df.columns
    left = kept.collect()
    assert len(left) == len(brute_classes(rows))
    assert Counter(r.doc_id for r in left) == Counter(min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for m in brute_classes(rows))


def test_odd_rows_and_empty(spark):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = {r.doc_id: r.class_id for r in minhash.classes(df).collect()}
    assert got == {rows[i][0]: min(rows[j][0] for j in m) for m in brute_classes(rows) for i in m}
    assert minhash.classes(empty(spark)).count() == 0 and minhash.keep_first(empty(spark)).count() == 0


def test_query_links_all_near_texts_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.class_id for r in queries.op7_near_dedup(spark, SF).collect()}
    assert got == {rows[i][0]: min(rows[j][0] for j in m) for m in brute_classes(rows) for i in m}


def band_classes(rows, bands, per_band, threshold=0.8):
    """{frozenset of ids} of the classes that all near pairs sharing a band make, each pair compared."""
    batch = pa.RecordBatch.from_pydict({"node": [b""] * len(rows), "first_id": [i for i, _ in rows], "text": [t for _, t in rows]})
    keys = [k for b in minhash._sign(bands, per_band, 5)([batch]) for k in b["bands"].to_pylist()]
    bags = [bag(t) for _, t in rows]
    place, members, parent = {}, {}, list(range(len(rows)))
    for i, ks in enumerate(keys):
        for k in ks:
            place.setdefault(k, []).append(i)
    for i, j in {(i, j) for same in place.values() for i in same for j in same if i < j}:
        if jaccard(bags[i], bags[j]) >= threshold:
            while parent[i] != i:
                i = parent[i]
            while parent[j] != j:
                j = parent[j]
            parent[j] = i
    for i, (n, _) in enumerate(rows):
        while parent[i] != i:
            i = parent[i]
        members.setdefault(i, set()).add(n)
    return {frozenset(m) for m in members.values()}, max(map(len, place.values()))


def found_classes(spark, texts, **how):
    out = {}
    for r in minhash.classes(spark.createDataFrame(texts, "doc_id long, text string"), **how).collect():
        out.setdefault(r.class_id, set()).add(r.doc_id)
    return {frozenset(m) for m in out.values()}


def chains(seed, n, length):
    """Texts in chains: 0.82 to the next, 0.67 to the one after."""
    rng, texts = random.Random(seed), []
    for _ in range(n):
        t = [f"w{rng.randrange(10**6)}" for _ in range(155)]
        for _ in range(length):
            texts.append(" ".join(t))
            for at in rng.sample(range(5, 150, 5), 3):
                t[at] = f"w{rng.randrange(10**6)}"
    return list(zip(rng.sample(range(len(texts)), len(texts)), texts, strict=True))


def test_linked_texts_still_meet_the_rest_of_their_band(spark):
    """In a band of h, x, y, where x is near both and y is not near h, x and y must meet after x is linked to h."""
    texts = chains(1, 60, 3)
    want, _ = band_classes(texts, 1, 2)
    assert found_classes(spark, texts, bands=1, rows=2) == want


def test_long_chains_stay_whole(spark):
    texts = chains(2, 8, 30)
    want, _ = band_classes(texts, 1, 2)
    assert found_classes(spark, texts, bands=1, rows=2) == want


def test_unlike_texts_of_one_band_all_meet(spark):
    """Near pairs (0.83) over a template that makes all others 0.78 alike: a band of hundreds of unlike texts, several rounds."""
    rng, texts = random.Random(2), []
    base = [f"w{rng.randrange(10**6)}" for _ in range(166)]
    for p in range(200):
        for _ in range(2):
            t = list(base)
            t[10], t[40], t[80], t[120] = f"pair{p}", *(f"w{rng.randrange(10**6)}" for _ in range(3))
            texts.append(" ".join(t))
    texts = list(zip(rng.sample(range(len(texts)), len(texts)), texts, strict=True))
    want, largest = band_classes(texts, 1, 2)
    assert largest > 150
    assert found_classes(spark, texts, bands=1, rows=2) == want


@pytest.mark.parametrize("size", [8, 60])
def test_bands_of_many_blocks_lose_no_link(spark, monkeypatch, size):
    """Blocks of a few texts: what one block does not hold, stragglers and other blocks must still link."""
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", size)
    texts = chains(3, 30, 4)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(166)]
    for p in range(60):
        for _ in range(2):
            t = list(base)
            t[10], t[40], t[80], t[120] = f"pair{p}", *(f"w{rng.randrange(10**6)}" for _ in range(3))
            texts.append((1000 + len(texts), " ".join(t)))
    want, largest = band_classes(texts, 2, 2)
    assert largest > 2 * size or size > 8
    assert found_classes(spark, texts, bands=2, rows=2, first=1) == want


@pytest.mark.parametrize("seed", range(6))
def test_overlaps_by_matrix_product(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(minhash, "_COMMON", rng.choice([2, 4, 16]))
    monkeypatch.setattr(minhash, "_COLUMNS", rng.choice([3, 1024]))
    texts = [" ".join(rng.choices("abcd", k=rng.randrange(1, 60))) for _ in range(rng.randrange(1, 40))]
    e, bounds = minhash.elements(*minhash.bags(pa.array(texts), 2))
    got = minhash.overlaps(e, bounds)
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert got[i, j] == (sum((bag(texts[i], 2) & bag(texts[j], 2)).values()) if i < j else 0)
    label = np.array([rng.randrange(len(texts)) for _ in texts])
    pairs = minhash.links(e, bounds, label, .5)
    parent = list(range(len(texts)))

    def components_of(edges):
        own = {int(k): int(k) for k in label}
        while True:
            before = dict(own)
            for i, j in edges:
                low = min(own[int(label[i])], own[int(label[j])])
                own = {k: low if v in (own[int(label[i])], own[int(label[j])]) else v for k, v in own.items()}
            if own == before:
                return own

    near = [(i, j) for i in parent for j in parent if i < j and jaccard(bag(texts[i], 2), bag(texts[j], 2)) >= .5]
    assert components_of(pairs) == components_of(near) and len(pairs) < max(len(set(label.tolist())), 1)
