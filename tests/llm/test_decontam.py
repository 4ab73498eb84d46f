"""Leak search against a full dynamic programme, exact passages of the given tables, and odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.llm import decontam, queries

from .cases import ODD_TEXTS, SF, documents, empty


def edits_inside(pattern, text):
    """Least edits between a whole pattern and any part of a text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def cases(seed=5):
    rng = random.Random(seed)

    def words(a, b):
        return " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 8))) for _ in range(rng.randrange(a, b)))

    def mutate(t, n):
        t = list(t)
        for _ in range(n):
            i, how = rng.randrange(len(t)), rng.random()
            if how < .33:
                t[i] = "z"
            elif how < .66:
                t.insert(i, "y")
            elif len(t) > 1:
                del t[i]
        return "".join(t)

    items = [words(3, 50) for _ in range(12)] + ["abc", "", " ", None]
    texts = []
    for _ in range(45):
        s = rng.choice(items[:12])
        if rng.random() < .4 and len(s) > 110:
            s = s[rng.randrange(0, 20):]
        texts.append(f"{words(0, 30)} {mutate(s, rng.randrange(0, 12))} {words(0, 20)}")
    return items, texts + ["", None, "a", items[0].upper(), items[1].replace(" ", "\n  "), items[2], items[2]]


def brute(p, texts):
    want = {}
    for r, t in enumerate(texts):
        codes = decontam._codes(decontam.normalise(t)).tolist()
        for w, c in enumerate(p.codes):
            e = edits_inside(c.tolist(), codes)
            if e <= p.budget[w]:
                n, best = want.get((r, int(p.item[w])), (0, 99))
                want[r, int(p.item[w])] = (n + 1, min(best, e))
    return want


@pytest.mark.parametrize("piece", [1 << 20, 150])
def test_against_the_full_dynamic_programme(monkeypatch, piece):
    monkeypatch.setattr(decontam, "PIECE", piece)
    items, texts = cases()
    p = decontam.compile_patterns(items)
    want = brute(p, texts)
    assert len(want) > 20
    got = decontam._leaks(p, texts)
    assert {k: v[:2] for k, v in got.items()} == want
    for (r, _), (_, edits, start, end) in got.items():
        part = decontam.normalise(texts[r])[start:end]
        assert min(edits_inside("".join(map(chr, c)), part) for c in p.codes) <= edits


def test_rows_nulls_clashes_and_parts(spark):
    items, texts = cases(6)
    bench = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)], "item_id long, text string, doc_id long")
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, edits long, item_id string")
    want = brute(decontam.compile_patterns(items), texts)
    for part_chars in (10**7, 500):  # one part, several parts
        got = decontam.find_leaks(docs, bench, part_chars=part_chars).collect()
        assert {(r.doc_id, r.item_id): (r.n_passages, r.edits) for r in got} == want and len(got) == len(want)
        kept = decontam.drop_leaks(docs, bench, part_chars=part_chars)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {r for r, _ in want}


def test_empty_tables_and_odd_texts(spark):
    items, _ = cases()
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find_leaks(empty(spark), bench).count() == 0
    assert decontam.find_leaks(documents(spark), none).count() == 0
    assert decontam.drop_leaks(documents(spark), bench).count() == len(ODD_TEXTS)
    own = documents(spark).select(F.col("doc_id").alias("item_id"), "text")
    found = {(r.doc_id, r.item_id) for r in decontam.find_leaks(documents(spark), own).collect()}
    assert {(i, i) for i, t in enumerate(ODD_TEXTS) if len(decontam.normalise(t)) >= 12} <= found


def test_query_finds_the_planted_passages(spark):
    items = {r.item_id: decontam.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = {r.doc_id: decontam.normalise(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = queries.op3_decontaminate(spark, SF).collect()
    assert whole and whole <= {(r.doc_id, r.item_id) for r in got}
    assert len({r.doc_id for r in got}) <= len({d for d, _ in whole}) + 2


def test_every_passage_against_the_full_dynamic_programme():
    items, texts = cases(7)
    p = decontam.compile_patterns(items[:8] + items[12:], q=4, passage=30, max_error=0.1, step=1)
    want = brute(p, texts[:20] + texts[45:])
    got = decontam._leaks(p, texts[:20] + texts[45:])
    assert {k: v[:2] for k, v in got.items()} == want and len(want) > 20


def test_quotes_of_a_passage_are_found_at_every_offset():
    rng = random.Random(9)
    item = "".join(rng.choice("abcdefghij klmnop") for _ in range(260)).strip().replace("  ", "a ")
    item = decontam.normalise(item)
    p = decontam.compile_patterns(["no such words anywhere in it", item, "tiny one"], step=1)
    for n in range(100, 141, 8):
        quotes = [item[s:s + n] for s in range(len(item) - n + 1)]
        noisy = [t[:20] + "#" + t[21:50] + "#" + t[51:90] + "##" + t[92:] for t in quotes]
        got = decontam._leaks(p, [f"0123 {t.strip()} 4567" for t in quotes + noisy])
        assert set(got) == {(r, 1) for r in range(2 * len(quotes))}
    assert set(decontam._leaks(p, ["xtiny oney", "tin one", "a tiny\n ONE"])) == {(0, 2), (2, 2)}


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
@pytest.mark.parametrize("parts", [1, 2, 3])
def test_a_passage_split_over_two_texts_is_in_neither(spark, order, parts):
    rng = random.Random(8)
    item = "".join(rng.choice("abcdefgh ") for _ in range(100)).replace("  ", "xy").strip().ljust(100, "q")
    texts = ["some words before " + item[:55], item[55:] + " and some after", item[:97], item[4:], "tail " + item[:97]]
    p = decontam.compile_patterns([item], step=1)
    alone = [decontam._leaks(p, [t]) for t in texts]
    assert [bool(x) for x in alone] == [False, False, True, True, True]
    rows = [(n, texts[i]) for n, i in enumerate((*order, 2, *order, 3, 0, 3, 4, 1))]
    together = decontam._leaks(p, [t for _, t in rows])
    assert together == {(n, 0): v for n, t in rows for v in decontam._leaks(p, [t]).values()}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = decontam.find_leaks(df, spark.createDataFrame([(7, item)], "item_id long, text string"), step=1).collect()
    assert {(r.doc_id, r.item_id): (r.n_passages, r.edits, r.start, r.end) for r in got} == {(n, 7): v for (n, _), v in together.items()}


def test_benchmark_in_parts_gives_the_same_leaks(spark):
    items, texts = cases(6)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    whole = sorted(map(tuple, decontam.find_leaks(df, asked).collect()))
    assert sorted(map(tuple, decontam.find_leaks(df, asked, part_chars=300).collect())) == whole and whole
    assert sorted(r.doc_id for r in decontam.drop_leaks(df, asked, part_chars=300).collect()) == sorted(set(range(len(texts))) - {r[0] for r in whole})
