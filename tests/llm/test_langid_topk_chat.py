"""Language ID on held-out rows, exact top-k against brute force, chat formatting round trips."""

import hashlib
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import chat, langid, queries, topk

from .cases import ODD_TEXTS, SF, documents, empty


def test_language_id_held_out_accuracy(spark):
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries.op6_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id][0] for r in held) / len(held) > 0.97


def test_language_id_odd_rows(spark):
    learn = spark.createDataFrame([(0, "the cat and the dog", "en"), (1, "der hund und die katze", "de"), (2, None, "fr"), (3, "x", None)],
                                  "doc_id long, text string, lang string")
    model = langid.fit(learn)
    assert model.languages == ["de", "en"]
    df = documents(spark).withColumn("score", F.lit("clash"))
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert len(got) == len(ODD_TEXTS)
    for i, t in enumerate(ODD_TEXTS):
        assert (got[i].lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
    one = langid.score_texts(model, ["the dog"])
    many = langid.score_texts(model, ["der", None, "the dog", "1"])
    assert one[0][0] == many[0][2] == "en" and one[1][0] == pytest.approx(many[1][2])
    nothing = langid.fit(empty(spark))
    assert langid.predict(empty(spark), model).count() == 0
    assert {r.lang_pred for r in langid.predict(df, nothing).collect()} == {"und"}


def plain_features(text, bits):
    """The hashed 1-3-grams of one text, one by one."""
    codes, mask = [ord(c) for c in text.lower()], (1 << 64) - 1
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            gram = codes[i:i + n]
            if 0 in gram:
                continue
            h = gram[0] * 0x9E3779B97F4A7C15 & mask
            for c in gram[1:]:
                h = (h + c) * 0xD6E8FEB86659FD93 & mask
            h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & mask
            yield h >> 64 - bits


def test_language_id_against_brute_force_bayes(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1 and r[1] is not None and r[2] is not None]
    names, bits = sorted({r[2] for r in learned}), 15
    counts = {k: Counter() for k in names}
    for _, t, k in learned:
        counts[k].update(plain_features(t, bits))
    total = {k: sum(counts[k].values()) + 0.5 * (1 << bits) for k in names}
    prior = Counter(r[2] for r in learned)
    got = {r.doc_id: r for r in queries.op6_language_id(spark, SF).collect()}
    for i, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        f = Counter(plain_features(t, bits))
        log = {k: math.log(prior[k] / len(learned)) + sum(n * math.log((counts[k][x] + 0.5) / total[k]) for x, n in f.items()) for k in names}
        best = max(names, key=lambda k: log[k])
        assert got[i].lang_pred == best
        assert got[i].score == pytest.approx(1 / sum(math.exp(v - log[best]) for v in log.values()), abs=1e-6)


def test_language_id_signs_are_no_letters_and_null_ids_are_not_learned(spark):
    learn = spark.createDataFrame([(0, "the cat", "en"), (1, "der hund", "de")], "doc_id long, text string, lang string")
    assert langid.score_texts(langid.fit(learn), ["½", "²", "①", "ⅷ", "a½"])[0][:4] == ["und"] * 4


def test_language_id_sample_is_bounded_whatever_repeats(spark):
    rows = [(i, "same text in english", "en") for i in range(900)] + [(2000 + i, "immer derselbe text", "de") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, per_language=50)
    n = len(list(plain_features("same text in english", 15)))
    # exactly 50 copies of either text were counted: weight of a feature that occurs once in the text
    once = next(x for x, c in Counter(plain_features("same text in english", 15)).items() if c == 1)
    k = model.languages.index("en")
    assert model.weight[once, k] == pytest.approx(math.log((50 + 0.5) / (50 * n + 0.5 * (1 << 15))))
    same = spark.createDataFrame([(7, "one id and text", "en")] * 500, "doc_id long, text string, lang string")
    assert langid.fit(same, per_language=20).weight.max() <= math.log((20 * 3 + 0.5) / (20 * 10 + 0.5 * (1 << 15)))


def test_language_id_slices_do_not_change_scores(monkeypatch):
    model = langid.NaiveBayes(["a", "b"], np.log([0.5, 0.5]), np.log(np.random.default_rng(0).random((1 << 8, 2))), 8)
    texts = ["some words here", "", None, "other é text", "z" * 50]
    whole = langid.score_texts(model, texts)
    monkeypatch.setattr(langid, "_SLICE", 7)
    cut = langid.score_texts(model, texts)
    assert whole[0] == cut[0] and np.allclose(whole[1], cut[1])


def brute_topk(rows, k, is_query, scale=1024):
    ok = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, v in ok:
        if is_query(q):
            s = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in ok if i != q)
            out |= {(q, r + 1, i, -n) for r, (n, i) in enumerate(s[:k])}
    return out


@pytest.mark.parametrize("n", [0, 1, 5, 300])
def test_topk_brute_force_ties_and_odd_vectors(spark, n):
    rng = random.Random(n)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(rng.choice([4, 4, 6]))]) for i in range(n)]
    rows += [(1000, None), (1001, [1.0, None]), (1002, [float("nan")]), (1003, [float("inf")]), (None, [1.0]), (1010, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, score string")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=3, query_block=4, row_block=16)
    assert {tuple(r) for r in got.collect()} == brute_topk(rows, 3, lambda i: i % 10 == 0)


def test_topk_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert {tuple(r) for r in queries.op10_exact_topk(spark, SF).collect()} == brute_topk(rows, 10, lambda i: i % 100 == 0)


def test_escape_is_reversible():
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice("<\\|im_end>a\n") for _ in range(rng.randrange(14)))
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)
        assert chat._unescape_role(chat._escape_role(t)) == t and "\n" not in chat._escape_role(t)


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_chat_round_trip_and_violations(spark):
    rng = random.Random(4)
    convs = {i: [(rng.choice(["user", "assistant", "system", "", "odd\nrole<|"]), t or "") for t in rng.choices(ODD_TEXTS, k=rng.randrange(1, 9))] for i in range(40)}
    rows = [(i, n, r, t, True) for i, c in convs.items() for n, (r, t) in enumerate(c)]
    rows += [(100, 0, None, None, False), (None, 0, "user", "q", True), (None, 1, "assistant", "a", True)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss boolean")
    segments = chat.format_chat(df)
    got = {r.conv_id: r for r in chat.read_chat(segments).collect()}
    want = {**convs, 100: [("", "")], None: [("user", "q"), ("assistant", "a")]}
    assert {i: tuple(r)[1:5] for i, r in got.items()} == {i: digest(c) for i, c in want.items()}
    assert got[None].n_violations == 0 and got[100].n_violations == 2
    texts = {}
    for r in segments.orderBy("conv_id", "turn_no", "part").collect():
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.segment
    assert {i: len(t) for i, t in texts.items()} == {i: r.formatted_chars for i, r in got.items()}
    assert texts[None] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"


def test_chat_ties_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "z")], schema)
    (r,) = chat.read_chat(chat.format_chat(df)).collect()
    assert tuple(r)[1:3] == digest([("user", "z"), ("user", "a"), ("user", "a"), ("user", "b")])[:2]
    assert chat.read_chat(chat.format_chat(spark.createDataFrame([], schema))).count() == 0


@pytest.mark.parametrize("name", ["op1_chat_format", "op10_exact_topk"])
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    cols = [d[0] for d in want.description]
    assert {tuple(r) for r in got.select(*cols).collect()} == set(want.fetchall())
