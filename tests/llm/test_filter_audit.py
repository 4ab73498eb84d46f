"""Filter audit: difference arrays and query against a loop over all orders; odd rows, repeats, empty tables."""

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkloom.llm import filter_audit, queries
from sparkloom.llm.common import Scratch

from .cases import ODD_TEXTS, SF


def brute(rows, names):
    """rows: (part, set of failed letters, weights...) -> {(part, order, step): values}."""
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        share = Counter()
        for order in itertools.permutations(names):
            left = mine
            for step, f in enumerate(order, 1):
                hit = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                share[f] += len(hit)
                out[part, "".join(order), step] = [len(left), len(hit), sum(f in r[1] for r in mine) - len(hit),
                                                   sum(r[1] == {f} for r in mine), *(sum(r[2 + i] for r in hit) for i in range(len(mine[0]) - 2))]
        for key in [k for k in out if k[0] == part]:
            out[key].append(share[key[1][key[2] - 1]])
    return out


def flags_of(docs, labels):
    """Contract rules in Python."""
    order = {}
    for i, t, _ in docs:
        t = t or ""
        i = float("inf") if i is None else i
        order[t] = min(order.get(t, i), i)
    rows = []
    for i, t, source in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {x for x, hit in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                                            bool(re.search(r"[#$%&*|]", t)), (float("inf") if i is None else i) > order[t]), strict=True) if hit}
        mine = [x for x in labels if i is not None and x[0] == i]
        rows.append((source or "", bad, int(any(x[1] == 1 for x in mine)), int(any(x[2] == 1 for x in mine))))
    return rows


def found(df, weights=("good_lost", "toxic_lost")):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", *weights, "shapley")] for r in df.collect()}


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_intervals_cover_every_order_once(k):
    n = [[0] * (len(list(itertools.permutations(range(k))))) for _ in range(1 << k)]
    orders = list(itertools.permutations(range(k)))
    for mask, step, f, a, b in filter_audit.intervals(k):
        for rank in range(a, b):
            n[mask][rank] += 1
            assert next(i for i, x in enumerate(orders[rank]) if mask >> x & 1) == step and orders[rank][step] == f
    assert n[0] == [0] * len(orders) and all(row == [1] * len(orders) for row in n[1:])


def test_documents_against_brute_force(spark):
    long = " ".join(f"Word{i}" for i in range(400))
    texts = [*ODD_TEXTS, long, long, long.lower(), long.lower() + " #", "x " * 500, "ALL CAPS " * 150, long * 400, None]
    docs = [(i, t, ["a", None, "", "b"][i % 4]) for i, t in enumerate(texts)]
    docs += [(None, long, "a"), (None, "only here", "b"), (None, "only here", "b"), (3, docs[3][1], "z"), (20, long, "b"), (21, long, None)]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 30, 2)] + [(None, 1, 1), (4, None, None), (6, 1, 1), (6, 0, 0)]
    df = spark.createDataFrame([(*d, True, "x") for d in docs], "doc_id long, text string, source string, A boolean, digest string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scratch = Scratch(spark)
    flags = filter_audit.document_flags(df, lab, scratch)
    got = found(filter_audit.audit(flags, "ABCDE", weights={"good_lost": "good", "toxic_lost": "toxic"}, scratch=scratch))
    assert got == brute(flags_of(docs, labels), "ABCDE") and len(got) == 600 * 4


def test_any_filters_nulls_and_empty(spark):
    rows = [("p", True, None, False), ("p", True, True, True), (None, None, None, None), ("q", False, False, True), ("p", False, True, None)]
    df = spark.createDataFrame(rows, "part string, Z boolean, B boolean, M boolean")
    want = brute([(p or "", {x for x, v in zip("ZBM", f, strict=True) if v}) for p, *f in rows], "BMZ")
    assert found(filter_audit.audit(df, "ZBM"), ()) == want
    assert filter_audit.audit(df.limit(0), "ZBM").count() == 0
    with pytest.raises(ValueError):
        filter_audit.audit(df, "ABCDEFGH")
    one = found(filter_audit.audit(df.withColumn("w", F.lit(2)), "Z", weights={"lost": "w"}), ("lost",))
    assert one["p", "Z", 1] == [1, 2, 0, 2, 4, 2]


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert found(queries.op11_filter_audit(spark, SF)) == brute(flags_of(docs, labels), "ABCDE")
