"""The piece transducer against the library, a brute-force shortest path, and exact round trips."""

import glob
import os
import random
import sysconfig
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sparkloom.llm import fragments, piece_fst, queries

from .cases import ODD_TEXTS, SF, documents, empty

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def machine():
    return piece_fst.compile_model(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def noise(n):
    rng = random.Random(1)
    alphabet = [" ", " ", "a", "b", "th", "e", "in", "▁", "\n", "é", "你", "1", "2", "_", "(", "==", "import", "\t", "the", "    ", "\x00"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def code_files():
    out = []
    for f in sorted(glob.glob(os.path.join(sysconfig.get_paths()["stdlib"], "*.py")))[:25]:
        with open(f, errors="replace") as h:
            out.append(h.read())
    return out


def test_ids_equal_the_library(machine, library):
    texts = [t or "" for t in ODD_TEXTS] + noise(1500) + code_files()
    ids, n = piece_fst.encode_pieces(machine, pa.array(texts, pa.string()), np.zeros(len(texts), bool), {})
    cut = np.r_[0, np.cumsum(n)]
    for t, x, y in zip(texts, cut[:-1], cut[1:], strict=True):
        assert ids[x:y].tolist() == library.encode(t), t[:80]


def test_long_texts_are_cut_at_safe_places(machine, library):
    texts = [*noise(40), *code_files()[:3], "x" * 900 + " y " + "▁ a " * 300]
    got = [[] for _ in texts]
    for who, pieces, continued in fragments.balanced(pa.array(texts, pa.string()), 300):
        ids, n = piece_fst.encode_pieces(machine, pieces, continued, {})
        for k, x in zip(who, np.split(ids, np.cumsum(n)[:-1]), strict=True):
            got[k] += x.tolist()
    assert got == [library.encode(t) for t in texts]


def test_without_neighbours_it_is_the_tropical_shortest_path(machine):
    from dataclasses import replace

    free = replace(machine, neighbours=None, cost=np.log(machine.cost + 3.0), cache={})
    vocabulary = {}
    for i, p in enumerate(free.pieces):
        if not (p.startswith("<") and p.endswith(">")):
            vocabulary[p] = free.cost[i]
    for text in ["▁the▁theses", "▁import▁numpy", "▁élève", "▁aaaaaaaa"]:
        best = [0.0] + [np.inf] * len(text)
        for y in range(1, len(text) + 1):
            best[y] = min(best[x] + vocabulary.get(text[x:y], np.inf) for x in range(y))
        ids, n = piece_fst.shortest_paths(free, [text])
        assert "".join(free.pieces[i] for i in ids) == text and n.tolist() == [len(ids)]
        assert np.isclose(sum(free.cost[i] for i in ids), best[-1])


def test_encode_decode_rows(spark, library):
    df = documents(spark).withColumn("ids", F.lit("clash"))
    coded = piece_fst.encode(df, PATH)
    got = {r.doc_id: r for r in coded.collect()}
    for i, t in enumerate(ODD_TEXTS):
        want = library.encode(t or "")
        assert got[i].ids == want and got[i].n_tokens == len(want) and got[i].round_trip
        assert got[i].ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes())
    back = {r.doc_id: r.decoded for r in piece_fst.decode(coded, PATH).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(ODD_TEXTS)}
    assert piece_fst.decode(piece_fst.encode(empty(spark), PATH), PATH).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, []), (3, [263])], "doc_id long, ids array<int>")
    assert [r.decoded for r in piece_fst.decode(nulls, PATH).orderBy("doc_id").collect()][:2] == [None, ""]


def test_query(spark, library):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op8_sentencepiece(spark, SF).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    for r in got:
        want = library.encode(rows[r.doc_id])
        assert (r.n_tokens, r.ids_crc32, r.n_bytes) == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()), len(rows[r.doc_id].encode()))


def test_two_models_in_one_session(spark, library, tmp_path):
    """A worker's cache belongs to a model's bytes, so a second model never gets the first one's ids."""
    with open(PATH, "rb") as f:
        data = f.read()
    from sentencepiece import sentencepiece_model_pb2 as pb

    other = pb.ModelProto()
    other.ParseFromString(data)
    a, b = (next(i for i, p in enumerate(other.pieces) if p.piece == x) for x in ("\u2581the", "\u2581of"))
    other.pieces[a].piece, other.pieces[b].piece = "\u2581of", "\u2581the"
    path = str(tmp_path / "other.model")
    with open(path, "wb") as f:
        f.write(other.SerializeToString())
    df = spark.createDataFrame([(i, "the cat of the house") for i in range(20)], "doc_id long, text string")
    for p in (PATH, path, PATH, path):
        want = sentencepiece.SentencePieceProcessor(model_file=p).encode("the cat of the house")
        assert {tuple(r.ids) for r in piece_fst.encode(df, p).collect()} == {tuple(want)}
