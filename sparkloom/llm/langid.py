"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts hashed 1-3-grams (code points, lower case) of a bounded sample of labelled texts: at most
``per_language`` rows of each language, the least by a hash of id and text (so copies are drawn one by one, and a language
of few, often copied texts is learned as well); class priors use all labelled rows. The matrix (features x languages) is at most ``2**bits * max_languages`` doubles and
goes to the tasks with the function; more languages than that raise an error. Scoring is a map over
Arrow batches: gather rows of the matrix, sum per text. No text is shuffled.

Defined cases: a null text or one without a letter is ``und`` with score 0; an empty text is ``und``;
null languages are never learned; with nothing to learn from every text is ``und``; U+0000 parts
n-grams; repeated rows count as often as they occur; equal scores go to the smaller language name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import release_memory

_SLICE = 1 << 19


@dataclass
class NaiveBayes:
    languages: list
    prior: np.ndarray  # log, per language
    weight: np.ndarray  # log, features x languages
    bits: int


def _features(codes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start positions, hashed feature) of the 1-, 2- and 3-grams that hold no U+0000."""
    c = codes.astype(np.uint64)
    whole = codes != 0
    shift = np.uint64(64 - bits)
    h = c * np.uint64(0x9E3779B97F4A7C15)
    for n in (1, 2, 3):
        if n > 1:
            if len(c) < n:
                return
            h = (h[:-1] + c[n - 1:]) * np.uint64(0xD6E8FEB86659FD93)
            whole = whole[:-1] & (codes[n - 1:] != 0)
        at = np.flatnonzero(whole)
        mixed = h[at]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        yield at, (mixed >> shift).astype(np.int64)


def _slices(texts: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, text number of each code point's slot, real length) in bounded slices of whole work.

    A slice ends at a text's end or, in a long text, after ``_SLICE`` code points with two more as context.
    """
    part, owner, size = [], [], 0
    for i, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        for a in range(0, len(codes), _SLICE):
            piece = codes[a:a + _SLICE + 2]
            keep = min(_SLICE, len(codes) - a)
            part += [piece, np.zeros(2, np.uint32)]
            owner.append((i, len(piece) + 2, keep))
            size += len(piece) + 2
            if size >= _SLICE:
                yield np.concatenate(part), *_owners(owner)
                part, owner, size = [], [], 0
    if part:
        yield np.concatenate(part), *_owners(owner)


def _owners(owner: list) -> tuple[np.ndarray, np.ndarray]:
    ids = np.repeat([o[0] for o in owner], [o[1] for o in owner])
    live = np.concatenate([np.arange(o[1]) < o[2] for o in owner])
    return ids, live


def fit(df: DataFrame, text: str = "text", lang: str = "lang", train: Column | None = None, bits: int = 15,
        per_language: int = 4000, max_languages: int = 64, alpha: float = 0.5, id_col: str = "doc_id") -> NaiveBayes:
    """Learn from the rows where ``train`` holds and text and language are not null."""
    own = F.col(id_col) if id_col in df.columns else F.lit(None)
    rows = df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), own.cast("string").alias("id"),
                     (F.lit(True) if train is None else train).alias("train"))
    rows = rows.filter("train and text is not null and lang is not null").drop("train")
    seen = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if len(seen) > max_languages:
        raise ValueError(f"more than max_languages={max_languages} languages")
    names = sorted(seen)
    if not names:
        return NaiveBayes([], np.zeros(0), np.zeros((1 << bits, 0)), bits)
    # A draw by hash leaves about twice the rows wanted; the window keeps the bound whatever repeats.
    share = F.create_map(*[F.lit(x) for k in names for x in (k, min(1.0, 2 * per_language / seen[k]))])
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    order = Window.partitionBy("lang").orderBy("draw", "id", "text")
    sample = rows.withColumn("draw", draw).filter(F.col("draw") < share[F.col("lang")])
    sample = sample.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_language).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), 1 << bits), np.int64)
        for b in batches:
            label = np.array([names.index(x) for x in b["lang"].to_pylist()], np.int64)
            for codes, ids, live in _slices(b["text"].to_pylist()):
                for at, f in _features(codes, bits):
                    ok = live[at]
                    key = (label[ids[at[ok]]] << bits) + f[ok]
                    total += np.bincount(key, minlength=total.size).reshape(total.shape)
        at = np.nonzero(total)
        if len(at[0]):
            yield pa.RecordBatch.from_pydict({"l": at[0].astype(np.int32), "f": at[1].astype(np.int32), "n": total[at]})

    got = sample.mapInArrow(count, "l int, f int, n long").groupBy("l", "f").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((1 << bits, len(names)))
    counts[got["f"].to_numpy(np.int64), got["l"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    weight = np.log(counts + alpha) - np.log(counts.sum(axis=0) + alpha * (1 << bits))
    prior = np.log(np.array([seen[k] for k in names], float) / sum(seen.values()))
    return NaiveBayes(names, prior, weight, bits)


def score_texts(model: NaiveBayes, texts: list) -> tuple[list, np.ndarray]:
    """Predicted language and its posterior for each text (None allowed)."""
    live = [bool(t) and any(map(str.isalpha, t)) for t in texts]
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    total = np.tile(model.prior, (len(texts), 1))
    for codes, ids, whole in _slices([t if ok else "" for t, ok in zip(texts, live, strict=True)]):
        for at, f in _features(codes, model.bits):
            ok = whole[at]
            who, rows = ids[at[ok]], model.weight[f[ok]]
            if len(who):
                first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
                total[who[first]] += np.add.reduceat(rows, first, axis=0)
    best = total.argmax(axis=1)
    top = total.max(axis=1) if len(texts) else np.zeros(0)
    post = 1.0 / np.exp(total - top[:, None]).sum(axis=1)
    return ([model.languages[k] if ok else "und" for k, ok in zip(best, live, strict=True)], np.where(live, post, 0.0))


def predict(df: DataFrame, model: NaiveBayes, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """All columns of ``df`` but those two names, plus the prediction."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = df.drop(*[c for c in df.columns if c in (pred, score)])
    schema = rest.select("*", F.lit("").alias(pred), F.lit(0.0).alias(score)).schema
    arrow = to_arrow_schema(schema)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for b in batches:
            lang, p = score_texts(model, b.column(b.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(p, pa.float64())],
                                             names=arrow.names)

    return rest.mapInArrow(label, schema)
