"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

Model. Words (lower case, runs of letters and digits) are counted in a bounded sample of labelled texts, each different text once, and a word once
a text (words come in bursts). A word's log-odds of the toxic class have a Dirichlet prior of ``prior`` pseudo-counts, whose mean is the share of its
first ``stem`` characters, whose own prior mean is the class's share of all texts; so an unseen form of a known stem is not neutral. Words and
stems whose log-odds are at least ``score_min`` and stand ``z_min`` standard errors away from nought are kept by name (``max_words`` at most, the clearest
first); all others are pooled into one score, which is a little below nought.

Scan. A text is a sequence of scores. One linear pass finds all its maximal scoring segments (disjoint; none can be
extended or joined for a better score). For words of clean texts a segment of n words reaches S by chance with E = K n exp(-lambda S);
lambda solves sum p(s) exp(lambda s) = 1 over the scores of clean words. Segments with E <= ``e_max`` are the *significant passages*.

Score. x = lambda S - ln n of the best segment, plus what further significant passages have above nought. Clean texts follow an
extreme-value (Gumbel) law, fitted by quartiles to a part of the sample that nothing was counted on, toxic texts another. The score is
the posterior p f1(x) / (p f1(x) + (1 - p) f0(x)), p the share of toxic rows; below the place of the clean law it stays what it is there.

On Spark: labelled ids are drawn first (exact bound, a distributed top-k by hash) and broadcast as a list of bounded size; the sample's words
are counted by partial aggregation and chosen by DataFrame expressions; scoring is a map over Arrow batches with the bounded table.

Bound: ``per_class`` ids of each label. Defined cases: null and empty texts and texts without words have the score of a text without
segments; a null id is never learned from; rows of ``labels`` with a null id or label teach nothing, an id labelled both ways is toxic; copies
are learned once; with one class missing every score is 0; an empty table gives no rows; very long texts are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SLICE_BYTES = 4 << 20
GAP = r"[^\p{L}\p{N}]+"


@dataclass
class Model:
    words: dict = field(default_factory=dict)
    stems: dict = field(default_factory=dict)
    other: float = -0.01
    stem: int = 4
    rate: float = 1.0  # lambda
    clean: tuple = (0.0, 1.0)  # Gumbel place and scale
    toxic: tuple = (0.0, 1.0)
    share: float = 0.0
    e_max: float = 0.01

    def of(self, word: str) -> float:
        got = self.words.get(word)
        return self.stems.get(word[:self.stem], self.other) if got is None else got


def split_words(texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    """(vocabulary, vocabulary number of every word, bounds per text)."""
    split = pc.split_pattern_regex(pc.utf8_lower(texts.fill_null("")), GAP)
    flat, offs = split.flatten(), np.asarray(split.offsets).astype(np.int64)
    code = flat.dictionary_encode()
    vocab, number = code.dictionary.to_pylist(), np.asarray(code.indices).astype(np.int64)
    if "" in vocab:
        real = number != vocab.index("")
        return vocab, number[real], np.r_[0, np.cumsum(real)][offs - offs[0]]
    return vocab, number, offs - offs[0]


def slices(arr: pa.Array) -> Iterator[pa.Array]:
    """Runs of about ``SLICE_BYTES`` of text."""
    size = np.asarray(pc.binary_length(arr.fill_null(""))).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // SLICE_BYTES)) + 1).tolist(), len(arr)]
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        yield arr.slice(x, y - x)


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), left to right."""
    above = score > 0
    if not above.any():
        return []
    edge = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
    total = np.add.reduceat(score, edge)
    ends = np.r_[edge[1:], len(score)]
    out: list = []  # (first, end, sum before, sum with)
    run = 0.0
    for a, b, s in zip(edge.tolist(), ends.tolist(), total.tolist(), strict=True):
        if s <= 0:
            run += s
            continue
        first, low, high = a, run, run + s
        run = high
        while True:
            # The last kept segment that begins lower; those after it begin no lower and stay as they are.
            j = len(out) - 1
            while j >= 0 and out[j][2] >= low:
                j = out[j][4]
            if j < 0 or out[j][3] >= high:
                out.append((first, b, low, high, j))
                break
            first, low = out[j][0], out[j][2]
            del out[j:]
    return [(first, end, high - low) for first, end, low, high, _ in out]


def scan(texts: pa.Array, model: Model, known: dict) -> Iterator[tuple[int, list]]:
    """(number of words, segments) of every text; ``known`` caches the words' scores."""
    vocab, number, bounds = split_words(texts)
    value = np.array([known[w] if w in known else model.of(w) for w in vocab])
    if len(known) < 400_000:
        known.update(zip(vocab, value.tolist(), strict=True))
    score = value[number] if len(number) else np.zeros(0)
    for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        yield y - x, segments(score[x:y])


def statistic(n: int, found: list, rate: float, place: float = 0.0) -> float:
    """x of a text: its best segment against its length, and what others have above nought."""
    length = math.log(max(n, 1))
    each = sorted((rate * s - length - place for _, _, s in found), reverse=True)
    return (each[0] + sum(x for x in each[1:] if x > 0) if each else -length - place) + place


def gumbel(x: np.ndarray, least: float = 1.0) -> tuple[float, float]:
    """Place and scale by quartiles, which a few odd texts do not move; the scale of normalised scores is 1 at least."""
    low, mid, high = np.quantile(x, [.25, .5, .75])
    scale = max(float(high - low) / (math.log(math.log(4)) - math.log(math.log(4 / 3))), least)
    return float(mid) + math.log(math.log(2)) * scale, scale


def log_density(x: float, law: tuple) -> float:
    t = (law[0] - x) / law[1]
    return t - math.exp(min(t, 700.0)) - math.log(law[1])


def posterior(x: float, model: Model) -> float:
    if model.share <= 0:
        return 0.0
    x = max(x, model.clean[0])
    more = math.log((1 - model.share) / model.share) + log_density(x, model.clean) - log_density(x, model.toxic)
    return 1.0 / (1.0 + math.exp(min(more, 700.0)))


def _sample(df: DataFrame, labels: DataFrame, train: Column, id_col: str, text: str, label: str, per_class: int) -> tuple[DataFrame, dict]:
    """(text, toxic, part) of the drawn rows, one per different text, and the rows of each class."""
    told = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label) == 1).cast("int")).alias("toxic"))
    told = told.filter(train)
    seen = {r["toxic"]: r["n"] for r in told.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = (F.xxhash64("id"), F.col("id"))
    drawn = told.filter("toxic = 1").orderBy(*order).limit(per_class).unionByName(told.filter("toxic = 0").orderBy(*order).limit(per_class))
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).join(F.broadcast(drawn), "id")
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    rows = rows.groupBy(digest.alias("digest")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    return rows.select("text", "toxic", F.pmod(F.xxhash64("digest"), F.lit(4)).alias("part")), seen


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, clean, toxic): texts of a slice that hold the word."""
    for b in batches:
        at = 0
        for part in slices(b["text"]):
            vocab, number, bounds = split_words(part)
            key = np.unique(np.repeat(np.arange(len(part)), np.diff(bounds)) * len(vocab) + number)
            toxic, number = np.asarray(b["toxic"].slice(at, len(part))).astype(bool)[key // max(len(vocab), 1)], key % max(len(vocab), 1)
            at += len(part)
            n = [np.bincount(number[toxic == t], minlength=len(vocab)).astype(np.int64) for t in (False, True)]
            yield pa.RecordBatch.from_arrays([pa.array(vocab, pa.string()), pa.array(n[0]), pa.array(n[1])], names=["word", "clean", "toxic"])


def _log_odds(clean: Column, toxic: Column, mean: Column, odds: float, prior: float) -> tuple[Column, Column]:
    """(log-odds against the class odds, standard errors from nought) with a Dirichlet prior of the given mean."""
    one, none = toxic + mean * prior, clean + (F.lit(1.0) - mean) * prior
    score = F.log(one / none) - F.lit(math.log(odds))
    return score, score / F.sqrt(F.lit(1.0) / one + F.lit(1.0) / none)


def fit(df: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 20_000, max_words: int = 100_000, prior: float = 5.0, stem: int = 4, score_min: float = 2.5, z_min: float = 4.0, e_max: float = 0.01) -> Model:
    """Learn from the labelled rows for which ``train`` (an expression over the column ``id``) holds."""
    scratch = Scratch(df.sparkSession)
    rows, seen = _sample(df, labels, F.lit(True) if train is None else train, id_col, text, label, per_class)
    if not seen.get(0) or not seen.get(1):
        return Model()
    sample = scratch.write(rows, "toxicity-sample")
    words = sample.filter("part > 0").select("text", "toxic").mapInArrow(_count, "word string, clean long, toxic long")
    words = words.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter("word <> ''")
    total = sample.filter("part > 0").agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic")).first()
    if not total["clean"] or not total["toxic"]:
        scratch.close()
        return Model()
    words = scratch.write(words, "toxicity-words")
    share = total["toxic"] / (total["clean"] + total["toxic"])
    odds = share / (1 - share)
    stems = words.groupBy(F.substring("word", 1, stem).alias("stem")).agg(F.sum("clean").alias("sc"), F.sum("toxic").alias("st"))
    mean = (F.col("st") + F.lit(prior * share)) / (F.col("st") + F.col("sc") + F.lit(prior))
    score, z = _log_odds(F.col("sc"), F.col("st"), F.lit(share), odds, prior)
    stems = stems.select("stem", mean.alias("mean"), score.alias("stem_score"), z.alias("stem_z"))
    score, z = _log_odds(F.col("clean"), F.col("toxic"), F.col("mean"), odds, prior)
    scored = scratch.write(words.withColumn("stem", F.substring("word", 1, stem)).join(stems, "stem").withColumn("score", score).withColumn("z", z), "toxicity-scores")
    clear, clear_stem = ((F.abs(a) >= score_min) & (F.abs(b) >= z_min) for a, b in (("score", "z"), ("stem_score", "stem_z")))
    named = scored.filter(clear).orderBy(F.desc(F.abs("z")), "word").limit(max_words).select("word", "score").collect()
    roots = scored.filter(clear_stem).select("stem", "stem_score", "stem_z").distinct().orderBy(F.desc(F.abs("stem_z")), "stem").limit(max_words).collect()
    model = Model({r["word"]: r["score"] for r in named}, {r["stem"]: r["stem_score"] for r in roots}, stem=stem, e_max=e_max)
    rest = scored.filter(~clear & ~clear_stem).agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t")).first()
    pooled = math.log(((rest["t"] or 0) + prior * share) / ((rest["c"] or 0) + prior * (1 - share)) / odds)
    model.other = min(pooled, -0.01)
    model.share = seen[1] / (seen[0] + seen[1])
    _calibrate(model, sample)
    scratch.close()
    return model


def _rate(value: np.ndarray, n: np.ndarray) -> float:
    """lambda > 0 with sum p(s) exp(lambda s) = 1 (1 where no score is above nought or the mean is not below it)."""
    p = n / max(n.sum(), 1)
    if not (value[n > 0] > 0).any() or (p * value).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while (p * np.exp(high * value)).sum() < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * value)).sum() < 1 else (low, mid)
    return high


def _calibrate(model: Model, sample: DataFrame) -> None:
    """lambda and the two extreme-value laws from the texts that were not counted (a bounded sample)."""
    held = sample.filter("part = 0").select("text", "toxic")

    def score_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b["text"]):
                vocab, number, _ = split_words(part)
                value, at = np.unique(np.round([model.of(w) for w in vocab], 3), return_inverse=True)
                n = np.bincount(at[number], minlength=len(value)).astype(np.int64) if len(number) else np.zeros(len(value), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(value, pa.float64()), pa.array(n)], names=["value", "n"])

    got = held.filter("toxic = 0").mapInArrow(score_counts, "value double, n long").groupBy("value").agg(F.sum("n").alias("n")).toPandas()
    model.rate = _rate(got["value"].to_numpy(float), got["n"].to_numpy(float))

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict = {}
            x = [statistic(n, found, model.rate) for part in slices(b["text"]) for n, found in scan(part, model, known)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), b["toxic"]], names=["x", "toxic"])

    told = held.mapInArrow(statistics, "x double, toxic int").toPandas()
    clean, toxic = (told["x"][told["toxic"] == t].to_numpy(float) for t in (0, 1))
    model.clean = gumbel(clean) if len(clean) > 1 else (0.0, 1.0)
    model.toxic = gumbel(toxic, model.clean[1]) if len(toxic) > 1 else (model.clean[0] + 10 * model.clean[1], model.clean[1])


_PASSAGES = "array<struct<first: int, end: int, e_value: double>>"


def predict(df: DataFrame, model: Model, text: str = "text", score: str = "score", passages: str = "passages") -> DataFrame:
    """All columns of ``df`` but those two names, plus the score and the significant passages (word places, end exclusive)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = df.drop(*[c for c in df.columns if c in (score, passages)])
    schema = rest.select("*", F.lit(0.0).alias(score), F.lit(None).cast(_PASSAGES).alias(passages)).schema
    arrow = to_arrow_schema(schema)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        place, scale = model.clean
        for b in batches:
            out, spans = [], []
            for part in slices(b.column(b.schema.get_field_index(text))):
                for n, found in scan(part, model, known):
                    out.append(posterior(statistic(n, found, model.rate, place), model))
                    each = [(a, z, math.exp(min((math.log(max(n, 1)) + place - model.rate * s) / scale, 50.0))) for a, z, s in found]
                    spans.append([{"first": a, "end": z, "e_value": e} for a, z, e in each if e <= model.e_max])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64()), pa.array(spans, arrow.field(passages).type)], schema=arrow)

    return rest.mapInArrow(label, schema)
