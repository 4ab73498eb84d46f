"""Token counts: a batch encoder in Arrow functions that returns lengths only.

Arrow batches are re-cut into slices of about 16 MB of text, long texts at safe boundaries; in a slice
each distinct fragment is encoded once and its length summed per text. No shuffle; memory is one
slice plus a bounded cache of fragment lengths. The tokenizer file is read on the driver and travels
with the function (its size is the vocabulary's, not the data's).

``white_space="dropped"``: the tokenizer drops white space, so any space is a safe boundary;
``"leading"``: byte-level BPE, a space between two other characters opens a token; ``None``: no known
boundary, whole texts are encoded. Sentencepiece models (.model) always encode whole texts.

Defined cases: null and empty texts have 0 bytes and 0 tokens; every row is counted on its own; an
empty table gives no rows; special strings inside texts are handled as the library does by default.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fragments as fr

CACHE = 400_000


@lru_cache(maxsize=2)
def _sentencepiece(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def piece_lengths(pieces: pa.Array, spec: str | bytes, white_space: str | None, continued: np.ndarray, cache: dict) -> np.ndarray:
    """Tokens of every piece."""
    if isinstance(spec, bytes):
        return np.array([len(x) for x in _sentencepiece(spec).encode(pieces.to_pylist(), num_threads=1)], np.int64)
    encode = fr.tokenizer(spec).encode_batch_fast
    if white_space is None:
        return np.array([len(e) for e in encode(pieces.to_pylist(), add_special_tokens=False)], np.int64)
    if white_space == "dropped":
        units, code, bounds = fr.fragments(pieces, np.zeros(len(pieces), bool))
        units = [u.lstrip(" ") for u in units]
    else:
        units, code, bounds = fr.fragments(pieces, continued, fr.ends_space, fr.opens_space)
    new = list({u for u in units if u not in cache})
    fresh = {}
    for a in range(0, len(new), 20_000):
        part = new[a:a + 20_000]
        fresh.update(zip(part, map(len, encode(part, add_special_tokens=False)), strict=True))
    size = np.array([fresh[u] if u in fresh else cache[u] for u in units], np.int64)
    if len(cache) < CACHE:
        cache.update(fresh)
    total = np.r_[0, np.cumsum(size[code])] if len(code) else np.zeros(1, np.int64)
    return total[bounds[1:]] - total[bounds[:-1]]


def token_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text",
                 white_space: str | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens) for every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if tokenizer_path.endswith(".model"):
        with open(tokenizer_path, "rb") as f:
            spec: str | bytes = f.read()
        white_space = None
    else:
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = f.read()
    rows = df.select(F.col(id_col).alias(id_col), F.col(text).cast("string").alias("_text"))
    schema = rows.select(id_col, F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens")).schema
    arrow = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = fr.seen("lengths", spec, white_space)
        for b in batches:
            arr = b["_text"].fill_null("")
            n = np.zeros(len(arr), np.int64)
            for who, pieces, continued in fr.balanced(arr):
                np.add.at(n, who, piece_lengths(pieces, spec, white_space, continued, cache))
            size = pc.binary_length(arr).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n)], schema=arrow)

    return rows.mapInArrow(count, schema)
