"""Texts cut into fragments at boundaries that no token crosses, each distinct fragment kept once.

Tokenizers work word by word, and a batch of texts repeats most of its words: cutting, numbering
the distinct fragments (in Arrow) and encoding each one once costs a fraction of encoding whole texts
and gives the same tokens, as long as the cut is *safe* for the tokenizer in question.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 16 << 20


@lru_cache(maxsize=4)
def tokenizer(spec: str):
    """The tokenizers library's object for the text of a .json file (one per Python worker)."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(spec)
    t.no_truncation()
    t.no_padding()
    return t


_SEEN: dict = {}
_MOST = 2  # caches a worker keeps


def seen(*key) -> dict:
    """A cache that lives as long as the Python worker (module state, never shipped with a function); ``key`` names what
    it depends on by value. A worker keeps the last ``_MOST`` of them."""
    _SEEN[key] = _SEEN.pop(key, {})
    while len(_SEEN) > _MOST:
        _SEEN.pop(next(iter(_SEEN)))
    return _SEEN[key]


def release() -> None:
    _SEEN.clear()


def _plain(text: str, at: int) -> bool:
    """Whether two characters other than white space (and the marker ``\u2581`` for it) stand around a place."""
    around = text[at - 1:at] + text[at + 1:at + 2]
    return len(around) == 2 and not any(c.isspace() or c == "\u2581" for c in around)


def balanced(arr: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Slices of about ``limit`` bytes: (text number of each piece, pieces, piece continues its text).

    A text over the limit is cut at single spaces between two other non-space characters; the space
    at a cut is left out and the next piece is marked as continuing. Without such a space it stays whole.
    """
    arr = arr.fill_null("")
    size = np.asarray(pc.binary_length(arr)).astype(np.int64)
    at = 0
    while at < len(arr):
        if size[at] > limit:
            text, a = arr[at].as_py(), 0
            while a < len(text):
                b = a + limit // 4
                while (b := text.find(" ", b)) >= 0 and not _plain(text, b):
                    b += 1
                b = len(text) if b < 0 else b
                yield np.array([at]), pa.array([text[a:b]], pa.string()), np.array([a > 0])
                a = b + 1
            at += 1
            continue
        end = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), limit, "right")))
        big = np.flatnonzero(size[at:end] > limit)
        end = at + int(big[0]) if len(big) else end
        yield np.arange(at, end), arr.slice(at, end - at), np.zeros(end - at, bool)
        at = end


def fragments(pieces: pa.Array, spaced: np.ndarray, open_end: Callable[[str], bool] | None = None,
              open_start: Callable[[str], bool] | None = None) -> tuple[list, np.ndarray, np.ndarray]:
    """Cut at spaces: (distinct fragments, number of each occurrence's fragment, bounds per piece).

    Every word but a piece's first carries the space before it; the first one if ``spaced``. A cut
    is left out where ``open_end`` holds for the word before it or ``open_start`` for the word after it.
    """
    words = pc.split_pattern(pieces, " ")
    offs = np.asarray(words.offsets).astype(np.int64)
    code = words.flatten().dictionary_encode()
    if isinstance(code, pa.ChunkedArray):
        code = code.combine_chunks()
    vocab, num = code.dictionary.to_pylist(), np.asarray(code.indices).astype(np.int64)
    offs = offs - offs[0]
    lead = np.ones(len(num), bool)
    lead[offs[:-1]] = spaced
    first = np.zeros(len(num), bool)
    first[offs[:-1]] = True
    start = np.ones(len(num), bool)
    if open_end is not None or open_start is not None:
        ends = np.array([open_end(w) for w in vocab], bool) if open_end else np.zeros(len(vocab), bool)
        opens = np.array([open_start(w) for w in vocab], bool) if open_start else np.zeros(len(vocab), bool)
        start[1:] = first[1:] | ~(ends[num[:-1]] | opens[num[1:]])
    key = num * 2 + lead
    used = np.zeros(2 * len(vocab), bool)
    heads = np.flatnonzero(start)
    size = np.diff(np.r_[heads, len(num)])
    plain = size == 1
    used[key[heads[plain]]] = True
    place = np.cumsum(used) - 1
    units = [(" " if k & 1 else "") + vocab[k >> 1] for k in np.flatnonzero(used)]
    out = np.empty(len(heads), np.int64)
    out[plain] = place[key[heads[plain]]]
    extra: dict = {}
    for i in np.flatnonzero(~plain):
        h = heads[i]
        unit = (" " if lead[h] else "") + " ".join(vocab[k] for k in num[h:h + size[i]])
        out[i] = extra.setdefault(unit, len(units) + len(extra))
    units += extra
    return units, out, np.searchsorted(heads, offs)


def opens_space(word: str) -> bool:
    """For byte-level BPE: the space before this word is not the plain start of a token."""
    return not word or word[0].isspace()


def ends_space(word: str) -> bool:
    return not word or word[-1].isspace()
