"""Words of many texts at once: spans, hashes and character n-grams of UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from wearline.llm.common import SpanHashes, gather_spans

_byte = np.arange(256, dtype=np.uint8)
IS_UPPER = (_byte >= 65) & (_byte <= 90)
ASCII_LOWER = np.where(IS_UPPER, _byte + 32, _byte).astype(np.uint8)
#: Letters, digits and every byte of a character beyond ASCII.
IS_WORD = ((_byte >= 48) & (_byte <= 57)) | IS_UPPER | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
IS_ASCII_LETTER = IS_UPPER | ((_byte >= 97) & (_byte <= 122))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each row (one more at the end)."""
    inside = is_word[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes, one place of each, and for every place its number."""
    found, sample, back = np.unique(hashes, return_index=True, return_inverse=True)
    return found, sample, back


def char_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each ``<word>``, word after word, and the words' offsets."""
    body, at = gather_spans(data, starts, ends)
    lens = ends - starts + 2
    offsets = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    framed = np.full(offsets[-1], ord("<"), np.uint8)
    framed[offsets[1:] - 1] = ord(">")
    word = np.repeat(np.arange(len(lens)), lens - 2)
    framed[np.arange(len(body)) + 2 * word + 1] = body
    hashes = SpanHashes(framed)
    owner = np.repeat(np.arange(len(lens)), lens)
    last = np.repeat(offsets[1:], lens)
    place = np.arange(len(framed))
    out, of = [], []
    for n in sizes:
        fits = place + n <= last
        first = place[fits]
        out.append(hashes.of(first, first + n))
        of.append(owner[fits])
    grams, owners = np.concatenate(out), np.concatenate(of)
    order = np.argsort(owners, kind="stable")
    counts = np.bincount(owners, minlength=len(lens))
    ends_of = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(counts, out=ends_of[1:])
    return grams[order], ends_of
