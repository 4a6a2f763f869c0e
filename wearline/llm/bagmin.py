"""BagMinHash signatures of multisets of word shingles, and exact multiset overlap, in numpy.

The weight (count) of a shingle is cut into dyadic strips [0,1), [1,2), [2,4), [4,8) ...; each
strip of each shingle has a Poisson process of its own whose rate is the strip's width, seeded by
the shingle alone. Its points come in ascending order and carry a signature component and a
whole-numbered weight level of the strip, drawn at once from the point's bits (counts of shingles
are small, so halving the strip step by step would save nothing); a point counts if its level lies
under the shingle's weight. A component keeps the smallest point, so two multisets agree in a component
with a probability of exactly their weighted Jaccard similarity. A process is left as soon as its
next point lies above every component of its document.
"""

from __future__ import annotations

import numpy as np

from wearline.llm.common import SpanHashes, mix64
from wearline.llm.words import ASCII_LOWER, word_spans

SHINGLE = 5
COMPONENTS, ROWS_PER_BAND = 96, 4
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FRACTION = 2.0**-53


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every shingle; a row of fewer words has one shingle of all its words."""
    lower = ASCII_LOWER[data]
    starts, ends, first = word_spans(lower, offsets)
    word = SpanHashes(lower).of(starts, ends)
    count = np.diff(first)
    n_shingles = np.where(count == 0, 0, np.maximum(1, count - size + 1))
    row = np.repeat(np.arange(len(count)), n_shingles)
    begin = np.arange(n_shingles.sum()) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + first[:-1][row]
    out = np.zeros(len(begin), np.uint64)
    for i in range(size):
        inside = i < count[row]
        value = np.where(inside, word[np.minimum(begin + i, max(0, len(word) - 1))] if len(word) else 0, np.uint64(i))
        out = mix64(out * _STEP + value)
    return out, row


def bags(shingle: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, shingle) and how often each occurs, ordered by row and shingle."""
    order = np.lexsort((shingle, row))
    s, r = shingle[order], row[order]
    new = np.concatenate(([True], (s[1:] != s[:-1]) | (r[1:] != r[:-1]))) if len(s) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return s[at], r[at], np.diff(np.append(at, len(s)))


def signatures(shingle: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int, components: int = COMPONENTS) -> np.ndarray:
    """rows x components; infinity throughout for a row without shingles."""
    out = np.full(rows * components, np.inf)
    top = np.full(rows, np.inf)
    # one process for each strip that a shingle's weight reaches into
    strips = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(int) + 1, 1)
    of = np.repeat(np.arange(len(shingle)), strips)
    strip = np.arange(len(of)) - np.repeat(np.cumsum(strips) - strips, strips)
    low = np.where(strip == 0, 0, 1 << np.maximum(strip - 1, 0))
    width = np.maximum(low, 1)
    seed = mix64(shingle[of] + strip.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    r, w, x = row[of], weight[of], np.zeros(len(of))
    k = np.zeros(len(of), np.uint64)
    while len(seed):
        points = int(min(64, max(1, 20_000 // len(seed))))
        number = k[:, None] + np.arange(points, dtype=np.uint64)[None]
        a = mix64(seed[:, None] + number * _STEP)
        b = mix64(a ^ np.uint64(0xA0761D6478BD642F))
        gap = -np.log(((a >> np.uint64(11)).astype(np.float64) + 1) * _FRACTION) / (width * components)[:, None]
        # strictly one after the other: a point's bits don't depend on how many are taken at once
        gap[:, 0] += x
        at = np.cumsum(gap, axis=1)
        component = (b & np.uint64(0xFFFFFFFF)) * np.uint64(components) >> np.uint64(32)
        level = low[:, None] + ((b >> np.uint64(32)) * width[:, None].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        counts = (level < w[:, None]) & (at < top[r][:, None])
        where = (r[:, None] * components + component.astype(np.int64))[counts]
        np.minimum.at(out, where, at[counts])
        touched = np.unique(r)
        top[touched] = out.reshape(rows, components)[touched].max(axis=1)
        x = at[:, -1]
        live = x < top[r]
        seed, r, w, x, k, low, width = (v[live] for v in (seed, r, w, x, k + np.uint64(points), low, width))
    return out.reshape(rows, components)


def band_keys(signature: np.ndarray, rows_per_band: int = ROWS_PER_BAND) -> np.ndarray:
    """rows x bands: one hash for each band of components."""
    bits = signature.view(np.uint64)
    bands = bits.shape[1] // rows_per_band
    out = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _STEP, (len(bits), 1))
    for i in range(rows_per_band):
        out = mix64(out * _STEP + bits[:, i::rows_per_band][:, :bands])
    return out.view(np.int64)


def similarities(left: np.ndarray, left_at: np.ndarray, right: np.ndarray, right_at: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of the texts of either side, row by row."""
    rows = len(left_at) - 1
    sides = [bags(*shingles(d, at)) for d, at in ((left, left_at), (right, right_at))]
    s = np.concatenate([side[0] for side in sides])
    r = np.concatenate([side[1] for side in sides])
    n = np.concatenate([side[2] for side in sides])
    order = np.lexsort((s, r))
    s, r, n = s[order], r[order], n[order]
    twin = np.flatnonzero((s[1:] == s[:-1]) & (r[1:] == r[:-1]))
    both = np.bincount(r[twin], np.minimum(n[twin], n[twin + 1]), rows)
    total = np.bincount(r, n, rows)
    return np.where(total > 0, both / np.maximum(total - both, 1), 0.0)




def linked(data: np.ndarray, offsets: np.ndarray, group: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links that join the texts of at least that exact similarity; all pairs are looked at.

    ``group`` numbers what is joined already. Returns a spanning forest: as few links as join
    whatever is to be joined.
    """
    shingle, row, weight = bags(*shingles(data, offsets))
    n = len(offsets) - 1
    total = np.bincount(row, weight, n)
    # a shingle that occurs w times stands for w elements: sets of them overlap as the multisets do
    turn = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    element, row = mix64(np.repeat(shingle, weight) + turn.astype(np.uint64) * _STEP), np.repeat(row, weight)
    _, number, times = np.unique(element, return_inverse=True, return_counts=True)
    shared = times[number] > 1
    number, row = number[shared], row[shared]
    both = np.zeros((n, n), np.float32)
    if len(number):
        _, number = np.unique(number, return_inverse=True)
        order = np.argsort(number, kind="stable")
        number, row = number[order], row[order]
        for first in range(0, number[-1] + 1, 4096):
            a, b = np.searchsorted(number, (first, first + 4096))
            held = np.zeros((n, 4096), np.float32)
            held[row[a:b], number[a:b] - first] = 1
            both += held @ held.T
    near = (both >= similarity * (total[:, None] + total[None, :] - both)) & (both > 0)
    out, label = [], group.copy()
    for i, j in zip(*np.nonzero(np.triu(near, 1) & (group[:, None] != group[None, :])), strict=True):
        if label[i] != label[j]:
            out.append((int(i), int(j)))
            label[label == label[j]] = label[i]
    return out
