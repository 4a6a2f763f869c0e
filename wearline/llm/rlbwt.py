"""Repeated substrings from a run-length Burrows-Wheeler index, in numpy.

The segments are concatenated, each with an end of its own. Their suffixes are sorted (prefix
doubling), the transform is cut into runs of equal symbols, and only the suffixes at the ends of
the runs are sampled, with the length that they share with their neighbour across the run's end.
In text order the match length of any other suffix is that of the suffix before it, less one (its
row lies inside a run, so both neighbours are preceded by the same symbol); so the matching
statistics stream from one sample to the next.
"""

from __future__ import annotations

import numpy as np

from wearline.llm.common import SpanHashes

_PACK = 8


def _first_bytes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Eight symbols of every suffix as one number; a segment's end, symbol 0, sorts before any byte.

    Symbols are bytes plus one. No byte of UTF-8 is 255, which would share 254's symbol; other data
    falls back to seven symbols of nine bits.
    """
    n = len(data)
    left = np.minimum(ends - np.arange(n), _PACK)
    if n and data.max() == 255:
        key = np.zeros(n, np.uint64)
        padded = np.append(data, np.zeros(_PACK, np.uint8)).astype(np.uint64) + np.uint64(1)
        for i in range(_PACK - 1):
            key = key << np.uint64(9) | np.where(i < left, padded[i : i + n], np.uint64(0))
        return key
    padded = np.zeros(n + 2 * _PACK, np.uint8)
    padded[:n] = data + np.uint8(1)
    key = np.empty(n, np.uint64)
    for i in range(_PACK):
        # every eighth suffix starts at the same place of a word
        words = padded[i : i + (len(padded) - i) // _PACK * _PACK].view(">u8")
        own = key[i::_PACK]
        own[:] = words[: len(own)]
    # symbols beyond a segment's end are its end
    masks = np.array([0] + [(2**64 - 1) ^ (2 ** (64 - 8 * k) - 1) for k in range(1, _PACK + 1)], np.uint64)
    return key & masks[left]


def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sorted suffixes; ``ends`` holds for each byte the end of its segment.

    A segment's end is smaller than any byte; of equal suffixes the earlier is the smaller.
    """
    n = len(data)
    place = np.arange(n)
    key = _first_bytes(data, ends)
    order = np.argsort(key)
    sorted_key = key[order]
    # a suffix's rank is the first row of those that are equal to it so far
    new = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    alone = new & np.append(new[1:], True)
    # seven symbols are told apart in either case
    rows, width = np.flatnonzero(~alone), _PACK - 1
    while len(rows):
        # only rows of suffixes that are not told apart yet are sorted again, within their groups
        own = order[rows]
        nxt = own + width
        # a suffix that has ended is told apart by its place, before all that go on
        second = np.where(nxt < ends[own], rank[np.minimum(nxt, n - 1)] + n, own)
        key = rank[own] * (2 * n) + second
        by = np.argsort(key)
        own, key = own[by], key[by]
        order[rows] = own
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[own] = np.maximum.accumulate(np.where(new, rows, 0))
        rows, width = rows[~(new & np.append(new[1:], True))], 2 * width
    return order


class RunIndex:
    """Run ends of the transform and the match lengths sampled there.

    Matches shorter than ``least`` need not be measured: they count as none.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int = 1) -> None:
        n, self.least = len(data), least
        self.ends = np.repeat(offsets[1:], np.diff(offsets))
        self.hashes = SpanHashes(data)
        sa = suffix_array(data, self.ends)
        first = np.zeros(n, bool)
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        before = data[sa - 1].astype(np.int64)
        # the symbol before a segment is its own end, unlike any other
        before = np.where(first[sa], -1 - sa, before)
        edge = before[1:] != before[:-1]
        self.runs = int(edge.sum()) + 1 if n else 0
        self.head, self.tail = np.zeros(n, np.int64), np.zeros(n, np.int64)
        head, tail = np.flatnonzero(edge) + 1, np.flatnonzero(edge)
        self.at_head, self.at_tail = np.zeros(n, bool), np.zeros(n, bool)
        shared = self._shared(sa[head], sa[tail])
        if n:
            self.at_head[sa[0]] = self.at_tail[sa[-1]] = True  # no neighbour beyond: nothing shared
        self.at_head[sa[head]], self.head[sa[head]] = True, shared
        self.at_tail[sa[tail]], self.tail[sa[tail]] = True, shared

    def _shared(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a and b, 0 where it is under ``least``."""
        out, most = np.zeros(len(a), np.int64), np.minimum(self.ends[a] - a, self.ends[b] - b)
        at = np.flatnonzero(most >= self.least)
        at = at[self.hashes.of(a[at], a[at] + self.least) == self.hashes.of(b[at], b[at] + self.least)]
        a, b, low, high = a[at], b[at], np.full(len(at), self.least), most[at]
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = self.hashes.of(a, a + mid) == self.hashes.of(b, b + mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        out[at] = low
        return out

    def matching_statistics(self) -> np.ndarray:
        """For every suffix the longest prefix that also starts elsewhere in the segments, where that
        is at least ``least``; a smaller number elsewhere."""
        n = len(self.ends)
        place, out = np.arange(n), np.zeros(n, np.int64)
        for sampled, shared in ((self.at_head, self.head), (self.at_tail, self.tail)):
            last = np.maximum.accumulate(np.where(sampled, place, 0))
            out = np.maximum(out, shared[last] - (place - last))
        return np.minimum(out, self.ends - place)


def repeated_starts(data: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """True at every byte where a string of ``length`` bytes of its segment also starts elsewhere."""
    if not len(data):
        return np.zeros(0, bool)
    return RunIndex(data, offsets, length).matching_statistics() >= length
