"""Prediction by partial matching over bytes: a pretrained context trie, in numpy.

A text is read as four ``PAD`` bytes, its bytes and ``END`` (neither byte occurs in UTF-8). The
trie holds all strings of up to five bytes of the training rows: a context of at most four bytes
and the byte after it. ``Trie`` holds them in memory; ``lm_score.py`` keeps them as tables, which
grow with the corpus, and a task gets the ``Values`` of frequent strings only.

The probability of a byte starts at the longest context with children. With T the sum of the
children's counts and d their number, a child has c / (T + d) and the escape d / (T + d); after
an escape the bytes seen so far are excluded from the shorter context's T and d, and below the
empty context the bytes not yet excluded are equally likely. The probabilities of all bytes add
up to 1 in every context.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from wearline.llm.common import binary_array

ORDER = 4
PAD, END = 0xFE, 0xFF
_EMPTY = np.uint64(2**63)


def padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows with pads before and the end byte behind, where each row's first byte stands, and its end."""
    rows = len(offsets) - 1
    lens = np.diff(offsets)
    first = offsets[:-1] + ORDER + (ORDER + 1) * np.arange(rows)
    out = np.full(len(data) + (ORDER + 1) * rows, PAD, np.uint8)
    row = np.repeat(np.arange(rows), lens)
    out[np.arange(len(data)) + ORDER + (ORDER + 1) * row] = data
    out[first + lens] = END
    return out, first, first + lens + 1


def codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte and end byte the five bytes that end there, and the rows' offsets."""
    text, first, last = padded(data, offsets)
    code = np.zeros(len(text), np.uint64)
    for back in range(ORDER + 1):
        code[back:] |= text[: len(text) - back].astype(np.uint64) << np.uint64(8 * back)
    use = np.ones(len(text), bool)
    for back in range(1, ORDER + 1):
        use[first - back] = False
    at = np.zeros(len(offsets), np.int64)
    np.cumsum(last - first, out=at[1:])
    return code[use], at


def count_codes(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    code = np.sort(code)
    starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
    return code[starts], np.diff(np.append(starts, len(code)))


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    code, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(code)
    code, n = code[order], n[order]
    starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
    return code[starts], np.add.reduceat(n, starts) if len(starts) else n


def code_bytes(code: np.ndarray, before: bytes) -> pa.Array:
    """``before`` and the five bytes of each code, the oldest first."""
    own = code.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - (ORDER + 1) :]
    rows = np.concatenate((np.tile(np.frombuffer(before, np.uint8), (len(own), 1)), own), axis=1)
    return binary_array(rows.reshape(-1), np.arange(len(rows) + 1) * rows.shape[1])


class Values:
    """Open addressing from codes, all different, to a value each."""

    def __init__(self, keys: np.ndarray, value: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 2))))
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _EMPTY, np.uint64)
        self.values = np.zeros(1 << bits, np.float64)
        left, step = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], step)
            free = self.keys[slot] == _EMPTY
            _, once = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[once]
            self.keys[slot[put]], self.values[slot[put]] = keys[left[put]], value[left[put]]
            left = np.delete(left, put)
            step += 1
        self.steps = step

    def _slot(self, code: np.ndarray, step: int) -> np.ndarray:
        start = (code * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        return (start.astype(np.int64) + step) & (len(self.keys) - 1)

    def get(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value of each code, and whether it has one."""
        out, there = np.zeros(len(code)), np.zeros(len(code), bool)
        left = np.arange(len(code))
        for step in range(self.steps + 1):
            slot = self._slot(code[left], step)
            key = self.keys[slot]
            hit = key == code[left]
            out[left[hit]] = self.values[slot[hit]]
            there[left[hit]] = True
            left = left[~hit & (key != _EMPTY)]
            if not len(left):
                break
        return out, there


class Trie:
    """``nodes[j]``: codes and counts of the strings of j + 1 bytes, sorted by code."""

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.code = [c for c, _ in nodes]
        self.count = [n.astype(np.float64) for _, n in nodes]
        self.context, self.total, self.kinds, self.seen_below = [], [], [], []
        for m, (code, count) in enumerate(zip(self.code, self.count, strict=True)):
            context, at = np.unique(code >> np.uint64(8), return_index=True)
            add = lambda x, at=at: np.add.reduceat(x, at) if len(at) else np.zeros(0)
            self.context.append(context)
            self.total.append(add(count))
            self.kinds.append(np.diff(np.append(at, len(code))).astype(np.float64))
            below = np.zeros(len(code))
            if m:
                i, hit = self._find(self.code[m - 1], code & np.uint64(256**m - 1))
                below[hit] = self.count[m - 1][i[hit]]
            self.seen_below.append(add(below))
        # the longest strings, whose probability needs no escape
        self.longest = Values(self.code[ORDER], self.slow(self.code[ORDER]))

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return i, keys[i] == wanted

    def slow(self, code: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each code, level by level."""
        out, open_ = np.zeros(len(code)), np.ones(len(code), bool)
        gone_total, gone_kinds = np.zeros(len(code)), np.zeros(len(code))  # excluded at this level
        for m in range(ORDER, -1, -1):
            context = (code >> np.uint64(8)) & np.uint64(256**m - 1)
            i, there = self._find(self.context[m], context)
            there &= open_
            i = i[there]
            total, kinds = self.total[m][i] - gone_total[there], self.kinds[m][i] - gone_kinds[there]
            j, hit = self._find(self.code[m], code[there] & np.uint64(256 ** (m + 1) - 1))
            weight = np.maximum(total + kinds, 1e-300)
            with np.errstate(divide="ignore"):
                step = np.where(hit, np.log10(self.count[m][j] / weight) if len(j) else 0, 0.0)
                escape = np.where(kinds > 0, np.log10(np.maximum(kinds, 1e-300) / weight), 0.0)
            at = np.flatnonzero(there)
            out[at] += np.where(hit, step, escape)
            open_[at[hit]] = False
            gone_total[at], gone_kinds[at] = self.seen_below[m][i], self.kinds[m][i]
        out[open_] -= np.log10(256 - gone_kinds[open_])
        return out

    def log10(self, code: np.ndarray) -> np.ndarray:
        out, there = self.longest.get(code)
        if not there.all():
            kinds, back = np.unique(code[~there], return_inverse=True)
            out[~there] = self.slow(kinds)[back]
        return out
