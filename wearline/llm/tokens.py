"""Byte-level BPE ids of whole texts, each distinct piece merged once per block.

The pre-tokenizer's pattern is evaluated for all characters of a block at once; only the distinct
pieces go through the merges. The ids equal those of the ``tokenizers`` file, special-token
strings in a text being ordinary text (tests compare them).
"""

from __future__ import annotations

import base64
import functools
import sys
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np

from wearline.llm.common import SpanHashes

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Distinct pieces a worker remembers; the memory is emptied when full.
REMEMBERED = 300_000


@functools.cache
def _classes() -> np.ndarray:
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    kind = {"L": LETTER, "N": NUMBER}
    for i in range(sys.maxunicode + 1):
        out[i] = kind.get(unicodedata.category(chr(i))[0], OTHER)
    # The characters of Unicode's White_Space property.
    spaces = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    out[spaces] = SPACE
    return out


def piece_starts(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """True where a piece of the pattern begins; ``rows`` holds the first character of each row."""
    n = len(points)
    kind = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[rows] = True
    first[n] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # the last space before a word stands apart; a plain blank joins the word
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n]) if n > 1 else np.zeros(0, int)
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points == 39) & start)
    quote = quote[~first[quote + 1]]
    if len(quote):
        one = points[quote + 1]
        short = np.isin(one, [ord(c) for c in "stmd"])
        two_in = ~first[np.minimum(quote + 2, n)]
        two = np.where(two_in, points[np.minimum(quote + 2, n - 1)], 0)
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        hit, size = quote[short | pair], np.where(short, 1, 2)[short | pair]
        start[hit + 1] = False
        after = hit + 1 + size
        start[after[after < n]] = True
    return start


class ByteBPE:
    """Ids of many texts at once, from a rank file."""

    def __init__(self, merge: Callable[[bytes], list[int]]) -> None:
        self.merge, self.known = merge, {}

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the rows of UTF-8 bytes, one row after the other, and their offsets."""
        n_rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_rows + 1, np.int64)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        byte_of = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        row_byte = offsets[:-1][offsets[1:] > offsets[:-1]]
        begin = piece_starts(points, np.searchsorted(byte_of, row_byte))
        starts = byte_of[:-1][begin]
        ends = np.append(starts[1:], len(data))
        _, sample, back = np.unique(SpanHashes(data).of(starts, ends), return_index=True, return_inverse=True)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        found = []
        for s, e in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True):
            piece = raw[s:e]
            ids = known.get(piece)
            if ids is None:
                ids = known[piece] = array("I", self.merge(piece)).tobytes()
            found.append(ids)
        flat_ids = np.frombuffer(b"".join(found), np.uint32)
        lens = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = np.cumsum(lens) - lens
        count = lens[back]
        ends_of = np.cumsum(count)
        index = np.arange(ends_of[-1]) + np.repeat(at[back] - (ends_of - count), count)
        out = np.zeros(n_rows + 1, np.int64)
        out[1:] = np.concatenate(([0], ends_of))[np.searchsorted(starts, offsets[1:])]
        return flat_ids[index], out


@functools.cache
def byte_bpe(name: str = "byte_bpe_50k.tiktoken") -> ByteBPE:
    """The public vocabulary of that name, loaded once per process."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    enc = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return ByteBPE(enc._encode_single_piece)
