"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a position: a vector of the word (hashed table) and the scaled sum of the vectors of its
character n-grams (hashed table), both trained; while training, some words are read by their
characters alone. Two gated recurrent layers read a window of words in either
direction; a learned attention weighs the positions; a logistic unit scores the pooled state. A
document's score is that of its windows, pooled by a soft maximum while training (so that one
window can make a document positive) and by the maximum when scoring.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from wearline.llm.common import SpanHashes
from wearline.llm.words import ASCII_LOWER, char_grams, distinct, word_spans

GRAM_SIZES = (3, 4, 5, 6)
WORD_BITS, GRAM_BITS = 18, 18
WORD_DIM, GRAM_DIM, HIDDEN = 4, 4, 8
#: Share of the words that a training batch reads by their characters alone.
DROP = 0.5
#: Words of a window, and from one window to the next; the rest overlaps.
WINDOW, STEP = 32, 24


@dataclass
class Block:
    """Texts as numbers: distinct words, the word at each place, windows of the rows."""

    word: np.ndarray  # hashed word of each distinct word
    gram: np.ndarray  # hashed n-grams of the distinct words
    gram_at: np.ndarray
    place: np.ndarray  # number of the distinct word at each place
    first: np.ndarray  # first place of each window
    length: np.ndarray
    row_at: np.ndarray  # first window of each row, one more at the end


def windows(first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over the words of each row; the last one ends with the row.

    A row without words has one window without words.
    """
    count = np.diff(first_word)
    per_row = np.maximum(1, 1 + -(-(count - WINDOW) // STEP))
    row_at = np.zeros(len(count) + 1, np.int64)
    np.cumsum(per_row, out=row_at[1:])
    row = np.repeat(np.arange(len(count)), per_row)
    offset = (np.arange(row_at[-1]) - row_at[row]) * STEP
    offset = np.maximum(0, np.minimum(offset, count[row] - WINDOW))
    return first_word[row] + offset, np.minimum(count[row], WINDOW), row_at


def read_block(data: np.ndarray, offsets: np.ndarray) -> Block:
    lower = ASCII_LOWER[data]
    starts, ends, first_word = word_spans(lower, offsets)
    found, sample, place = distinct(SpanHashes(lower).of(starts, ends))
    grams, gram_at = char_grams(lower, starts[sample], ends[sample], GRAM_SIZES)
    first, length, row_at = windows(first_word)
    return Block(
        (found >> np.uint64(64 - WORD_BITS)).astype(np.int32),
        (grams >> np.uint64(64 - GRAM_BITS)).astype(np.int32),
        gram_at,
        place,
        first,
        length,
        row_at,
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def class_counts(keys: np.ndarray, rows: np.ndarray, label: np.ndarray, size: int) -> np.ndarray:
    """Rows of label 0 and of label 1 that hold each key."""
    pair = np.unique(keys.astype(np.int64) * len(label) + rows)
    key, row = pair // len(label), pair % len(label)
    return np.stack([np.bincount(key[label[row] == c], minlength=size) for c in (0, 1)])


def log_odds(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of the per cent of the rows of either class that hold a key."""
    neg, pos = counts / np.maximum(1, rows)[:, None] * 100
    return np.log(pos + 2) - np.log(neg + 2)


def add_rows(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sum of the values that fall on each row."""
    return np.stack([np.bincount(rows, column, size) for column in values.T], axis=1).astype(values.dtype)


class BiGRU:
    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + GRAM_DIM, HIDDEN
        self.dropped = None
        small = lambda *s, k=0.3: rng.normal(0, k, s).astype(np.float32)
        self.p = {
            "word": small(1 << WORD_BITS, WORD_DIM, k=0.05),
            "gram": small(1 << GRAM_BITS, GRAM_DIM, k=0.05),
            "xf": small(d, 3 * h), "hf": small(h, 3 * h), "bf": np.zeros(3 * h, np.float32),
            "xb": small(d, 3 * h), "hb": small(h, 3 * h), "bb": np.zeros(3 * h, np.float32),
            "att": small(2 * h), "out": small(2 * h), "bias": np.zeros(1, np.float32),
        }

    def start_from(self, batches: list[tuple[Block, np.ndarray]]) -> None:
        """The first coordinate of both tables starts from how the classes use a word or n-gram."""
        of_word, of_gram, of_rows = np.zeros((2, 1 << WORD_BITS)), np.zeros((2, 1 << GRAM_BITS)), np.zeros(2)
        for block, label in batches:
            lens = block.length
            at = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens) + np.repeat(block.first, lens)
            rows, words = np.repeat(np.repeat(np.arange(len(label)), np.diff(block.row_at)), lens), block.place[at]
            of_rows += [(label == 0).sum(), (label == 1).sum()]
            of_word += class_counts(block.word[words], rows, label, 1 << WORD_BITS)
            pair = np.unique(words.astype(np.int64) * len(label) + rows)
            word, row = pair // len(label), pair % len(label)
            n = block.gram_at[word + 1] - block.gram_at[word]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.gram_at[word], n)
            of_gram += class_counts(block.gram[at], np.repeat(row, n), label, 1 << GRAM_BITS)
        self.p["word"][:, 0] += 0.25 * log_odds(of_word, of_rows)
        self.p["gram"][:, 0] += 0.25 * log_odds(of_gram, of_rows)

    def inputs(self, block: Block) -> np.ndarray:
        """The input vector of every distinct word."""
        mean, words = np.zeros((len(block.word), GRAM_DIM), np.float32), self.p["word"][block.word]
        if self.dropped is not None:
            words = words * ~self.dropped[block.word][:, None]
        if len(block.word):
            mean = np.add.reduceat(self.p["gram"][block.gram], block.gram_at[:-1], axis=0)
            mean /= np.sqrt(np.diff(block.gram_at))[:, None].astype(np.float32)
        return np.concatenate((words, mean), axis=1)

    # ---- forward ----

    def _read(self, projected, places, lens, back: bool, keep: bool):
        """States after every position; positions past a window's end leave the state alone."""
        h, n, t_max = HIDDEN, len(lens), places.shape[1]
        u, state = self.p["hb" if back else "hf"], np.zeros((n, HIDDEN), np.float32)
        states, cache = np.empty((t_max, n, h), np.float32), []
        ragged = n and lens.min() < t_max
        for t in range(t_max - 1, -1, -1) if back else range(t_max):
            x = projected[places[:, t]]
            g = state @ u
            rz = _sigmoid(x[:, : 2 * h] + g[:, : 2 * h])
            r, z = rz[:, :h], rz[:, h:]
            new = np.tanh(x[:, 2 * h :] + r * g[:, 2 * h :])
            nxt = new + z * (state - new)
            if ragged:
                live = (t < lens)[:, None]
                nxt = np.where(live, nxt, state)
            if keep:
                cache.append((t, state, r, z, new, g[:, 2 * h :]))
            state = nxt
            states[t] = state
        return states, cache

    def project(self, block: Block):
        """Input vectors of the distinct words, and their parts of the gates in either direction."""
        v = self.inputs(block) if len(block.word) else np.zeros((1, WORD_DIM + GRAM_DIM), np.float32)
        return v, v @ self.p["xf"] + self.p["bf"], v @ self.p["xb"] + self.p["bb"]

    def forward(self, block: Block, projected, which: np.ndarray | None = None, keep: bool = False):
        """Logits of the windows; with ``keep`` also what the gradients need."""
        first, lens = (block.first, block.length) if which is None else (block.first[which], block.length[which])
        t_max = max(1, int(lens.max(initial=0)))
        vectors, forth, back = projected
        at = first[:, None] + np.arange(t_max)
        live = np.arange(t_max) < lens[:, None]
        at = np.where(live, at, 0)
        places = block.place[at] if len(block.place) else np.zeros_like(at)
        sf, cf = self._read(forth, places, lens, False, keep)
        sb, cb = self._read(back, places, lens, True, keep)
        h = HIDDEN
        weight = sf @ self.p["att"][:h] + sb @ self.p["att"][h:]
        weight = np.where(live.T, weight, -1e9)
        weight = np.exp(weight - weight.max(0)) * live.T
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.concatenate(((weight[:, :, None] * sf).sum(0), (weight[:, :, None] * sb).sum(0)), axis=1)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return logit, (vectors, places, lens, live, sf, sb, cf, cb, weight, pooled) if keep else None

    def score(self, block: Block) -> np.ndarray:
        """A probability for each row: the largest of its windows."""
        n, projected = len(block.first), self.project(block)
        logit = np.empty(n, np.float32)
        for group in (np.flatnonzero(block.length == WINDOW), np.flatnonzero(block.length < WINDOW)):
            for i in range(0, len(group), 8192):
                which = group[i : i + 8192]
                logit[which] = self.forward(block, projected, which)[0]
        best = np.maximum.reduceat(logit, block.row_at[:-1]) if n else logit
        return 1 / (1 + np.exp(-best.astype(np.float64)))

    # ---- backward ----

    def _back(self, name: str, cache, grad_states, vectors, places, lens, grads) -> np.ndarray:
        h = HIDDEN
        u, x_name = self.p["h" + name], "x" + name
        d_state = np.zeros_like(grad_states[0])
        parts = []
        for t, before, r, z, new, gh in reversed(cache):
            d_state = d_state + grad_states[t]
            live = (t < lens)[:, None]
            d = np.where(live, d_state, 0)
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * gh * r * (1 - r)
            d_x = np.concatenate((d_r, d_z, d_new), axis=1)
            d_g = np.concatenate((d_r, d_z, d_new * r), axis=1)
            parts.append((places[:, t], d_x))
            grads["h" + name] += before.T @ d_g
            grads["b" + name] += d_x.sum(0)
            d_state = np.where(live, d * z + d_g @ u.T, d_state)
        d_proj = add_rows(np.concatenate([p for p, _ in parts]), np.concatenate([d for _, d in parts]), len(vectors))
        grads[x_name] += vectors.T @ d_proj
        return d_proj @ self.p[x_name].T

    def gradients(self, block: Block, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients of a batch of rows (all windows of ``block``)."""
        logit, kept = self.forward(block, self.project(block), keep=True)
        vectors, places, lens, live, sf, sb, cf, cb, att, pooled = kept
        h, sharp, at = HIDDEN, 2.0, block.row_at[:-1]
        row = np.repeat(np.arange(len(label)), np.diff(block.row_at))
        top = np.maximum.reduceat(logit, at)
        e = np.exp(sharp * (logit - top[row]))
        total = np.add.reduceat(e, at)
        doc = top + np.log(total / np.diff(block.row_at)) / sharp
        p = 1 / (1 + np.exp(-doc))
        loss = float((weight * (np.logaddexp(0, doc) - label * doc)).sum())
        d_logit = ((weight * (p - label))[row] * e / total[row]).astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["bias"][0] = d_logit.sum()
        grads["out"] = pooled.T @ d_logit
        d_pool = d_logit[:, None] * self.p["out"]
        d_sf, d_sb = att[:, :, None] * d_pool[:, :h], att[:, :, None] * d_pool[:, h:]
        d_att = (sf * d_pool[:, :h]).sum(2) + (sb * d_pool[:, h:]).sum(2)
        d_att = att * (d_att - (att * d_att).sum(0))
        grads["att"] = np.concatenate(((d_att[:, :, None] * sf).sum((0, 1)), (d_att[:, :, None] * sb).sum((0, 1))))
        d_sf += d_att[:, :, None] * self.p["att"][:h]
        d_sb += d_att[:, :, None] * self.p["att"][h:]
        d_vec = self._back("f", cf, d_sf, vectors, places, lens, grads)
        d_vec = d_vec + self._back("b", cb, d_sb, vectors, places, lens, grads)
        if len(block.word):
            d_word = d_vec[:, :WORD_DIM] if self.dropped is None else d_vec[:, :WORD_DIM] * ~self.dropped[block.word][:, None]
            grads["word"] += add_rows(block.word, d_word, 1 << WORD_BITS)
            n = np.diff(block.gram_at)
            grads["gram"] += add_rows(block.gram, np.repeat(d_vec[:, WORD_DIM:] / np.sqrt(n)[:, None], n, axis=0), 1 << GRAM_BITS)
        return loss, grads

    def fit(self, batches: list[tuple[Block, np.ndarray]], weight_of: tuple[float, float], epochs: int, rate: float = 0.01) -> list[float]:
        """Adam over batches of rows; ``weight_of`` weighs the two classes."""
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step, losses, rng = 0, [], np.random.default_rng(11)
        for _ in range(epochs):
            total = 0.0
            for block, label in batches:
                weight = np.where(label > 0, weight_of[1], weight_of[0]) / len(label)
                self.dropped = rng.random(1 << WORD_BITS) < DROP
                loss, grads = self.gradients(block, label, weight)
                total += loss
                step += 1
                scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grads.items():
                    if k in ("word", "gram"):
                        rows = np.flatnonzero(g.any(axis=1))
                        m[k][rows] = 0.9 * m[k][rows] + 0.1 * g[rows]
                        v[k][rows] = 0.999 * v[k][rows] + 0.001 * g[rows] ** 2
                        self.p[k][rows] -= 0.3 * scale * m[k][rows] / (np.sqrt(v[k][rows]) + 1e-8)
                    else:
                        m[k] = 0.9 * m[k] + 0.1 * g
                        v[k] = 0.999 * v[k] + 0.001 * g * g
                        self.p[k] -= scale * m[k] / (np.sqrt(v[k]) + 1e-8)
            losses.append(total / max(1, len(batches)))
        self.dropped = None
        return losses
