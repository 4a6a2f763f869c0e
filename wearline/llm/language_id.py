"""Language identification by error-correcting output codes.

Each language has a codeword; for each bit a logistic classifier over hashed byte n-grams tells
the languages with a 1 from those with a 0. A text is decoded to the codeword with the smallest
sum of logistic losses over the bits' margins, so one wrong bit is outvoted; a small lead over
the second codeword is flagged as ambiguous.

The classifiers are fitted on a bounded sample: at most ``PER_LANGUAGE`` labelled documents of
each language, in the order of a hash of the id. Every document is scored over its whole text.

Results for special rows: null text, or text without a letter, is ``und`` with score 0; without
any labelled document everything is ``und``; one learned language is predicted everywhere with
score 1; repeated rows are judged row by row; a null id is judged and counts as not held out;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import blocks, crc_mod, table, text_bytes
from wearline.llm.words import ASCII_LOWER, IS_ASCII_LETTER, IS_WORD

PER_LANGUAGE = 600
ORDERS = (1, 2, 3)
BITS = 13
#: Lead of the best codeword, as a share of probability, under which a text is ambiguous.
LEAD = 0.2
UNDETERMINED = "und"

_LETTERS = np.where(IS_WORD & ~((np.arange(256) >= 48) & (np.arange(256) <= 57)), ASCII_LOWER, 32).astype(np.uint8)


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """One row of bits for each class: all splits up to five classes, else spread random codes."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 5:
        splits = [[(s >> i) & 1 for i in range(n)] for s in range(1, 2 ** (n - 1))]
        return np.array(splits, np.int8).T
    length = int(np.ceil(8 * np.log2(n)))
    rng = np.random.default_rng(seed)
    tries = [rng.integers(0, 2, (n, length), np.int8) for _ in range(50)]
    apart = lambda c: min((c[i] != c[j]).sum() for i in range(n) for j in range(i))
    both = lambda c: (c.min(0) == 0).all() and (c.max(0) == 1).all()
    return max(tries, key=lambda c: (both(c), apart(c)))


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the hashed n-gram that begins at every byte; 2**BITS where a row ends before."""
    letters = _LETTERS[data].astype(np.uint32)
    n = len(letters)
    for order in ORDERS:
        code = np.full(n, order, np.uint32)
        for i in range(order):
            code[: n - i] = code[: n - i] * np.uint32(0x01000193) ^ letters[i:]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        for back in range(1, order):
            at = offsets[1:] - back
            code[at[at >= offsets[:-1]]] = 1 << BITS
        yield code


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), np.float64)
    full = offsets[1:] > offsets[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full], axis=0, dtype=np.float64)
    return out


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits, 0 or 1
    weights: np.ndarray | None = None  # one row for each hashed n-gram, and one of zeros
    bias: np.ndarray | None = None

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows x bits; the mean weight of the n-grams of each order, added up."""
        total = np.zeros((len(offsets) - 1, self.code.shape[1]))
        for order, code in zip(ORDERS, gram_codes(data, offsets), strict=True):
            count = np.maximum(1, np.diff(offsets) - order + 1)
            total += _per_row(self.weights[code], offsets) / count[:, None]
        return total + self.bias

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest codeword, its probability, and whether the lead is small."""
        sign = self.code * 2.0 - 1
        loss = np.logaddexp(0, -margins[:, None, :] * sign[None]).sum(2)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        top = np.sort(p, axis=1)[:, ::-1]
        return best, top[:, 0], top[:, 0] - top[:, 1] < LEAD if p.shape[1] > 1 else np.zeros(len(p), bool)


def training_sample(docs: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Language, hashed n-grams and their frequencies of each sampled document, in a fixed order."""
    known = docs.select("doc_id", "lang").filter(F.col("lang").isNotNull() & (crc_mod("doc_id", 3) != 1)).distinct()
    ranked = known.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
    chosen = ranked.filter(F.col("n") <= PER_LANGUAGE).select("doc_id", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = text_bytes(block.column(2))
            keys, shares = [[] for _ in range(block.num_rows)], [[] for _ in range(block.num_rows)]
            for order, code in zip(ORDERS, gram_codes(data, offsets), strict=True):
                for r in range(block.num_rows):
                    own = code[offsets[r] : offsets[r + 1]]
                    count = np.bincount(own, minlength=(1 << BITS) + 1)[: 1 << BITS]
                    held = np.flatnonzero(count)
                    keys[r].append(held)
                    shares[r].append(count[held] / max(1, len(own) - order + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    block.column(1),
                    pa.array([np.concatenate(k) for k in keys], pa.list_(pa.int32())),
                    pa.array([np.concatenate(s).astype(np.float32) for s in shares], pa.list_(pa.float32())),
                ],
                names=["doc_id", "lang", "keys", "shares"],
            )

    # at most PER_LANGUAGE ids of each language are broadcast
    sampled = docs.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    # of several texts of an id the smallest is learned from
    sampled = sampled.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = sampled.mapInArrow(run, f"doc_id {id_type}, lang string, keys array<int>, shares array<float>").toArrow().to_pydict()
    order = sorted(range(len(rows["doc_id"])), key=lambda i: (rows["lang"][i], rows["doc_id"][i]))
    return [(rows["lang"][i], np.array(rows["keys"][i], np.int64), np.array(rows["shares"][i], np.float32)) for i in order]


def fit(docs: DataFrame, epochs: int = 12, batch: int = 128, rate: float = 0.02) -> Model:
    sample = training_sample(docs)
    languages = sorted({s[0] for s in sample})
    model = Model(languages, codewords(len(languages)))
    if len(languages) < 2:
        return model
    size, n = 1 << BITS, len(sample)
    target = model.code[[languages.index(s[0]) for s in sample]].astype(np.float32)
    weight = 1 / np.bincount([languages.index(s[0]) for s in sample])[[languages.index(s[0]) for s in sample]]
    weight = (weight * n / len(languages)).astype(np.float32)
    mean, square = np.zeros(size), np.zeros(size)
    for _, keys, shares in sample:
        np.add.at(mean, keys, shares)
        np.add.at(square, keys, shares.astype(np.float64) ** 2)
    mean /= n
    scale = 1 / (np.sqrt(np.maximum(0, square / n - mean**2)) + 1e-4)
    bits = model.code.shape[1]
    w, b = np.zeros((size, bits), np.float32), np.zeros(bits, np.float32)
    m, v, mb, vb, step, rng = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b), 0, np.random.default_rng(5)
    for _ in range(epochs):
        order = rng.permutation(n)
        for i in range(0, n, batch):
            rows = order[i : i + batch]
            x = np.zeros((len(rows), size), np.float32)
            for j, r in enumerate(rows):
                np.add.at(x[j], sample[r][1], sample[r][2])
            x = ((x - mean) * scale).astype(np.float32) / np.float32(np.sqrt(size))
            p = 1 / (1 + np.exp(-(x @ w + b)))
            d = (p - target[rows]) * weight[rows][:, None] / len(rows)
            step += 1
            k = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            gw, gb = x.T @ d + 1e-4 * w, d.sum(0)
            m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
            w -= (k * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
            b -= (k * mb / (np.sqrt(vb) + 1e-8)).astype(np.float32)
    # back to plain shares of n-grams
    plain = w * (scale / np.sqrt(size))[:, None]
    model.weights = np.vstack((plain, np.zeros((1, bits)))).astype(np.float32)
    model.bias = b - (mean[:, None] * plain).sum(0)
    return model


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    out = _per_row(IS_ASCII_LETTER[data].astype(np.int64), offsets) > 0
    for r in np.flatnonzero(~out):
        out[r] = any(c.isalpha() for c in data[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8"))
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNDETERMINED], object)
        for block in blocks(batches):
            data, offsets = text_bytes(block.column(1))
            n = block.num_rows
            best, score, vague = np.zeros(n, int), np.ones(n), np.zeros(n, bool)
            if len(m.languages) > 1:
                best, score, vague = m.decode(m.margins(data, offsets))
            known = has_letter(data, offsets) if m.languages else np.zeros(n, bool)
            best, score, vague = np.where(known, best, len(m.languages)), np.where(known, score, 0.0), np.where(known, vague, True)
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(names[best], pa.string()), pa.array(np.round(score, 6), pa.float64()), pa.array(vague)],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    return predict(docs, fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


QUERIES = {"op5_language_id": op5_language_id}
ORACLE_SQL: dict[str, str] = {}
