"""Scores of whole texts under a pretrained PPM model and under smoothed word counts.

One pass over the documents counts words and five-byte strings of the training rows; both are
summed up by one shuffle over the whole corpus and written to the shared folder, as are all nodes
and contexts of the byte trie. Five-byte strings that only held-out rows have are counted 0 times,
so each string of the table gets its value by joins before a text is scored. Words and strings are
unbounded, so only words of at least one in ``2**HEAD_BITS`` of all tokens and strings of at least
one in ``2**GRAM_BITS`` of all training bytes go to every task (at most that many whatever the
corpus); all other (document, word or string, count) rows are joined with their counts or values by
a shuffle, in which none can be hot.

Results for special rows: a null text counts as empty, an empty text is its end token alone;
repeated rows are scored row by row and learned from once per row; a null id is scored and counts
as a training row; without training rows every byte is equally likely and the base score is 0;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm import ppm
from wearline.llm.common import SpanHashes, binary_array, blocks, crc_mod, gather_spans, land, table, text_bytes
from wearline.llm.words import ASCII_LOWER, distinct, word_spans

HEAD_BITS, GRAM_BITS = 20, 22
#: Five-byte strings a task counts in memory before it hands them on.
HELD_CODES = 1_500_000

_byte = np.arange(256)
# Fixed value of the contract: these bytes separate tokens.
IS_TOKEN = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
#: The end token's key; no token of a text is empty.
END_TOKEN = b""
#: Before the five bytes of a string, it makes a key that no token equals: tokens hold no tab.
GRAM_KEY = b"\t"


def _words(data: np.ndarray, offsets: np.ndarray):
    starts, ends, first_word = word_spans(data, offsets, IS_TOKEN)
    _, sample, back = distinct(SpanHashes(data).of(starts, ends))
    return starts, ends, first_word, sample, back


def corpus_counts(docs: DataFrame, held_out: Column) -> DataFrame:
    """word or gram, n: over the rows of ``docs`` that aren't held out, whose own grams count 0.

    The end token is the empty word.
    """

    def rows(word: pa.Array | None, code: np.ndarray | None, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        size = len(n)
        columns = [
            pa.nulls(size, pa.binary()) if word is None else word,
            pa.nulls(size, pa.int64()) if code is None else pa.array(code.astype(np.int64)),
            pa.array(n.astype(np.int64)),
        ]
        for i in range(0, size, 50_000):
            yield pa.RecordBatch.from_arrays([c.slice(i, 50_000) for c in columns], names=["word", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for block in blocks(batches):
            learns = block.column(1).to_numpy(zero_copy_only=False)
            for part in (block.filter(pa.array(learns)), block.filter(pa.array(~learns))):
                if not part.num_rows:
                    continue
                data, offsets = text_bytes(part.column(0))
                data = ASCII_LOWER[data]
                code, n = ppm.count_codes(ppm.codes(data, offsets)[0])
                if not part.column(1)[0].as_py():
                    held.append((code, np.zeros_like(n)))
                    continue
                held.append((code, n))
                starts, ends, _, sample, back = _words(data, offsets)
                yield from rows(binary_array(*gather_spans(data, starts[sample], ends[sample])), None, np.bincount(back, minlength=len(sample)))
                yield from rows(pa.array([END_TOKEN], pa.binary()), None, np.array([part.num_rows]))
            if sum(len(c) for c, _ in held) > HELD_CODES:
                held = [ppm.merge_counts(held)]
                if len(held[0][0]) > HELD_CODES // 2:
                    yield from rows(None, *held.pop())
        if held:
            yield from rows(None, *ppm.merge_counts(held))

    counted = docs.select("text", (~held_out).alias("learns")).mapInArrow(run, "word binary, gram bigint, n bigint")
    return land(counted.groupBy("word", "gram").agg(F.sum("n").alias("n")), "lm-counts")


def trie_tables(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes (depth, code, n) of the trie and all its contexts (depth, context, total, kinds, below).

    ``below`` sums up the counts that a context's children have under the context one byte shorter.
    """
    seen = grams.filter("n > 0")
    levels = [F.struct(F.lit(j).alias("depth"), F.col("gram").bitwiseAND(F.lit(256**j - 1)).alias("code")) for j in range(1, ppm.ORDER + 1)]
    shorter = seen.select("n", F.explode(F.array(*levels)).alias("node")).groupBy("node.depth", "node.code").agg(F.sum("n").alias("n"))
    longest = seen.select(F.lit(ppm.ORDER + 1).alias("depth"), F.col("gram").alias("code"), "n")
    nodes = land(shorter.unionByName(longest), "lm-nodes")
    parent = F.expr("code & (shiftleft(1L, 8 * (depth - 1)) - 1)")
    own = nodes.select((F.col("depth") - 1).alias("depth"), F.shiftright("code", 8).alias("context"), "n", parent.alias("code"))
    contexts = (
        own.join(nodes.withColumnRenamed("n", "n_below"), ["depth", "code"], "left")
        .groupBy("depth", "context")
        .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.coalesce(F.sum("n_below"), F.lit(0)).alias("below"))
    )
    return nodes, land(contexts, "lm-contexts")


def gram_values(grams: DataFrame) -> DataFrame:
    """gram, n, value: log10 of the probability of every string's last byte after its first four."""
    nodes, contexts = trie_tables(grams)

    def context(m: int) -> DataFrame:
        own = contexts.filter(F.col("depth") == m).drop("depth")
        return F.broadcast(own) if m <= 2 else own  # at most 256**m rows

    def node(j: int) -> DataFrame:
        own = nodes.filter(F.col("depth") == j).select("code", F.col("n").alias("own"))
        return F.broadcast(own) if j <= 2 else own  # at most 256**j rows

    def at(m: int) -> Column:
        return F.shiftright("gram", 8).bitwiseAND(F.lit(256**m - 1)).alias("context")

    known = grams.filter("n > 0").withColumn("context", at(ppm.ORDER)).join(context(ppm.ORDER), "context")
    known = known.select("gram", "n", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("value"))
    zero = F.lit(0).cast("long")
    # no string is in more than 256**(5 - j) of these distinct codes, so no key is hot
    rest = grams.filter("n = 0").select("gram", "n", F.lit(0.0).alias("value"), F.lit(True).alias("open"), zero.alias("gone"), zero.alias("gone_kinds"))
    for m in range(ppm.ORDER, -1, -1):
        rest = rest.withColumn("context", at(m)).join(context(m), "context", "left").drop("context")
        rest = rest.withColumn("code", F.col("gram").bitwiseAND(F.lit(256 ** (m + 1) - 1))).join(node(m + 1), "code", "left").drop("code")
        there, hit = F.col("open") & F.col("total").isNotNull(), F.col("own").isNotNull()
        kinds = F.col("kinds") - F.col("gone_kinds")
        weight = F.col("total") - F.col("gone") + kinds
        step = F.when(there & hit, F.log10(F.col("own") / weight)).when(there & (kinds > 0), F.log10(kinds / weight)).otherwise(0.0)
        rest = rest.select(
            "gram",
            "n",
            (F.col("value") + step).alias("value"),
            (F.col("open") & ~hit).alias("open"),
            F.when(there, F.col("below")).otherwise(F.col("gone")).alias("gone"),
            F.when(there, F.col("kinds")).otherwise(F.col("gone_kinds")).alias("gone_kinds"),
        )
    value = F.when(F.col("open"), F.col("value") - F.log10(256 - F.col("gone_kinds"))).otherwise(F.col("value"))
    return land(known.unionByName(rest.select("gram", "n", value.alias("value"))), "lm-values")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    held_out = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    counts = corpus_counts(docs, held_out)
    words = counts.filter("word IS NOT NULL").select("word", "n")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_train, vocabulary = size["n"], size["v"]
    base = float(n_train + 1 * (vocabulary + 1))
    is_head = F.col("n") * F.lit(2.0**HEAD_BITS) >= F.lit(n_train)
    # at most 2**HEAD_BITS rows
    head_table = words.filter(is_head).toArrow()
    head = dict(zip(head_table.column("word").to_pylist(), head_table.column("n").to_pylist(), strict=True))
    grams = gram_values(counts.filter("gram IS NOT NULL").select("gram", "n"))
    n_bytes = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_head_gram = (F.col("n") > 0) & (F.col("n") * F.lit(2.0**GRAM_BITS) >= F.lit(n_bytes))
    # at most 2**GRAM_BITS rows
    head_grams = grams.filter(is_head_gram).select("gram", "value").toArrow()
    values = ppm.Values(head_grams.column("gram").to_numpy().astype(np.uint64), head_grams.column("value").to_numpy())
    shared = spark.sparkContext.broadcast((values, head))

    def counted(id_type: pa.DataType, row: np.ndarray, word: pa.Array, times: np.ndarray | None, grams: np.ndarray | None) -> pa.RecordBatch:
        k = len(row)
        numbers = [pa.nulls(k, pa.int64()) if x is None else pa.array(x.astype(np.int64)) for x in (times, grams)]
        blank = [pa.nulls(k, t) for t in (id_type, pa.int64(), pa.int64(), pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(row), word, *numbers, *blank], names=_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, known = shared.value
        row_number = TaskContext.get().partitionId() << 40
        end_count = known.get(END_TOKEN, 0)
        end_term = np.log10((end_count + 1) / base)
        for block in blocks(batches):
            data, offsets = text_bytes(block.column(1))
            data = ASCII_LOWER[data]
            code, at = ppm.codes(data, offsets)
            value, there = values.get(code)
            score = np.add.reduceat(np.where(there, value, 0.0), at[:-1])
            starts, ends, first_word, sample, back = _words(data, offsets)
            raw = data.tobytes()
            c = np.fromiter(
                (known.get(raw[s:e], -1) for s, e in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)), np.int64, len(sample)
            )
            n, rows = block.num_rows, np.arange(block.num_rows) + row_number
            row_number += n
            row = np.repeat(np.arange(n), np.diff(first_word))
            place = c[back]
            term = np.where(place >= 0, np.log10((np.maximum(place, 0) + 1) / base), 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows),
                    # a key that no token equals: tokens hold no blank
                    pa.array([b" %d" % r for r in rows], pa.binary()),
                    pa.array(np.ones(n, np.int64)),
                    pa.nulls(n, pa.int64()),
                    block.column(0),
                    pa.array(np.diff(first_word) + 1),
                    pa.array(np.bincount(row, place >= 0, n).astype(np.int64) + (end_count > 0)),
                    pa.array(np.bincount(row, term, n) + end_term),
                    pa.array(score),
                ],
                names=_ROWS,
            )
            rare = np.flatnonzero(place < 0)
            pair, times = np.unique(row[rare] * len(sample) + back[rare], return_counts=True)
            of, word = pair // max(1, len(sample)), sample[pair % max(1, len(sample))]
            for i in range(0, len(pair), 50_000):
                w = word[i : i + 50_000]
                yield counted(block.column(0).type, rows[of[i : i + 50_000]], binary_array(*gather_spans(data, starts[w], ends[w])), times[i : i + 50_000], None)
            rare = np.flatnonzero(~there)
            kinds, which = np.unique(code[rare], return_inverse=True)
            row = np.repeat(np.arange(n), np.diff(at))[rare]
            pair, times = np.unique(row * len(kinds) + which, return_counts=True)
            of, kind = pair // max(1, len(kinds)), kinds[pair % max(1, len(kinds))]
            for i in range(0, len(pair), 50_000):
                keys = ppm.code_bytes(kind[i : i + 50_000], GRAM_KEY)
                yield counted(block.column(0).type, rows[of[i : i + 50_000]], keys, None, times[i : i + 50_000])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(
        run, f"row bigint, word binary, times bigint, grams bigint, doc_id {id_type}, n_tokens bigint, n_known bigint, base double, score double"
    )
    no_value, no_count = F.lit(None).cast("double").alias("value"), F.lit(None).cast("long").alias("c")
    gram_key = F.concat(F.lit(GRAM_KEY), F.unhex(F.lpad(F.hex("gram"), 2 * (ppm.ORDER + 1), "0"))).alias("word")
    tail = words.filter(~is_head).select("word", F.col("n").alias("c"), no_value)
    tail = tail.unionByName(grams.filter(~is_head_gram).select(gram_key, no_count, "value"))
    joined = rows.join(tail, "word", "left")
    term = F.when(F.col("n_tokens").isNull(), F.col("times") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(base)))
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_tokens").alias("n_tokens"),
            (F.max("n_known") + F.coalesce(F.sum(F.when(F.col("c").isNotNull(), F.col("times"))), F.lit(0))).alias("n_known"),
            F.round(F.max("base") + F.coalesce(F.sum(term), F.lit(0.0)), 6).alias("base_score"),
            F.round(F.max("score") + F.coalesce(F.sum(F.col("grams") * F.col("value")), F.lit(0.0)), 6).alias("score"),
        )
        .select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
    )


_ROWS = ["row", "word", "times", "grams", "doc_id", "n_tokens", "n_known", "base", "score"]


def op6_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``."""
    return score(table(spark, sf_dir, "documents"))


QUERIES = {"op6_ppm_score": op6_ppm_score}
ORACLE_SQL: dict[str, str] = {}
