"""Toxicity of whole texts by a bidirectional recurrent network (see ``gru.py``).

The network is fitted on a bounded sample of labelled documents: at most ``SAMPLE[c]`` of each
class, taken in the order of a hash of the id, among texts of at most ``SAMPLE_BYTES`` bytes.
Every document is then scored over all of its overlapping windows; its score is the largest.

Results for special rows: a null or empty text, or one without words, is scored as one window
without words; repeated rows are scored alike, row by row; a null id is scored and counts as not
held out; a label that is null marks nothing, several labels of one id count as their largest, and
of several texts of an id the smallest is learned from;
without labels of both classes every score is the share of label 1 (0 without any label).
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.llm.common import blocks, crc_mod, land, no_key_clash, table, text_bytes
from wearline.llm.gru import BiGRU, read_block

#: Labelled documents of label 0 and 1 that the network learns from, at most.
SAMPLE = (3000, 1000)
SAMPLE_BYTES = 32_768
BATCH, EPOCHS, LEAST_STEPS = 64, 2, 120
THRESHOLD = 0.3
#: Weight of the positive class, against its share in the sample.
POSITIVE_WEIGHT = 0.35
SCORE = "toxicity_score"


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """order, doc_id, text, toxic of the sample; rows of the held-out fold are never read."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod("doc_id", 4) != 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("order", F.xxhash64("doc_id"))
    )
    # each task hands on the first of its rows only
    first = [known.filter(F.col("toxic") == c).orderBy("order", "doc_id").limit(n) for c, n in enumerate(SAMPLE)]
    chosen = first[0].unionByName(first[1])
    # at most sum(SAMPLE) ids are broadcast; of several texts of an id the smallest counts
    rows = docs.select("doc_id", "text").filter(F.octet_length("text") <= SAMPLE_BYTES).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("order", "doc_id", "toxic").agg(F.min("text").alias("text")).select("order", "doc_id", "text", "toxic")


def learned(texts: list[str], label: np.ndarray) -> BiGRU | float:
    """The network fitted on these texts, or the share of label 1 where a class is missing."""
    if len(set(label.tolist())) < 2:
        return float(label.mean()) if len(label) else 0.0
    as_block = lambda t: read_block(*text_bytes(pa.array(t, pa.string())))
    model = BiGRU()
    batches = [(as_block(texts[i : i + BATCH]), label[i : i + BATCH]) for i in range(0, len(texts), BATCH)]
    model.start_from(batches)
    weight = POSITIVE_WEIGHT * (label == 0).sum() / (label == 1).sum()
    model.fit(batches, (1.0, float(weight)), max(EPOCHS, -(-LEAST_STEPS // len(batches))))
    return model


def fit(docs: DataFrame, labels: DataFrame) -> BiGRU | float:
    """The fitted network, or the share of label 1 where the sample lacks a class.

    One task reads the sample (at most ``sum(SAMPLE)`` texts of ``SAMPLE_BYTES``) and fits; the
    driver gets the parameters (8 MB), to broadcast them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)]
        rows.sort(key=lambda r: (r[0], r[1]))
        model = learned([r[2] for r in rows], np.array([r[3] for r in rows], float))
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(pickle.dumps(model), 1)], pa.binary())], names=["model"])

    sample = land(training_sample(docs, labels), "toxicity-sample")
    packed = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(zlib.decompress(packed["model"])) if packed else 0.0


def with_score(docs: DataFrame, model: BiGRU | float, name: str = SCORE) -> DataFrame:
    """``docs`` and a column of scores; a column of that name is replaced."""
    docs = no_key_clash(docs, name)
    if isinstance(model, float):
        return docs.withColumn(name, F.lit(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text_at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            scores = np.round(shared.value.score(read_block(*text_bytes(block.column(text_at)))), 6)
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array(scores, pa.float64())], names=[*block.schema.names, name])

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        F.col(SCORE).alias("score"),
        (F.col(SCORE) >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``, every column kept."""
    name = SCORE
    while name in docs.columns:
        name += "_"
    return with_score(docs, fit(docs, labels), name).filter(F.col(name) < threshold).select(*docs.columns)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE_SQL: dict[str, str] = {}
