"""The corpus pipeline: ``documents`` to packed training sequences in five stages.

Each stage reads, from Parquet in the shared folder, what the one before it kept:

1. toxicity: documents that score at least the threshold go;
2. near_duplicates: one document of each class stays, that of the smallest id;
3. repeats: byte strings of 400 bytes and passages of over 50 words that also stand elsewhere go,
   the documents stay;
4. decontaminate: documents that leak a benchmark item go;
5. packing: what is left, as pieces of sequences of 1024 tokens.

All but the last return the columns they are given (texts that were cut have ``n_chars`` counted
anew). An empty table gives an empty table at every stage; see the operators for other cases.
There is no SQL for the network's scores, so ``ORACLE_SQL`` is None and tests hold each stage
against a brute-force version on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wearline.llm import decontaminate, near_duplicates, packing, repeats, toxicity
from wearline.llm.common import land, ship, table

#: Repeated passages of more words go; one more word of a single byte each, with blanks, makes the bytes.
PASSAGE_WORDS = 50
PASSAGE_BYTES, PASSAGE_GRAM = 2 * PASSAGE_WORDS + 1, 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_duplicates.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return repeats.remove(docs, PASSAGE_BYTES, PASSAGE_GRAM, words=PASSAGE_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontaminate", drop_leaks),
    ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = land(docs, f"stage-{name}")
    return docs
