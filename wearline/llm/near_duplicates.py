"""Near-duplicate classes: BagMinHash signatures, banding, exact multiset overlap, components.

1. One pass gives every row its text's digest and 24 band keys of four components. Equal texts
   are one text from here on. Two texts with a weighted Jaccard similarity of 0.8 share no band
   with a probability of (1 - 0.8**4)**24 = 3e-6.
2. Texts that share a band key form a bucket. First the bucket's smallest text is compared
   exactly with each other text of it, and the links found are joined to components; so a bucket
   of n copies takes n comparisons and not n squared. Buckets that still hold several components
   are then compared in whole: cut into blocks of about ``BLOCK_BYTES`` or
   ``BLOCK_TEXTS``, every pair of blocks is
   a tile of its own that one task takes, which compares all pairs of its texts by a product of
   matrices and hands on only the links that join components. No link is lost, no task holds
   more than two blocks, and no more rows leave a tile than texts enter it.
3. A class is a component of texts; its id is the smallest ``doc_id`` in it.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, in ASCII lower
case; a shingle is five words, or all words of a shorter text, and a text is the multiset of its
shingles.

Results for special rows: null counts as empty; texts without words are near duplicates of equal
texts only; repeated rows and repeated ids are rows of their own in one class if their texts are
alike; a class is named by null only if none of its rows has an id;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm import bagmin
from wearline.llm.common import blocks, discard, land, table, text_bytes
from wearline.llm.components import components

SIMILARITY = 0.8
#: Bytes of a bucket's texts, and texts, in one block of a tile, about.
BLOCK_BYTES, BLOCK_TEXTS = 500_000, 500


def digest_of(text):
    """Sixteen bytes that stand for a text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)), 1, 16)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, digest, bands for every row; no bands for texts without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            shingle, row, weight = bagmin.bags(*bagmin.shingles(*text_bytes(block.column(2))))
            keys = bagmin.band_keys(bagmin.signatures(shingle, row, weight, block.num_rows))
            some = np.bincount(row, minlength=block.num_rows) > 0
            ends = np.concatenate(([0], np.cumsum(np.where(some, keys.shape[1], 0)))).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].ravel()))
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), bands], names=["doc_id", "digest", "bands"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", digest_of(F.col("text")).alias("digest"), "text")
    return land(rows.mapInArrow(run, f"doc_id {id_type}, digest binary, bands array<bigint>"), "signatures")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least that similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(blocks(batches, "left"), "right"):
            j = bagmin.similarities(*text_bytes(block.column(2)), *text_bytes(block.column(3)))
            keep = pa.array(j >= similarity)
            yield pa.RecordBatch.from_arrays([block.column(0).filter(keep), block.column(1).filter(keep)], names=["a", "b"])

    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary")


def text_components(docs: DataFrame, rows: DataFrame, similarity: float = SIMILARITY, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """node, component over the digests that have a near duplicate of another text."""
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    placed = texts.select("digest", "doc_id", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    buckets = land(placed.join(shared, "band").select("band", "digest", "doc_id"), "buckets")
    # the texts of these buckets only, one row for each
    wanted = buckets.select("digest", "doc_id").distinct()
    have = docs.select(F.col("doc_id").alias("id"), digest_of(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    found = have.join(wanted, "digest").filter(F.col("id").eqNullSafe(F.col("doc_id"))).select("digest", "text")
    texts = land(found.dropDuplicates(["digest"]).withColumn("bytes", F.octet_length("text").cast("long")), "bucket-texts")

    members = buckets.select("band", "digest")
    leaders = members.groupBy("band").agg(F.min("digest").alias("a"))
    pairs = land(members.join(leaders, "band").filter("a <> digest").select("a", F.col("digest").alias("b")).distinct(), "pairs")
    links = land(verified(pairs, texts, similarity), "links")
    found = components(links)

    named = members.join(found.withColumnRenamed("node", "digest"), "digest", "left").join(texts.select("digest", "bytes"), "digest")
    named = land(named.select("band", "digest", "bytes", F.coalesce("component", "digest").alias("component")), "named")
    # a bucket of two unjoined texts has been compared already
    mixed = named.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.sum("bytes").alias("bytes"),
        F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("y"),
    )
    blocks_of = F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(block_bytes)), F.ceil(F.col("n") / F.lit(BLOCK_TEXTS))).cast("int")
    # near copies share several bands: the same texts are compared once
    mixed = mixed.filter("low <> high AND n > 2").groupBy("n", "bytes", "x", "y").agg(F.min("band").alias("band"))
    mixed = mixed.select("band", blocks_of.alias("blocks"))
    more = land(tiles(named.join(mixed, "band"), texts, similarity), "links")
    # the second graph is that of the first one's components
    joined = components(more).withColumnRenamed("component", "whole")
    discard(buckets, texts, pairs, links, named, more)
    done = found.join(joined, found["component"] == joined["node"], "left").select(found["node"], F.coalesce("whole", "component").alias("component"))
    alone = joined.join(found.select("node"), "node", "left_anti").select("node", F.col("whole").alias("component"))
    return done.unionByName(alone)


def tiles(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """a, b: components that a link joins, from every pair of blocks of each bucket.

    ``members`` has band, digest, component and the number of the bucket's blocks.
    """

    def run(t: pa.Table) -> pa.Table:
        component = t.column("component").to_pylist()
        number = {c: i for i, c in enumerate(sorted(set(component)))}
        group = np.array([number[c] for c in component])
        found = bagmin.linked(*text_bytes(t.column("text").combine_chunks()), group, similarity) if len(number) > 1 else []
        return pa.table(
            {"a": pa.array([component[i] for i, _ in found], pa.binary()), "b": pa.array([component[j] for _, j in found], pa.binary())}
        )

    own = F.pmod(F.hash("digest"), F.col("blocks"))
    placed = members.withColumn("own", own).select(
        "band", "digest", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    )
    placed = placed.select("band", "digest", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return placed.join(texts.select("digest", "text"), "digest").groupBy("band", "i", "j").applyInArrow(run, "a binary, b binary")


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    """digest, doc_id, component for every row; a text without near duplicates is its own."""
    rows = signed(docs)
    found = text_components(docs, rows, similarity).withColumnRenamed("node", "digest")
    return rows.select("doc_id", "digest").join(found, "digest", "left").withColumn("component", F.coalesce("component", "digest"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id for every row."""
    rows = land(_classes(docs, similarity), "classes")
    names = rows.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    return rows.join(names, "component").select("doc_id", "class_id")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class, that of its smallest id, every column kept."""
    rows = land(_classes(docs, similarity), "classes")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    stay = rows.groupBy("component").agg(F.min(order).alias("s")).select("s.doc_id", "s.digest")
    times = rows.groupBy(F.col("doc_id").alias("id"), F.col("digest").alias("own")).agg(F.count("*").alias("n"))
    stay = stay.join(times, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("own"))).select("id", "own", "n")
    # the caller's columns travel as one, so none clashes
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), digest_of(F.col("text")).alias("digest"))
    kept = whole.join(land(stay, "kept"), (F.col("digest") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("id")))
    single, repeated = kept.filter("n = 1"), kept.filter("n > 1").dropDuplicates(["digest"])
    return single.unionByName(repeated).select("row.*")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every row of ``documents``."""
    return classes(table(spark, sf_dir, "documents"))


def _sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    n = bagmin.SHINGLE
    return f"""
WITH RECURSIVE t AS (SELECT coalesce(text, '') AS text, min(doc_id) AS k FROM documents GROUP BY 1),
w AS (SELECT k, regexp_extract_all(translate(text, '{upper}', '{lower}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words FROM t),
s AS (
  SELECT k, array_to_string(words[i : i + {n - 1}], ' ') AS shingle, count(*) AS n
  FROM (SELECT k, words, unnest(range(1, greatest(1, len(words) - {n - 1}) + 1)) AS i FROM w WHERE len(words) > 0) GROUP BY ALL),
total AS (SELECT k, sum(n) AS n FROM s GROUP BY k),
pairs AS (
  SELECT a.k AS a, b.k AS b, sum(least(a.n, b.n)) AS shared FROM s a JOIN s b USING (shingle) WHERE a.k < b.k GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN total x ON x.k = a JOIN total y ON y.k = b WHERE shared >= {SIMILARITY} * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT k, k AS c FROM t UNION SELECT reach.k, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.c),
named AS (SELECT k, min(c) AS class_id FROM reach GROUP BY k)
SELECT doc_id, class_id FROM documents JOIN t ON t.text = coalesce(documents.text, '') JOIN named USING (k)"""


QUERIES = {"op2_near_duplicates": op2_near_duplicates}
ORACLE_SQL = {"op2_near_duplicates": _sql()}
