"""How far the sources of each language lie apart in their use of words.

1. ``mapInArrow`` counts words with Arrow's own kernels: ``ascii_lower``, ``split_pattern_regex``,
   ``dictionary_encode`` and hash ``group_by`` give a task's counts for (lang, source, term), which
   are merged in the task, block after block, before anything is shuffled.
2. A language keeps the terms that stand in at least ``LEAST_DOCS`` of its documents.
3. The kept counts are dealt out in shards of whole terms. A shard is a small matrix of sources by
   terms; it adds up the differences of every two sources over its terms, and names the terms that
   a source uses more than its language does. Shards' sums and best terms are merged by Spark.

A source's share of a term is p = 1 + floor(SCALE * (count + 5) / (N + 5 V)), N the sum of the
source's counts of the V kept terms. Everything is done in integers.

Results for special rows: null text, lang and source count as empty, so rows without a language make
up a language of their own; a source without words, or without kept terms, still has its pairs; a
language of one source has no pairs, one without kept terms has pairs of value 0; repeated rows
count each time; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.llm.common import blocks, land, table

LEAST_DOCS, TOP = 30, 50
SCALE, PRIOR = 1_000_000_000, 5
#: What parts words: every ASCII character but letters.
NO_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Counts a task holds before it sends them on.
HELD = 400_000
#: Sources times terms of a shard, and its counts, at most (a term stays whole).
CELLS = 1_000_000
#: Above, the steps of the integer division would leave 64 bits.
_MOST_WORDS = 2**63 // 1000

_KEYS = ["lang", "source", "term"]
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


# ---- Arrow side --------------------------------------------------------------------------------


def block_counts(block: pa.RecordBatch) -> pa.Table:
    """lang, source, term, n, docs of the texts of a block; an empty term stands for each group."""
    text, lang, source = (pc.fill_null(block.column(i).cast(pa.string()), "") for i in range(3))
    names = pa.table({"lang": lang, "source": source, "row": pa.array(np.arange(len(text)))})
    groups = names.group_by(["lang", "source"], use_threads=False).aggregate([])
    groups = groups.append_column("group", pa.array(np.arange(groups.num_rows)))
    group_of = names.join(groups, ["lang", "source"], use_threads=False).sort_by("row").column("group").to_numpy()

    parts = pc.split_pattern_regex(pc.ascii_lower(text), pattern=NO_LETTER)
    words, row = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.greater(pc.binary_length(words), 0)
    words, row = words.filter(real).dictionary_encode(), row.filter(real)
    here = pa.table({"row": row, "code": words.indices})
    here = here.group_by(["row", "code"], use_threads=False).aggregate([([], "count_all")])
    here = here.set_column(0, "group", pa.array(group_of[here.column("row").to_numpy()]))
    here = here.group_by(["group", "code"], use_threads=False).aggregate([("count_all", "sum"), ("count_all", "count")])
    at = here.column("group").combine_chunks()
    found = pa.table(
        [
            pc.take(groups.column("lang").combine_chunks(), at),
            pc.take(groups.column("source").combine_chunks(), at),
            pc.take(words.dictionary, here.column("code").combine_chunks()),
            here.column("count_all_sum").cast(pa.int64()),
            here.column("count_all_count").cast(pa.int64()),
        ],
        schema=_COUNTS,
    )
    none = pa.array(np.zeros(groups.num_rows, np.int64))
    blank = pa.array([""] * groups.num_rows, pa.string())
    return pa.concat_tables([found, pa.table([groups.column("lang"), groups.column("source"), blank, none, none], schema=_COUNTS)])


def merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(_KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return t.rename_columns(["n" if c == "n_sum" else "docs" if c == "docs_sum" else c for c in t.column_names]).select(_COUNTS.names)


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts; what it holds is merged at every ``HELD`` rows and sent on if that frees too little."""
    held, size = [], 0
    for block in blocks(batches):
        held.append(block_counts(block))
        size += held[-1].num_rows
        if size > HELD:
            held = [merged(held)]
            size = held[0].num_rows
            if size > HELD // 2:
                yield from held[0].to_batches()
                held, size = [], 0
    if held:
        yield from merged(held).to_batches()


def share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / total) for count <= total, by long division in steps of 1000."""
    if total.size and int(total.max()) >= _MOST_WORDS:
        raise ValueError("a group has too many words for 64-bit shares")
    whole, rest = np.divmod(count, total)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digit
    return whole + 1


_SHARD_OUT = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def shard_divergences(top: int):
    """What one shard of terms adds: differences of every two sources, and each source's best terms."""

    def run(counts: pa.Table, groups: pa.Table) -> pa.Table:
        lang = groups.column("lang")[0].as_py()
        groups = groups.sort_by("source")
        sources = groups.column("source").combine_chunks()
        n, v, lang_n = (groups.column(c).to_numpy() for c in ("words", "kept", "lang_words"))
        words = counts.column("term").combine_chunks().dictionary_encode()
        code, terms = words.indices.to_numpy(zero_copy_only=False), words.dictionary
        matrix = np.zeros((len(sources), len(terms)), np.int64)
        matrix[pc.index_in(counts.column("source").combine_chunks(), sources).to_numpy(zero_copy_only=False), code] = counts.column("n").to_numpy()
        p = share(matrix + PRIOR, (n + PRIOR * v)[:, None]) if len(terms) else matrix
        out = []
        for i in range(len(sources)):
            apart = np.abs(p - p[i]).sum(axis=1)
            others = np.arange(len(sources)) != i
            out.append(("pair", i, sources.filter(pa.array(others)), apart[others]))
        if len(terms):
            q = share(matrix.sum(axis=0) + PRIOR, np.full(len(terms), lang_n[0] + PRIOR * v[0]))
            rank = pc.rank(terms, sort_keys="ascending", tiebreaker="first").to_numpy()
            for i in range(len(sources)):
                more = np.flatnonzero((matrix[i] > 0) & (p[i] > q))
                value = p[i, more] - q[more]
                best = np.lexsort((rank[more], -value))[:top]
                out.append(("term", i, terms.take(pa.array(more[best])), value[best]))
        return pa.concat_tables(
            [
                pa.table([pa.array([lang] * len(x), pa.string()), pa.array([sources[i].as_py()] * len(x), pa.string()), pa.array([part] * len(x)), x, pa.array(y)], schema=_SHARD_OUT)
                for part, i, x, y in out
            ]
        )

    return run


# ---- Spark side --------------------------------------------------------------------------------


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs over the whole table; a row with an empty term for every (lang, source)."""
    counts = docs.select("text", "lang", "source").mapInArrow(partial_counts, "lang string, source string, term string, n bigint, docs bigint")
    return counts.groupBy(*_KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: ``pair`` rows of every two sources of a language, and each source's ``top`` terms."""
    counts = land(term_counts(docs), "term-counts")
    real = counts.filter("term <> ''")
    kept_terms = real.groupBy("lang", "term").agg(F.sum("docs").alias("in_docs")).filter(F.col("in_docs") >= least_docs)
    kept = land(real.join(kept_terms.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n"), "kept-counts")

    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_words"), F.countDistinct("term").alias("kept"), F.count("*").alias("rows"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    sources = counts.filter("term = ''").select("lang", "source")
    groups = sources.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0)
    cells = F.greatest(F.col("rows"), F.col("kept") * F.count("*").over(Window.partitionBy("lang")))
    groups = land(groups.withColumn("shards", F.ceil(cells / F.lit(CELLS)).cast("int") + 1), "term-groups")

    dealt = kept.join(groups.select("lang", "source", "shards"), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "source", "term", "n"
    )
    everywhere = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    schema = "lang string, source string, part string, item string, value bigint"
    run = shard_divergences(top)
    parts = dealt.groupBy("lang", "shard").cogroup(everywhere.groupBy("lang", "shard")).applyInArrow(lambda a, b: run(a, b), schema)
    parts = land(parts, "divergences")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = parts.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    terms = parts.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms.select(*pairs.columns))


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of the sources of every language of ``documents``."""
    return audit(table(spark, sf_dir, "documents"))


QUERIES = {"op13_divergence_audit": op13_divergence_audit}

ORACLE_SQL = {
    "op13_divergence_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), tok AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM tok GROUP BY ALL HAVING count(DISTINCT rid) >= 30
), of_lang AS (
  SELECT l.lang, count(k.term) AS v, coalesce(sum(k.lang_n), 0)::BIGINT AS n
  FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept k ON l.lang = k.lang GROUP BY l.lang
), groups AS (SELECT DISTINCT lang, source FROM d
), counts AS (SELECT lang, source, term, count(*) AS n FROM tok GROUP BY ALL
), full_counts AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), of_group AS (
  SELECT lang, source, sum(n)::BIGINT AS n FROM full_counts GROUP BY ALL
), p AS (
  SELECT f.lang, f.source, f.term, f.n,
    1 + ((1000000000::HUGEINT * (f.n + 5)) // (g.n + 5 * l.v)::HUGEINT)::BIGINT AS p,
    1 + ((1000000000::HUGEINT * (f.lang_n + 5)) // (l.n + 5 * l.v)::HUGEINT)::BIGINT AS q
  FROM full_counts f JOIN of_group g ON g.lang = f.lang AND g.source = f.source JOIN of_lang l ON l.lang = f.lang
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), both_parts AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM both_parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
}
