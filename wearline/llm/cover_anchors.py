"""Removal of word sequences that also stand elsewhere, found through a difference cover.

A word goes if a window of ``WORDS`` consecutive words that covers it also starts anywhere else.

1. Anchors. Strings of ``WORDS - PERIOD + 1`` words are hashed only where the word's place modulo
   ``PERIOD`` is in ``COVER``. ``COVER`` is a difference cover: for any two places there is a step
   of less than ``PERIOD`` that takes both of them into it, so any two equal windows share an
   anchor at the same step, at 5 hashed places in 21.
2. Anchors meet by hash. One that stands nowhere else proves nothing repeated and is dropped. Each
   carries a second hash of its context, the words of all windows that could hold it: two anchors
   of the same context prove all their windows repeated.
3. Extension. Where an anchor stands in differing contexts, one anchor of each context is
   extended: its windows are hashed and counted, which tells how far each match reaches.
4. The texts meet what was found by a 128-bit hash of the whole text. A text that stands more
   than once loses every window.

Words, anchors and windows are compared by hashes: 64 bits for an anchor and 64 independent ones for
its context, 128 for a window. Keys that hold more than 1 in 65,536 rows are looked up by a
broadcast table (so at most 65,536 rows of facts), all others by shuffles (``looked_up``).

Results for special rows: null or blank texts have no words; texts under ``WORDS`` words lose nothing
of their own; each repeated row of a text loses its windows; a null id is kept; extra columns are
ignored by ``spans`` and kept by ``remove``; a window may overlap its own repetition; an empty
table gives no rows. A very long text is hashed in pieces, of which only the word hashes stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.llm.common import SpanHashes, blocks, discard, hot_bar, land, looked_up, mix64, runs_of, table, text_bytes
from wearline.llm.words import word_spans

WORDS = 35
#: A difference cover: every step from 0 to 20 is the difference of two of these, modulo 21.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
#: A longer text is hashed in pieces.
PIECE_BYTES = 4_000_000
_byte = np.arange(256)
_IN_WORD = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))
_OTHER_BYTES = mix64(np.arange(1_001, 1_257, dtype=np.uint64))
_KEYS = ["d1", "d2"]
# what a mark of a text says about windows
_ALL, _ASK, _FOUND, _COPY = 0, 1, 2, 3


def is_cover(period: int, places: Sequence[int]) -> bool:
    return {(a - b) % period for a in places for b in places} == set(range(period))


# ---- numpy side --------------------------------------------------------------------------------


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every word of one text, which is read in pieces that end at a blank."""
    one, two, start = [], [], 0
    while start < len(data):
        stop = min(len(data), start + PIECE_BYTES)
        if stop < len(data):
            blank = np.flatnonzero(~_IN_WORD[data[start:stop]])
            while not len(blank) and stop < len(data):
                tail = data[stop : stop + PIECE_BYTES]
                blank = np.flatnonzero(~_IN_WORD[tail]) + (stop - start)
                stop = min(len(data), stop + PIECE_BYTES)
            if len(blank) and stop < len(data):
                stop = start + int(blank[-1]) + 1
        piece = data[start:stop]
        starts, ends, _ = word_spans(piece, np.array([0, len(piece)]), _IN_WORD)
        one.append(SpanHashes(piece).of(starts, ends))
        two.append(SpanHashes(piece, _OTHER_BYTES).of(starts, ends))
        start = stop
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(one), np.concatenate(two)) if one else (empty, empty)


def block_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word hashes of a block of texts and the first word of each row (one more at the end)."""
    if len(data) <= PIECE_BYTES:
        starts, ends, first = word_spans(data, offsets, _IN_WORD)
        return SpanHashes(data).of(starts, ends), SpanHashes(data, _OTHER_BYTES).of(starts, ends), first
    rows = [word_hashes(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    first = np.concatenate(([0], np.cumsum([len(x) for x, _ in rows])))
    return np.concatenate([x for x, _ in rows]), np.concatenate([y for _, y in rows]), first


def sequence_hashes(words: np.ndarray) -> SpanHashes:
    return SpanHashes(np.arange(len(words)), words)


def anchors(one: np.ndarray, two: np.ndarray, first: np.ndarray, words: int, period: int, cover: Sequence[int]) -> dict[str, np.ndarray]:
    """row, place, h (anchor) and g (context) of the cover's places; places count words of the row."""
    width = words - period + 1
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(one)) - first[:-1][row]
    residue = np.zeros(period, bool)
    residue[list(cover)] = True
    pick = np.flatnonzero(residue[place % period])
    row, place = row[pick], place[pick]
    low = np.maximum(place - (period - 1), 0)
    high = np.minimum(place + words, count[row])
    # a window that holds the anchor fits into the row
    fits = (place + width <= count[row]) & (high - low >= words)
    row, place, low, high = row[fits], place[fits], low[fits], high[fits]
    base = first[:-1][row]
    h = sequence_hashes(one).of(base + place, base + place + width)
    g = mix64(sequence_hashes(two).of(base + low, base + high) + (place - low).astype(np.uint64))
    return {"row": row, "place": place, "h": h.view(np.int64), "g": g.view(np.int64)}


def windows_of(place: np.ndarray, count: int, words: int, period: int) -> np.ndarray:
    """The places where windows start that hold an anchor at one of ``place``."""
    start = (place[:, None] - np.arange(period)[None, :]).ravel()
    return np.unique(start[(start >= 0) & (start + words <= count)])


def covered_words(count: int, starts: np.ndarray, words: int) -> np.ndarray:
    edge = np.zeros(count + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + words, -1)
    return np.cumsum(edge[:count]) > 0


# ---- Spark side --------------------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"d1": F.xxhash64(text), "d2": F.xxhash64(F.lit(1), text)})


def _anchor_rows(texts: DataFrame, words: int, period: int, cover: Sequence[int]) -> DataFrame:
    """h, g, d1, d2, p: the anchors of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            found = anchors(*block_words(*text_bytes(block.column(0))), words, period, cover)
            row = found["row"]
            d1, d2 = (block.column(i).to_numpy()[row] for i in (1, 2))
            for a in range(0, len(row), 200_000):
                at = slice(a, a + 200_000)
                yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (found["h"], found["g"], d1, d2, found["place"])], names=["h", "g", "d1", "d2", "p"])

    return texts.select("text", "d1", "d2").mapInArrow(run, "h bigint, g bigint, d1 bigint, d2 bigint, p bigint")


def _marks(texts: DataFrame, words: int, period: int, cover: Sequence[int]) -> DataFrame:
    """d1, d2, p, kind: anchors whose windows are all repeated (``_ALL``), and those to extend (``_ASK``)."""
    rows = land(_anchor_rows(texts, words, period, cover), "cover-anchors")
    bar = hot_bar(rows.count())
    again = rows.groupBy("h").agg(F.count("*").alias("n"), F.min("g").alias("low"), F.max("g").alias("high")).filter("n > 1")
    again = land(again.select("h", "n", (F.col("low") != F.col("high")).alias("mixed")), "cover-again")
    met = land(looked_up(rows, again, ["h"], "n", bar).drop("n"), "cover-met")
    discard(rows, again)
    kinds = met.filter("mixed").groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct(*_KEYS, "p")).alias("one"))
    kinds = land(kinds, "cover-kinds")
    same = looked_up(met.filter("mixed"), kinds.filter("n > 1").select("h", "g", "n"), ["h", "g"], "n", bar)
    sure = met.filter("NOT mixed").unionByName(same.drop("n")).select(*_KEYS, "p", F.lit(_ALL).alias("kind"))
    return sure.unionByName(kinds.select("one.*", F.lit(_ASK).alias("kind")))


def _lists(marks: DataFrame) -> DataFrame:
    """d1, d2, marks: a text's marks, packed as 4 * place + kind."""
    return marks.groupBy(*_KEYS).agg(F.collect_set(F.col("p") * 4 + F.col("kind")).alias("marks"))


def _places(marks: list[int] | None, kind: int) -> np.ndarray:
    m = np.array(marks or (), np.int64)
    return m[(m & 3) == kind] >> 2


def _extended(texts: DataFrame, asked: DataFrame, words: int, period: int) -> DataFrame:
    """d1, d2, p, kind: windows (``_FOUND``) around the asked anchors that stand elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            one, two, first = block_words(*text_bytes(block.column(0)))
            a, b = sequence_hashes(one), sequence_hashes(two)
            marks = block.column(3).to_pylist()
            starts = [windows_of(_places(m, _ASK), int(first[r + 1] - first[r]), words, period) for r, m in enumerate(marks)]
            row = np.repeat(np.arange(len(starts)), [len(s) for s in starts])
            place = np.concatenate(starts)
            at = place + first[:-1][row]
            d1, d2 = (block.column(i).to_numpy()[row] for i in (1, 2))
            out = (a.of(at, at + words).view(np.int64), b.of(at, at + words).view(np.int64), d1, d2, place)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["w1", "w2", "d1", "d2", "p"])

    schema = "w1 bigint, w2 bigint, d1 bigint, d2 bigint, p bigint"
    windows = land(texts.join(_lists(asked), _KEYS).select("text", *_KEYS, "marks").mapInArrow(run, schema), "cover-windows")
    place = F.struct(*_KEYS, "p")
    met = windows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(place).alias("a"), F.max(place).alias("b"))
    met = land(met.filter("a <> b").select("w1", "w2", "n"), "cover-repeated")
    found = looked_up(windows, met, ["w1", "w2"], "n", hot_bar(windows.count()))
    return found.select(*_KEYS, "p", F.lit(_FOUND).alias("kind"))


_DONE = "n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, rest string, removed array<string>"


def finish(text: bytes, starts: np.ndarray, words: int) -> tuple[int, int, int, str, bytes, list[bytes]]:
    """Words, removed words and runs, digest of the kept words, the text without the runs, the runs.

    The text loses the bytes from a run's first word to its last; all others stay as they are.
    """
    found = text.split()
    n = len(found)
    if not len(starts):
        return n, 0, 0, hashlib.sha256(b" ".join(found)).hexdigest(), text, []
    mask = covered_words(n, starts, words)
    kept = b" ".join([w for w, m in zip(found, mask.tolist(), strict=True) if not m])
    begin, end, _ = word_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]), _IN_WORD)
    a, b = runs_of(mask)
    cuts = list(zip(begin[a].tolist(), end[b - 1].tolist(), strict=True))
    ends = [0, *[y for _, y in cuts]]
    rest = b"".join(text[x:y] for x, y in zip(ends, [*[x for x, _ in cuts], len(text)], strict=True))
    return n, int(mask.sum()), len(cuts), hashlib.sha256(kept).hexdigest(), rest, [text[x:y] for x, y in cuts]


def _finished(docs: DataFrame, names: list[str], words: int, period: int) -> DataFrame:
    """``docs`` (its columns ``names``, then ``marks``) with the columns of ``finish``."""
    out_schema = T.StructType([*[docs.schema[c] for c in names], *T.StructType.fromDDL(_DONE).fields])
    text_at, n_own = names.index("text"), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = text_bytes(block.column(text_at))
            raw, marks, rows = data.tobytes(), block.column(n_own), []
            for r in range(block.num_rows):
                text, own = raw[offsets[r] : offsets[r + 1]], marks[r].as_py()
                if not own:
                    rows.append(finish(text, np.zeros(0, np.int64), words))
                    continue
                n = len(text.split())
                if any(m & 3 == _COPY for m in own):
                    starts = np.arange(max(0, n - words + 1))
                else:
                    starts = np.union1d(windows_of(_places(own, _ALL), n, words, period), _places(own, _FOUND))
                rows.append(finish(text, starts, words))
            done = [
                *[pa.array([x[i] for x in rows], pa.int64()) for i in range(3)],
                pa.array([x[3] for x in rows], pa.string()),
                pa.array([x[4].decode("utf-8", "replace") for x in rows], pa.string()),
                pa.array([[w.decode("utf-8", "replace") for w in x[5]] for x in rows], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*block.columns[:n_own], *done], names=out_schema.names)

    return docs.select(*names, "marks").mapInArrow(run, out_schema)


def resolved(docs: DataFrame, words: int = WORDS, period: int = PERIOD, cover: Sequence[int] = COVER) -> DataFrame:
    """``docs`` with n_words, n_removed, n_spans, kept_sha256, rest (the text without the repeated
    runs) and removed (the runs). ``period`` must not be more than ``words``."""
    if not is_cover(period, cover) or period > words:
        raise ValueError(f"{cover} does not cover the steps modulo {period}, or the period is above {words}")
    own = docs.columns
    # the caller's columns get names of their own, so none clashes
    docs = docs.select(*[F.col(c).alias("text" if c == "text" else f"own_{i}") for i, c in enumerate(own)])
    names, docs = docs.columns, _keyed(docs)
    copies = land(docs.groupBy(*_KEYS).agg(F.count("*").alias("n")).filter("n > 1"), "cover-copies")
    often = F.broadcast(copies.filter(F.col("n") > hot_bar(docs.count())).select(*_KEYS))
    usual, many = docs.join(often, _KEYS, "left_anti"), docs.join(often, _KEYS, "left_semi")
    # every other text, and one row of those that fill many rows
    texts = usual.select("text", *_KEYS).unionByName(many.select("text", *_KEYS).dropDuplicates(_KEYS))
    marks = land(_marks(texts, words, period, cover), "cover-marks")
    found = _extended(texts, marks.filter(F.col("kind") == _ASK), words, period)
    copied = copies.select(*_KEYS, F.lit(0).cast("bigint").alias("p"), F.lit(_COPY).alias("kind"))
    lists = _lists(marks.filter(F.col("kind") == _ALL).unionByName(found).unionByName(copied))
    done = _finished(usual.join(lists, _KEYS, "left"), names, words, period).unionByName(
        _finished(many.withColumn("marks", F.array(F.lit(_COPY).cast("bigint"))), names, words, period)
    )
    added = [f.name for f in T.StructType.fromDDL(_DONE).fields]
    clean = [a for a in added if a not in own]
    return done.select(*[F.col(n).alias(c) for n, c in zip(names, own, strict=True)], *clean)


def remove(docs: DataFrame, words: int = WORDS, period: int = PERIOD, cover: Sequence[int] = COVER) -> DataFrame:
    """``docs`` with the repeated runs taken out of ``text``, every column kept."""
    others = [c for c in docs.columns if c != "text"]
    rest = resolved(docs.select(F.struct(*others).alias("row"), "text"), words, period, cover) if others else resolved(docs, words, period, cover)
    return rest.select(*[F.col("rest").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def spans(docs: DataFrame, words: int = WORDS, period: int = PERIOD, cover: Sequence[int] = COVER) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept_sha256, text (the rest) and removed for every row."""
    out = resolved(docs.select("doc_id", "text"), words, period, cover)
    return out.select("doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", F.col("rest").alias("text"), "removed")


def op11_cover_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every whole text of ``documents`` loses, and what is left of it."""
    return spans(table(spark, sf_dir, "documents")).drop("removed")


QUERIES = {"op11_cover_anchors": op11_cover_anchors}

ORACLE_SQL = {
    "op11_cover_anchors": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
), s AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, regexp_extract_all(text, '[\x20\x09-\x0D]+') AS gaps,
    CASE WHEN regexp_matches(text, '^[\x20\x09-\x0D]') THEN 1 ELSE 0 END AS lead FROM d
), starts AS (
  SELECT rid, i, array_to_string(w[i:i+34], ' ') AS win FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM s WHERE len(w) >= 35)
), again AS (
  SELECT win FROM starts GROUP BY win HAVING count(*) > 1
), hits AS (
  SELECT rid, i FROM starts WHERE win IN (SELECT win FROM again)
), tok AS (
  SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word, w, gaps, lead FROM s
), cov AS (
  SELECT t.rid, t.i, t.word, coalesce(t.gaps[t.i + t.lead], '') AS gap,
    coalesce(max(CASE WHEN h.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY t.rid ORDER BY t.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM tok t LEFT JOIN hits h ON h.rid = t.rid AND h.i = t.i
), sides AS (
  SELECT *, coalesce(lead(gone) OVER (PARTITION BY rid ORDER BY i), false) AS gone_next, coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), false) AS gone_before FROM cov
), sums AS (
  SELECT rid, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE gone AND NOT gone_before) AS n_spans,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept,
    string_agg((CASE WHEN gone THEN '' ELSE word END) || (CASE WHEN gone AND gone_next THEN '' ELSE gap END), '' ORDER BY i) AS rest
  FROM sides GROUP BY rid
)
SELECT s.doc_id, len(s.w) AS n_words, coalesce(x.n_removed, 0) AS n_removed, coalesce(x.n_spans, 0) AS n_spans,
  sha256(coalesce(x.kept, '')) AS kept_sha256, CASE WHEN x.rid IS NULL THEN s.text ELSE (CASE WHEN s.lead = 1 THEN s.gaps[1] ELSE '' END) || x.rest END AS text
FROM s LEFT JOIN sums x ON x.rid = s.rid
"""
}
