"""Removal of long byte strings that also stand elsewhere in the corpus.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else. With
``words`` given, what shorter strings cover goes too, where the windows that follow each other and
stand elsewhere make up a passage of more words than that (they may stand in different places).

1. Anchors. Every window of ``LENGTH`` bytes picks one of its ``GRAM``-byte strings, the one with
   the smallest hash; equal windows pick the same one at the same relative place. The windows
   that share an anchor make up its segment; each window lies in exactly one segment.
2. Segments meet by the hash of their anchor. Two equal segments prove all their windows
   repeated. An anchor that stands nowhere else proves that none of its windows is. What is left
   are the segments at the edges of repeats. (So the bytes inside long repeats are decided here,
   by hashes of whole segments, and the transform decides the edges.)
3. Those, with one segment for each kind of equal ones of the same anchor, are indexed in groups
   of whole anchors by a run-length transform (``rlbwt.py``), whose matching statistics say which
   windows stand elsewhere. Anchors with more than ``HOT`` such segments don't go to one task:
   their windows are hashed one by one and counted by a shuffle.
4. The texts meet their marks by a 128-bit hash. Copies of a whole text are counted instead.

Results for special rows: null counts as empty; texts shorter than ``LENGTH`` keep all bytes;
each repeated row of a long text loses all of it, since its strings also start in its copies; a
null id is kept; extra columns are ignored by ``spans`` and kept by ``remove``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.llm.common import SpanHashes, blocks, discard, hot_bar, land, looked_up, mix64, runs_of, table, text_bytes
from wearline.llm.cover_anchors import resolved
from wearline.llm.rlbwt import repeated_starts
from wearline.llm.words import word_spans

LENGTH, GRAM = 400, 200
#: Repeated passages of more words are reported, and go from the text that ``cuts`` returns.
PASSAGE_WORDS = 50
#: A difference cover for windows of one word more (``cover_anchors.py``).
_PERIOD, _COVER = 31, (0, 1, 3, 8, 12, 18)
#: Segments of one anchor that one task indexes; beyond, windows are counted by a shuffle.
HOT = 5_000
#: Bytes of segments in one index (whole anchors).
INDEX_BYTES = 1_500_000
#: A longer text is anchored in parts, each with windows of its own.
PART_BYTES = 16_000_000
_POSITION_BITS = 26
_byte = np.arange(256)
#: Blanks part words.
_IN_WORD = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))


# ---- numpy side --------------------------------------------------------------------------------


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """out[i] = min(x[i : i + width]), for the places where that fits."""
    span, out = 1, x
    while span * 2 <= width:
        out = np.minimum(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """row, start, anchor, stop of every segment (windows start..stop pick ``anchor``), and hashes.

    Places count from the row's first byte; ``h`` stands for the anchor's bytes, ``g`` for the
    segment's bytes and the anchor's place in it.
    """
    n = len(data)
    names = ("row", "start", "anchor", "stop", "h", "g")
    if n < length:
        return {k: np.zeros(0, np.int64) for k in names}
    hashes = SpanHashes(data)
    grams = hashes.of(np.arange(n - gram + 1), np.arange(gram, n + 1))
    # hash first, then place: the smallest is the first of the smallest
    packed = (grams >> np.uint64(_POSITION_BITS)) << np.uint64(_POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    pick = (_sliding_min(packed, length - gram + 1) & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.arange(len(pick))
    fits = window + length <= offsets[1:][row_of[window]]
    window, pick = window[fits], pick[fits]
    if not len(window):
        return {k: np.zeros(0, np.int64) for k in names}
    row = row_of[window]
    new = np.concatenate(([True], (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])))
    at = np.flatnonzero(new)
    start, stop, anchor, row = window[at], window[np.append(at[1:], len(window)) - 1], pick[at], row[at]
    g = hashes.of(start, stop + length)
    g = mix64(g + (anchor - start).astype(np.uint64))
    base = offsets[row]
    return {
        "row": row,
        "start": start - base,
        "anchor": anchor - base,
        "stop": stop - base,
        "h": grams[anchor].view(np.int64),
        "g": g.view(np.int64),
    }


def row_anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Iterator[dict[str, np.ndarray]]:
    """``anchors`` of a block; a very long row in parts that overlap by less than a window."""
    if offsets[-1] <= PART_BYTES:
        yield anchors(data, offsets, length, gram)
        return
    for r in range(len(offsets) - 1):
        own = data[offsets[r] : offsets[r + 1]]
        for first in range(0, max(1, len(own) - length + 1), PART_BYTES):
            part = own[first : first + PART_BYTES + length - 1]
            found = anchors(part, np.array([0, len(part)]), length, gram)
            found["row"] = found["row"] + r
            for k in ("start", "anchor", "stop"):
                found[k] = found[k] + first
            yield found


def pack(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return start << 12 | (stop - start)


def covered(n: int, starts: np.ndarray, stops: np.ndarray, length: int) -> np.ndarray:
    """True at the bytes of a text of ``n`` that windows starts..stops cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops + length, -1)
    return np.cumsum(edge[:n]) > 0


def passages(text: bytes, starts: np.ndarray, stops: np.ndarray, length: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of windows whose bytes hold over ``words`` words, parts included, or are ``LENGTH`` at least."""
    first, after = runs_of(covered(max(0, len(text) - length + 1), starts, stops, 1))
    end = after - 1 + length
    begins, ends, _ = word_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]), _IN_WORD)
    held = np.searchsorted(begins, end, "left") - np.searchsorted(ends, first, "right")
    keep = (held > words) | (end - first >= LENGTH)
    return first[keep], after[keep] - 1


# ---- Spark side --------------------------------------------------------------------------------

_KEYS = ["d1", "d2"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"d1": F.xxhash64(text), "d2": F.xxhash64(F.lit(1), text)})


def _segments(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """h, g, d1, d2, p: every segment of every text, once for each text a task sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for block in blocks(batches):
            keys = list(zip(block.column(1).to_pylist(), block.column(2).to_pylist(), strict=True))
            # a text that this task has read already adds nothing
            fresh = []
            for i, k in enumerate(keys):
                if k not in seen:
                    seen.add(k)
                    fresh.append(i)
            if len(seen) > 500_000:
                seen.clear()
            block = block.take(pa.array(fresh, pa.int64()))
            if not block.num_rows:
                continue
            d1, d2 = (block.column(i).to_numpy() for i in (1, 2))
            for found in row_anchors(*text_bytes(block.column(0)), length, gram):
                row = found["row"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found["h"]), pa.array(found["g"]), pa.array(d1[row]), pa.array(d2[row]), pa.array(pack(found["start"], found["stop"]))],
                    names=["h", "g", "d1", "d2", "p"],
                )

    return docs.select("text", "d1", "d2").mapInArrow(run, "h bigint, g bigint, d1 bigint, d2 bigint, p bigint")


def _judged(segments: DataFrame) -> DataFrame:
    """d1, d2, p, h, sure, ask: segments proven repeated, and those that the index needs.

    Anchors are counted before they move; the counts of frequent ones go to every task, so that no
    task takes all segments of one anchor.
    """
    rows = land(segments, "repeat-anchors")
    bar = hot_bar(rows.count())
    again = rows.groupBy("h").agg(F.count("*").alias("n"), F.min("g").alias("low"), F.max("g").alias("high")).filter("n > 1")
    again = land(again.select("h", "n", (F.col("low") != F.col("high")).alias("mixed")), "repeat-again")
    met = land(looked_up(rows, again, ["h"], "n", bar).drop("n"), "repeat-met")
    discard(rows, again)
    # equal segments of one anchor prove each other; one of each kind is indexed
    kinds = met.filter("mixed").groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("d1", "d2", "p")).alias("one"))
    judged = looked_up(met.filter("mixed"), land(kinds, "repeat-kinds"), ["h", "g"], "n", bar)
    asks = F.struct("d1", "d2", "p") == F.col("one")
    alike = met.filter("NOT mixed").select("d1", "d2", "p", "h", F.lit(True).alias("sure"), F.lit(False).alias("ask"))
    return alike.unionByName(judged.select("d1", "d2", "p", "h", (F.col("n") > 1).alias("sure"), asks.alias("ask")))


def _finish(n: int, text: bytes, starts: np.ndarray, stops: np.ndarray, length: int, words: int | None) -> tuple[int, int, bytes, list[bytes]]:
    """Removed bytes, removed runs, the rest of a text, and the runs of over ``PASSAGE_WORDS`` words."""
    if not len(starts):
        return 0, 0, text, []
    if words is not None:
        starts, stops = passages(text, starts, stops, length, words)
    mask = covered(n, starts, stops, length)
    first, after = runs_of(mask)
    cut = [text[a:b] for a, b in zip(first.tolist(), after.tolist(), strict=True)]
    kept = np.frombuffer(text, np.uint8)[~mask].tobytes()
    return int(mask.sum()), len(cut), kept, [c for c in cut if len(c.split()) > PASSAGE_WORDS]


_MARKS = "array<struct<p:bigint,h:bigint,sure:boolean,ask:boolean>>"


class _Marks:
    """The marks of a block's rows as arrays."""

    def __init__(self, column: pa.Array) -> None:
        at = np.asarray(column.offsets).astype(np.int64)
        own = column.values.slice(at[0], at[-1] - at[0]) if len(column) else column.values.slice(0, 0)
        self.at = at - at[0]
        self.p, self.h, self.sure, self.ask = (c.to_numpy(zero_copy_only=False) for c in own.flatten())

    def of(self, row: int) -> slice:
        return slice(self.at[row], self.at[row + 1])

    def windows(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last start of the row's windows that are proven repeated."""
        own = self.of(row)
        p = self.p[own][self.sure[own]]
        return p >> 12, (p >> 12) + (p & 0xFFF)


def _opened(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """Every row with its marks; ``copies`` tells how often its text stands in the table."""
    copies = docs.groupBy(*_KEYS).agg(F.count("*").alias("copies"), F.min("doc_id").alias("least")).filter("copies > 1")
    marks = judged.groupBy(*_KEYS).agg(F.collect_list(F.struct("p", "h", "sure", "ask")).alias("marks"))
    known = marks.join(copies, _KEYS, "full")
    return docs.join(known, _KEYS, "left")


def _index_answers(asked: DataFrame, length: int, hot: int) -> DataFrame:
    """d1, d2, p: runs of windows of the asked segments that stand elsewhere."""
    sizes = asked.groupBy("h").agg(F.count("*").alias("n"))
    many = land(sizes.filter(F.col("n") > hot).select("h"), "hot-anchors")
    usual = asked.join(many, "h", "left_anti")

    def index(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        data, offsets = text_bytes(t.column("segment").combine_chunks())
        again = repeated_starts(data, offsets, length)
        # spans never cross segments: the last bytes of each cannot start a window
        starts, ends = runs_of(again)
        row = np.searchsorted(offsets, starts, "right") - 1
        base = t.column("start").to_numpy()[row] - offsets[row]
        return pa.RecordBatch.from_arrays(
            [pa.array(t.column(k).to_numpy()[row]) for k in _KEYS] + [pa.array(pack(starts + base, ends - 1 + base))], names=["d1", "d2", "p"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for block in blocks(batches, "segment", INDEX_BYTES // 2):
            h = block.column(0).to_numpy()
            if held and size > INDEX_BYTES and held[-1].column(0)[-1].as_py() != h[0]:
                yield index(held)
                held, size = [], 0
            held.append(block)
            size += block.nbytes
            cut = np.flatnonzero(h[1:] != h[:-1])
            if size > INDEX_BYTES and len(cut):
                at = int(cut[-1]) + 1
                held[-1] = block.slice(0, at)
                yield index(held)
                held, size = [block.slice(at)], block.nbytes
        if held:
            yield index(held)

    schema = "d1 bigint, d2 bigint, p bigint"
    # rows that repeat an id and a text supply the same segments: they count once
    one = ["h", "d1", "d2", "start"]
    # an explicit number of partitions: the rows are few, the work on each is not
    many_tasks = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    apart = usual.repartition(many_tasks, "h").dropDuplicates(one).sortWithinPartitions(*one)
    found = apart.select("h", "d1", "d2", "start", "segment").mapInArrow(run, schema)
    if many.isEmpty():
        return found

    def window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "segment", 200_000):
            data, offsets = text_bytes(block.column(4))
            a, b = SpanHashes(data), SpanHashes(data[::-1].copy())
            count = np.diff(offsets) - length + 1
            row = np.repeat(np.arange(block.num_rows), count)
            begin = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + offsets[:-1][row]
            n = len(data)
            w1, w2 = a.of(begin, begin + length), b.of(n - begin - length, n - begin)
            start = block.column(3).to_numpy()[row] + begin - offsets[row]
            d1, d2 = (block.column(i).to_numpy()[row] for i in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (w1.view(np.int64), w2.view(np.int64), d1, d2, start << 12)], names=["w1", "w2", "d1", "d2", "p"]
            )

    windows = asked.join(many, "h", "left_semi").dropDuplicates(one).select("h", "d1", "d2", "start", "segment")
    windows = windows.mapInArrow(window_hashes, "w1 bigint, w2 bigint, d1 bigint, d2 bigint, p bigint")
    twice = windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2")
    return found.unionByName(windows.join(twice, ["w1", "w2"], "left_semi").select("d1", "d2", "p"))


#: Columns that the steps add to the rows.
_OWN = (*_KEYS, "n_bytes", "n_removed", "n_spans", "kept_sha256", "passages", "marks", "copied", "speaks", "open", "supplies", "found", "copies", "least")
_DONE = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, passages array<string>"


def _resolved(docs: DataFrame, length: int, gram: int, hot: int, keep_text: bool, words: int | None = None) -> DataFrame:
    """Every row of ``docs`` with the contract's columns; with ``keep_text`` its text is what is left."""
    docs = _keyed(docs)
    judged = land(_judged(_segments(docs, length, gram)), "repeat-segments")
    opened = _opened(docs, judged)
    names = [f.name for f in docs.schema.fields]
    text_at, n_own = names.index("text"), len(names)
    out_schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL(_DONE).fields])
    opened = opened.select(*names, "marks", (F.coalesce("copies", F.lit(1)) > 1).alias("copied"), F.col("doc_id").eqNullSafe(F.col("least")).alias("speaks"))

    def result(block: pa.RecordBatch, rows: list[int], ends: list[tuple[int, int, bytes, list[bytes]]]) -> pa.RecordBatch:
        """The given rows with what was removed from them."""
        own = block.take(pa.array(rows, pa.int64()))
        columns = own.columns[:n_own]
        sizes = np.diff(text_bytes(own.column(text_at))[1])
        if keep_text:
            # a cut inside a character leaves part of it, which goes too
            columns[text_at] = pa.array([e[2].decode("utf-8", "ignore") for e in ends], columns[text_at].type)
        columns += [
            pa.array(sizes, pa.int64()),
            pa.array([e[0] for e in ends], pa.int64()),
            pa.array([e[1] for e in ends], pa.int64()),
            pa.array([hashlib.sha256(e[2]).hexdigest() for e in ends], pa.string()),
            pa.array([[c.decode("utf-8", "ignore") for c in e[3]] for e in ends], pa.list_(pa.string())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=out_schema.names)

    pending_schema = T.StructType([*out_schema.fields, *T.StructType.fromDDL(f"marks {_MARKS}, open boolean, supplies boolean").fields])

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = text_bytes(block.column(text_at))
            raw = data.tobytes()
            marks = _Marks(block.column(n_own))
            copied, speaks = (block.column(n_own + i).to_pylist() for i in (1, 2))
            done, ends, left, supplies = [], [], [], []
            for r in range(block.num_rows):
                own = raw[offsets[r] : offsets[r + 1]]
                asks = bool(marks.ask[marks.of(r)].any())
                undecided = not copied[r] and not marks.sure[marks.of(r)].all()
                if not undecided:
                    if copied[r] and len(own) >= length:
                        ends.append(_finish(len(own), own, np.array([0]), np.array([len(own) - length]), length, words))
                    else:
                        ends.append(_finish(len(own), own, *marks.windows(r), length, words))
                    done.append(r)
                if undecided or (asks and (speaks[r] or not copied[r])):
                    left.append(r)
                    supplies.append(undecided)
            if done:
                b = result(block, done, ends)
                empty = [pa.nulls(len(done), block.column(n_own).type), pa.array([False] * len(done)), pa.array([False] * len(done))]
                yield pa.RecordBatch.from_arrays([*b.columns, *empty], names=pending_schema.names)
            if left:
                own = block.take(pa.array(left, pa.int64()))
                n = len(left)
                blank = [pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()))]
                columns = [*own.columns[:n_own], *blank, own.column(n_own), pa.array(supplies), pa.array([True] * n)]
                yield pa.RecordBatch.from_arrays(columns, names=pending_schema.names)

    passed = land(opened.mapInArrow(first_pass, pending_schema), "repeat-texts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = text_bytes(block.column(0))
            raw = data.tobytes()
            d1, d2 = (block.column(i).to_numpy() for i in (1, 2))
            marks = _Marks(block.column(3))
            row = np.repeat(np.arange(block.num_rows), np.diff(marks.at))[marks.ask]
            p = marks.p[marks.ask]
            start = p >> 12
            first = offsets[:-1][row] + start
            if len(row):
                segments = [raw[a:b] for a, b in zip(first.tolist(), (first + (p & 0xFFF) + length).tolist(), strict=True)]
                columns = [pa.array(x) for x in (marks.h[marks.ask], d1[row], d2[row], start)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(segments, pa.binary())], names=["h", "d1", "d2", "start", "segment"])

    waiting = passed.filter("supplies")
    asked = waiting.select("text", "d1", "d2", "marks").mapInArrow(cut, "h bigint, d1 bigint, d2 bigint, start bigint, segment binary")
    asked = land(asked, "repeat-edges")
    answers = _index_answers(asked, length, hot).groupBy(*_KEYS).agg(F.collect_list("p").alias("found"))
    late = passed.filter("open").join(answers, _KEYS, "left").select(*names, "marks", "found")

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            data, offsets = text_bytes(block.column(text_at))
            raw = data.tobytes()
            marks, found = _Marks(block.column(n_own)), block.column(n_own + 1).to_pylist()
            ends = []
            for r in range(block.num_rows):
                own = raw[offsets[r] : offsets[r + 1]]
                starts, stops = marks.windows(r)
                p = np.array(found[r] or (), np.int64)
                ends.append(_finish(len(own), own, np.append(starts, p >> 12), np.append(stops, (p >> 12) + (p & 0xFFF)), length, words))
            yield result(block, list(range(block.num_rows)), ends)

    done = passed.filter("kept_sha256 IS NOT NULL").select(*out_schema.names)
    out = done.unionByName(late.mapInArrow(second_pass, out_schema))
    out._read_from = (judged, passed, asked)
    return out


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    out = _resolved(docs.select("doc_id", "text"), length, gram, hot, keep_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def remove(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, words: int | None = None) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``, every column kept.

    With ``words``, of ``length`` under ``LENGTH``, only passages of more words or of ``LENGTH`` bytes go.
    What a cut leaves of a divided character goes too; ``n_chars``, where it is a column, is counted anew.
    """
    own = docs.columns
    clash = [c for c in own if c in _OWN]
    renamed = docs.withColumnsRenamed({c: f"own_{c}" for c in clash})
    out = _resolved(renamed, length, gram, hot, keep_text=True, words=words)
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*renamed.columns).withColumnsRenamed({f"own_{c}": c for c in clash})


def cuts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``spans``, and with it ``text``, which is left when passages of over ``PASSAGE_WORDS`` words that
    also stand elsewhere have gone as well, and those passages of any length in bytes.

    Bytes under strings of ``length`` are gone already; in what is left, shorter passages are windows
    of ``PASSAGE_WORDS + 1`` words, which ``cover_anchors`` finds.
    """
    first = _resolved(docs.select("doc_id", "text"), length, gram, hot, keep_text=True)
    cut = land(first, "repeat-cuts")
    discard(*first._read_from)
    whole = resolved(cut, PASSAGE_WORDS + 1, _PERIOD, _COVER)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return whole.select(*names, F.col("rest").alias("text"), F.concat("passages", "removed").alias("passages"))


def op7_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every whole text of ``documents`` loses, and what is left of it."""
    return cuts(table(spark, sf_dir, "documents"))


QUERIES = {"op7_run_length_dedup": op7_run_length_dedup}
ORACLE_SQL: dict[str, str] = {}
