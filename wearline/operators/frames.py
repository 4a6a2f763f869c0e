"""Skew-safe row frames: windows over a unit's last ``n`` rows without one task per long unit.

A plain ``Window.partitionBy(unit)`` puts a unit's whole history into one task; a unit with a
third of the fleet's rows would then run in one task. Here a long unit is cut into ranges of its
order column, and every window is partitioned by ``(unit, range)``:

1. One aggregate counts the rows of each unit. Units of more than ``chunk_rows`` rows (and of more
   than 1 row in ``MOST_LONG``, which bounds their number) are long. Where there is none, which is
   the usual case, that is all: frames are plain per-unit windows over one scan and one shuffle.
2. Long units get split points: quantiles of their order column, from one mergeable sketch for
   each of them. The points of all long units are a small table that is broadcast, so a row finds
   its range in its own task and the data is shuffled once, by ``(unit, range)``.
3. The last ``before`` rows of each range are written as a small table and offered to the next
   ``before`` ranges of the unit; each range keeps the newest ``before`` rows offered. That is
   exact because every range but the first holds its lower split point, so nothing older than
   ``before`` ranges back can be among a range's ``before`` predecessors.

``deal`` adds the range as column ``_chunk`` and, only where there are long units, ``_long``: facts
about the row's unit. Labels, cycle numbers, rolling windows and sequences all take a frame that
is dealt already, so that they share one shuffle. Frames may be dealt by a number or a timestamp,
and windowed by another column that sorts a unit's rows the same way and is unique within it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.constants import CHUNK_ROWS
from wearline.functions.columns import as_list
from wearline.session import materialize, ship

CHUNK, OWN, LONG = "_chunk", "_own", "_long"
ROW = "_row"
#: Long units hold more than 1 row in so many, so there are fewer of them.
MOST_LONG = 65_536
#: Ranges of one unit, at most, and the split points of one step of the search for a row's range.
MOST_RANGES, STEP = 4_096, 64


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def _range_of(order: str) -> Column:
    """How many split points lie below the row: first among every ``STEP``-th, then between two of those."""
    coarse = F.size(F.filter(F.col(f"{LONG}.coarse"), lambda b: b < F.col(order)))
    fine = F.size(F.filter(F.slice(F.col(f"{LONG}.points"), coarse * STEP + 1, F.lit(STEP)), lambda b: b < F.col(order)))
    return F.coalesce(coarse * STEP + fine, F.lit(0))


def _joined(df: DataFrame, facts: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``df`` with the facts of its unit; a null key is a unit too."""
    facts = F.broadcast(facts.withColumnsRenamed({k: f"_of_{k}" for k in keys}))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(facts, same, how).drop(*[f"_of_{k}" for k in keys])


def long_units(df: DataFrame, keys: Sequence[str], order: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame | None:
    """``keys, _long`` of the long units: split points, rows, last value of ``order``, rows before each range.

    ``None`` where no unit is long: the driver reads one row to know.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    seen = counts.agg(F.sum("_rows").alias("rows"), F.count_if(F.col("_rows") > chunk_rows).alias("long")).first()
    if not seen["long"]:
        return None
    bar = max(chunk_rows, seen["rows"] // MOST_LONG)
    many = materialize(counts.filter(F.col("_rows") > bar))
    own = _joined(df.select(*keys, order), many, keys, "inner")
    shares = [i / MOST_RANGES for i in range(1, MOST_RANGES)]
    points = own.groupBy(*keys).agg(
        F.max("_rows").alias("rows"), F.max(order).alias("last"), F.percentile_approx(order, shares, F.lit(20 * MOST_RANGES)).alias("_q")
    )
    ranges = F.least(F.ceil(F.col("rows") / F.lit(bar)), F.lit(MOST_RANGES)).cast("int")
    picked = F.transform(F.sequence(F.lit(1), ranges - 1), lambda i: F.get(F.col("_q"), F.floor(i * MOST_RANGES / ranges).cast("int") - 1))
    # with one range there is nothing to pick; sequence() would count down
    picked = F.when(ranges > 1, F.array_distinct(picked)).otherwise(F.slice("_q", 1, 0))
    points = points.select(*keys, "rows", "last", picked.alias("points"))
    every = F.filter("points", lambda b, i: (i % STEP) == STEP - 1)
    points = points.select(*keys, F.struct("rows", "last", "points", every.alias("coarse"), (F.size("points") + 1).alias("ranges")).alias(LONG))
    points = materialize(points)
    # how many rows stand before each range
    sizes = _joined(df.select(*keys, order), points, keys, "inner").groupBy(*keys, _range_of(order).alias(CHUNK)).agg(F.count(F.lit(1)).alias("n"))
    lists = sizes.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(CHUNK, "n"))).alias("_n"))
    # one count for each range, so no list is longer than MOST_RANGES
    whole = _joined(lists, points, keys, "inner")
    size = lambda i: F.coalesce(F.try_element_at("_n", i), F.lit(0))
    before = F.aggregate(
        F.sequence(F.lit(0), F.col(f"{LONG}.ranges") - 1),
        F.array(F.lit(0).cast("bigint")),
        lambda acc, i: F.concat(acc, F.array(F.element_at(acc, -1) + size(i))),
    )
    return materialize(whole.select(*keys, F.col(LONG).withField("before", before).alias(LONG)))


def deal(df: DataFrame, keys: str | Iterable[str], order: str = "cycle", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``df`` with the column ``_chunk`` (0 for all but long units) and, if there are long units, ``_long``."""
    keys = as_list(keys)
    facts = long_units(df, keys, order, chunk_rows)
    if facts is None:
        return df.withColumn(CHUNK, F.lit(0))
    return _joined(df, facts, keys, "left").withColumn(CHUNK, _range_of(order))


def is_dealt(df: DataFrame) -> bool:
    return CHUNK in df.columns


def helpers(df: DataFrame) -> list[str]:
    """The columns that ``deal`` added."""
    return [c for c in (CHUNK, LONG) if c in df.columns]


def plain(df: DataFrame) -> DataFrame:
    return df.drop(*helpers(df))


def part_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [*keys, CHUNK]


def per_unit(df: DataFrame, keys: Sequence[str], fact: str, own: Column) -> Column:
    """A fact of the unit: known for long units, else ``own`` over the unit's only range."""
    whole = own.over(Window.partitionBy(*part_keys(df, keys)))
    return F.coalesce(F.col(f"{LONG}.{fact}"), whole) if LONG in df.columns else whole


def number_cycles(df: DataFrame, keys: str | Iterable[str], order: Sequence[str], out: str = "cycle") -> DataFrame:
    """``out`` = the row's number in its unit by ``order``, whose first column dealt ``df``.

    Ranges are numbered by themselves and start at the rows before them.
    """
    keys = as_list(keys)
    number = F.row_number().over(Window.partitionBy(*part_keys(df, keys)).orderBy(*order)).cast("bigint")
    if LONG not in df.columns:
        return df.withColumn(out, number)
    ahead = F.coalesce(F.get(F.col(f"{LONG}.before"), F.col(CHUNK)), F.lit(0))
    # from now on the unit's last value is a cycle, which is its number of rows
    return df.withColumn(out, number + ahead).withColumn(LONG, F.col(LONG).withField("last", F.col(f"{LONG}.rows")))


def chunk_frames(
    df: DataFrame,
    keys: str | Iterable[str],
    order: str = "cycle",
    before: int = 4,
    chunk_rows: int | None = CHUNK_ROWS,
) -> tuple[DataFrame, list[str]]:
    """Return ``(frame, partition_keys)``.

    ``frame`` has every input row once with ``_own = true`` plus, for ranges of long units, copies
    of the ``before`` rows ahead of them with ``_own = false``; window with
    ``partitionBy(*partition_keys).orderBy(order)`` and keep ``_own`` rows afterwards.
    ``chunk_rows=None`` gives the plain per-unit partitioning. ``df`` may be dealt already.
    """
    keys = as_list(keys)
    if chunk_rows is None:
        return plain(df).withColumn(OWN, F.lit(True)), keys
    if not is_dealt(df):
        df = deal(df, keys, order, chunk_rows)
    part = part_keys(df, keys)
    own = df.withColumn(OWN, F.lit(True))
    if before <= 0 or LONG not in df.columns:
        return own, part
    followed = df.filter(F.col(f"{LONG}.ranges") > F.col(CHUNK) + 1)
    newest = F.row_number().over(Window.partitionBy(*part).orderBy(F.col(order).desc()))
    tail = followed.withColumn("_rd", newest).filter(F.col("_rd") <= before).drop("_rd")
    last = F.least(F.col(CHUNK) + before, F.col(f"{LONG}.ranges") - 1)
    tail = tail.withColumn(CHUNK, F.explode(F.sequence(F.col(CHUNK) + 1, last)))
    tail = tail.withColumn("_rd", newest).filter(F.col("_rd") <= before).drop("_rd")
    # a few rows of each range, written once: the frame reads its source one time
    tail = materialize(tail).repartition(*part)
    return own.unionByName(tail.withColumn(OWN, F.lit(False))), part


def own_rows(frame: DataFrame) -> DataFrame:
    """Keep the input's own rows and drop the helper columns."""
    return plain(frame.filter(F.col(OWN)).drop(OWN))


#: A column's values and, where some are missing, which are there.
Values = tuple[np.ndarray, np.ndarray | None]


def _values(column: pa.Array, before: Values | None, back: int) -> Values:
    """A batch's values behind the last ``back`` ones before it."""
    there = None if column.null_count == 0 else column.is_valid().to_numpy(zero_copy_only=False)
    x = column.fill_null(0.0).to_numpy(zero_copy_only=False)
    old, had = (np.zeros(back), None) if before is None else before
    if there is not None or had is not None:
        had = np.ones(back, bool) if had is None else had
        there = np.concatenate([had, np.ones(len(x), bool) if there is None else there])
    return np.concatenate([old, x]), there


def _tail(x: Values, back: int) -> Values:
    at = len(x[0]) - back
    there = None if x[1] is None or x[1][at:].all() else x[1][at:]
    return x[0][at:], there


def full_windows(
    frame: DataFrame,
    part: Sequence[str],
    order: str,
    n: int,
    values: Mapping[str, Column],
    out: T.StructType,
    compute: Callable[[list[Values], np.ndarray], list[pa.Array]],
) -> DataFrame:
    """The rows of a frame that end a full ``n``-row window, with the columns ``out``.

    A sliding aggregate goes over all of a window's rows at each row, one row at a time.
    ``compute`` instead gets the ``values`` (as doubles) of a batch of rows in window order, the
    ``n - 1`` rows ahead of it included, and the places where the full windows start; it returns
    one array for each column. A task holds a batch and ``n - 1`` rows.

    Rows are numbered by a window and come from it in that order; a batch that does not go on where
    the last one ended fails the job.
    """
    ship(frame.sparkSession)
    frame = frame.drop(LONG)
    number = F.row_number().over(Window.partitionBy(*part).orderBy(order))
    named = [c.cast("double").alias(f"_value_{i}") for i, c in enumerate(values.values())]
    rows = frame.select(*frame.columns, number.alias(ROW)).select(*frame.columns, ROW, *named)
    kept, width = len(frame.columns), len(named)
    names = [*frame.columns, *out.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, last = [None] * width, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column(kept).to_numpy(zero_copy_only=False)
            if ((row != 1) & (np.diff(row, prepend=last) != 1)).any():
                raise ValueError("rows of a unit do not follow each other")
            last = row[-1]
            all_values = [_values(batch.column(kept + 1 + i), b, n - 1) for i, b in enumerate(before)]
            before = [_tail(x, n - 1) for x in all_values]
            full = row >= n
            starts = np.flatnonzero(full)
            if len(starts):
                own = batch.filter(pa.array(full))
                yield pa.RecordBatch.from_arrays([*own.columns[:kept], *compute(all_values, starts)], names=names)

    return rows.mapInArrow(run, T.StructType([*frame.schema.fields, *out.fields]))
