"""Fixed-length sequence windows per unit (W6-W8) and their summaries (inputs of M6).

A sequence ends at every row that has ``n - 1`` predecessors in its unit (stride 1); its
target is the target at the window's last row. Frames are those of
:mod:`wearline.operators.frames`: one scan and one shuffle, and a unit with a huge history is
spread over many tasks.
``collect_list`` drops bare NULLs, so each step is collected as an ``array`` of features,
which keeps NULL features in place.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.constants import CHUNK_ROWS, SEQUENCE_LENGTH
from wearline.functions.columns import as_list
from wearline.operators.frames import LONG, Values, chunk_frames, full_windows, helpers, own_rows, plain
from wearline.operators.rolling import last_k


def sequences(
    df: DataFrame,
    feats: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    keys: str | Iterable[str] = "unit",
    order: str = "cycle",
    target: str = "rul",
    short: str = "skip",
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """W6/W8 (``short="skip"``) and W7 (``short="pad"``).

    Output: ``keys, cycle`` (the window's last cycle), ``target``, ``seq`` =
    ``array<array<double>>`` of ``n`` steps, oldest first. With ``"pad"`` a unit shorter than
    ``n`` yields exactly one sequence: its rows preceded by copies of its first row.
    """
    if short not in ("skip", "pad"):
        raise ValueError(f"unknown short-unit policy {short!r}")
    keys = as_list(keys)
    feats = list(feats)
    step = F.array(*[F.col(f).cast("double") for f in feats])
    frame, part = chunk_frames(df.select(*keys, order, target, *feats, *helpers(df)), keys, order, n - 1, chunk_rows)
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(-(n - 1), 0)
    seq = F.collect_list(step).over(w)
    if short == "skip":
        windowed = frame.select(*frame.columns, seq.alias("seq"))
        return own_rows(windowed).filter(F.size("seq") == n).select(*keys, order, target, "seq")
    # a unit is short where its last row's window holds less than n rows; the window then starts
    # at the unit's first row
    newest = F.max(order).over(Window.partitionBy(*part))
    if LONG in frame.columns:
        newest = F.coalesce(F.col(f"{LONG}.last"), newest)
    windowed = own_rows(frame.select(*frame.columns, seq.alias("seq"), newest.alias("_newest")))
    windowed = windowed.filter((F.size("seq") == n) | (F.col(order) == F.col("_newest")))
    padded = F.concat(F.array_repeat(F.element_at("seq", 1), F.lit(n) - F.size("seq")), F.col("seq"))
    return windowed.select(*keys, order, target, padded.alias("seq"))


def explode_sequences(seqs: DataFrame, feats: Sequence[str], keys: Sequence[str] = ("unit", "cycle"), target: str = "rul") -> DataFrame:
    """Long form of a sequence table: one row per (sequence, step), ``step`` 1 = oldest."""
    ex = seqs.select(*keys, target, F.posexplode("seq").alias("_p", "_v"))
    return ex.select(
        *keys, target, (F.col("_p") + 1).cast("bigint").alias("step"),
        *[F.col("_v")[i].alias(f) for i, f in enumerate(feats)],
    )


def window_summaries(
    df: DataFrame,
    sensors: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    keys: str | Iterable[str] = "unit",
    order: str = "cycle",
    chunk_rows: int | None = CHUNK_ROWS,
    short: str = "skip",
) -> DataFrame:
    """Per full ``n``-row window: first value, mean, sample std and slope against the cycle
    of each sensor. The same rows as W6 with the same ``short``, without materialising arrays.
    Only full windows are summed up, many at once, each from its oldest row on as Spark's own
    aggregates do, so the values are theirs to the last bit.

    With ``"pad"`` a unit shorter than ``n`` gives one window: its rows, preceded by copies of
    its first row at the cycles before it; a column ``padded`` tells such windows.
    """
    keys = as_list(keys)
    if short not in ("skip", "pad"):
        raise ValueError(f"unknown short-unit policy {short!r}")
    frame, part = chunk_frames(df, keys, order, n - 1, chunk_rows)
    row = Window.partitionBy(*part).orderBy(order)
    frame = frame.select(*frame.columns, *[F.lag(s, n - 1).over(row).alias(f"{s}_wfirst") for s in sensors])
    out = T.StructType([T.StructField(f"{s}_{k}", T.DoubleType()) for s in sensors for k in ("wmean", "wstd", "wslope")])
    values = {c: F.col(c) for c in (order, *sensors)}
    summed = own_rows(full_windows(frame, part, order, n, values, out, _summaries(n)))
    full = summed.select(*plain(df).columns, *summary_columns(sensors))
    if short == "skip":
        return full
    # at most n rows of a unit leave each task before they meet
    df = plain(df)
    recent = last_k(df, n, keys, order)
    whole = Window.partitionBy(*keys)
    first = Window.partitionBy(*keys).orderBy(order)
    rows = recent.withColumns({"_n": F.count(F.lit(1)).over(whole), "_i": F.row_number().over(first)}).filter(F.col("_n") < n)
    copies = F.when(F.col("_i") == 1, F.sequence(F.lit(0), F.lit(n) - F.col("_n"))).otherwise(F.array(F.lit(0).cast("bigint")))
    rows = rows.withColumn("_back", F.explode(copies.cast("array<bigint>")))
    rows = rows.withColumn("_at", F.col(order) - F.col("_back"))
    aggs = [F.max_by(F.struct(*[c for c in df.columns if c not in keys]), "_at").alias("_last")]
    for s in sensors:
        aggs += [
            F.min_by(s, "_at").alias(f"{s}_wfirst"),
            F.avg(s).alias(f"{s}_wmean"),
            F.stddev_samp(s).alias(f"{s}_wstd"),
            F.regr_slope(F.col(s), F.col("_at").cast("double")).alias(f"{s}_wslope"),
        ]
    padded = rows.groupBy(*keys).agg(*aggs).select(*keys, "_last.*", *summary_columns(sensors))
    return full.withColumn("padded", F.lit(False)).unionByName(padded.withColumn("padded", F.lit(True)))


def _summaries(n: int):
    """``compute`` of :func:`full_windows`: mean, sample std and slope of each sensor."""

    def compute(values: list[Values], starts: np.ndarray) -> list[pa.Array]:
        (cycle, known), out = values[0], []
        with np.errstate(all="ignore"):
            for sensor, there in values[1:]:
                zero = np.zeros(len(starts))
                total, count, mean, m2 = zero, zero, zero, zero
                pairs, x_mean, y_mean, x_m2, both = zero, zero, zero, zero, zero
                for at in (starts + i for i in range(n)):
                    y, x = sensor[at], cycle[at]
                    has_y = True if there is None else there[at]
                    has = has_y if known is None else has_y & known[at]
                    total = _where(has_y, total + y, total)
                    count = count + has_y
                    d = y - mean
                    step = d / count
                    mean, m2 = _where(has_y, mean + step, mean), _where(has_y, m2 + d * (d - step), m2)
                    pairs = pairs + has
                    dx, dy = x - x_mean, y - y_mean
                    step = dx / pairs
                    x_mean, x_m2 = _where(has, x_mean + step, x_mean), _where(has, x_m2 + dx * (dx - step), x_m2)
                    y_mean = _where(has, y_mean + dy / pairs, y_mean)
                    both = _where(has, both + dx * (y - y_mean), both)
                out += [
                    pa.array(total / count, mask=count == 0),
                    pa.array(np.sqrt(m2 / (count - 1)), mask=count < 2),
                    pa.array(both / x_m2, mask=x_m2 == 0),
                ]
        return out

    return compute


def _where(has: np.ndarray | bool, new: np.ndarray, old: np.ndarray) -> np.ndarray:
    return new if has is True else np.where(has, new, old)


def summary_columns(sensors: Sequence[str]) -> list[str]:
    return [f"{s}_{k}" for s in sensors for k in ("wfirst", "wmean", "wstd", "wslope")]
