"""Per-unit rolling statistics and latest-state operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.constants import CHUNK_ROWS, KEPT_SENSORS, ROLLING_WINDOW
from wearline.functions.columns import as_list, mean_col, std_col
from wearline.operators.frames import chunk_frames, own_rows


def _rolled(sensors: Sequence[str], w: Window) -> list[Column]:
    cols: list[Column] = []
    for s in sensors:
        cols.append(F.avg(s).over(w).alias(mean_col(s)))
        cols.append(F.stddev_samp(s).over(w).alias(std_col(s)))
    return cols


def rolling_features(
    df: DataFrame,
    sensors: Sequence[str] = KEPT_SENSORS,
    n: int = ROLLING_WINDOW,
    keys: str | Iterable[str] = "unit",
    order: str = "cycle",
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """W1 + W2: mean and sample std of each sensor over the unit's last ``n`` rows, current included.

    Shorter prefixes are allowed (first row: mean = value, std = NULL). All columns come out
    of one ``Window`` operator after one shuffle of the full data; a unit of more than
    ``chunk_rows`` rows is split into ranges so it does not land in one task (see
    :mod:`wearline.operators.frames`).
    """
    frame, part = chunk_frames(df, keys, order, n - 1, chunk_rows)
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(-(n - 1), 0)
    return own_rows(frame.select(*frame.columns, *_rolled(sensors, w)))


def latest_per_unit(df: DataFrame, keys: str | Iterable[str] = "unit", order: str = "cycle") -> DataFrame:
    """The row with the highest ``order`` per unit (partial limit runs before the shuffle)."""
    return last_k(df, 1, keys, order)


def last_k(df: DataFrame, k: int = ROLLING_WINDOW, keys: str | Iterable[str] = "unit", order: str = "cycle") -> DataFrame:
    """The newest ``k`` rows of every unit.

    ``row_number() <= k`` lets Spark insert a partial ``WindowGroupLimit`` ahead of the
    exchange, so at most ``k`` rows per unit leave each map task whatever the unit's size.
    """
    keys = as_list(keys)
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))
    return df.withColumn("_rn", rn).filter(F.col("_rn") <= k).drop("_rn")


def current_state(
    df: DataFrame,
    sensors: Sequence[str] = KEPT_SENSORS,
    n: int = ROLLING_WINDOW,
    keys: str | Iterable[str] = "unit",
    order: str = "cycle",
) -> DataFrame:
    """The latest row of every unit with its rolling features, without rolling the history.

    Equals ``latest_per_unit(rolling_features(df))``: a frame of ``n`` rows at the newest row
    only needs the newest ``n`` rows, so W4 runs first and one aggregate finishes the job.
    """
    keys = as_list(keys)
    recent = last_k(df, n, keys, order)
    others = [c for c in df.columns if c not in keys and c != order]
    aggs: list[Column] = [F.max(order).alias(order)]
    aggs += [F.max_by(c, order).alias(c) for c in others]
    for s in sensors:
        aggs.append(F.avg(s).alias(mean_col(s)))
        aggs.append(F.stddev_samp(s).alias(std_col(s)))
    out = recent.groupBy(*keys).agg(*aggs)
    return out.select(*df.columns, *[c for s in sensors for c in (mean_col(s), std_col(s))])
