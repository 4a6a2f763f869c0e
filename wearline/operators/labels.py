"""Remaining-life and failure-horizon labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.constants import FAILURE_HORIZON
from wearline.functions.columns import as_list
from wearline.operators.frames import is_dealt, per_unit


def lifetimes(df: DataFrame, keys: str | Iterable[str] = "unit", order: str = "cycle") -> DataFrame:
    """A1: last cycle seen per unit (partial aggregation before the shuffle)."""
    keys = as_list(keys)
    return df.groupBy(*keys).agg(F.max(order).alias("max_cycle"))


def label_rul(df: DataFrame, keys: str | Iterable[str] = "unit", order: str = "cycle", out: str = "rul") -> DataFrame:
    """J1 + P4: remaining life = the unit's last cycle minus this cycle (not capped).

    A frame that is dealt already (:func:`wearline.operators.frames.deal`) keeps its shuffle: the
    last cycle is a window maximum, or known where the unit is long. Otherwise the per-unit maximum is a pre-aggregated table (one row per unit) joined back on the key:
    the big side is shuffled at most once, AQE may turn the join into a broadcast when the
    unit table is small, and a hot unit is split by AQE's skew-join handling instead of
    landing in one window task.
    """
    keys = as_list(keys)
    if is_dealt(df):
        return df.withColumn(out, per_unit(df, keys, "last", F.max(order)) - F.col(order))
    life = lifetimes(df, keys, order)
    joined = df.join(life, keys, "inner")
    return joined.select(*df.columns, (F.col("max_cycle") - F.col(order)).alias(out))


def label_fail_within(df: DataFrame, horizon: int = FAILURE_HORIZON, rul: str = "rul", out: str | None = None) -> DataFrame:
    """1 when the unit fails within ``horizon`` cycles (``rul <= horizon``), else 0."""
    out = out or f"fail_within_{horizon}"
    return df.withColumn(out, (F.col(rul) <= horizon).cast("int"))
