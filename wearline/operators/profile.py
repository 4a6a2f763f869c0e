"""Profiles and checks (A2-A7, O1): counts, lifetimes by split, sensor spread, class balance."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from wearline.constants import FLAT_TOLERANCE
from wearline.functions.columns import as_list


def profile(df: DataFrame, keys: str | Iterable[str] = "unit", approx: bool = False) -> DataFrame:
    """A3 + A5: one row with ``n_rows`` and ``n_units`` (exact or HyperLogLog++)."""
    keys = as_list(keys)
    unit = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
    distinct = F.approx_count_distinct(unit) if approx else F.count_distinct(unit)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_units"))


def observe_counts(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """A5 inside a pipeline: the count is collected by the job that runs anyway, no extra job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n_rows")), obs


def units(df: DataFrame, keys: str | Iterable[str] = "unit") -> DataFrame:
    """A4: distinct units."""
    return df.select(*as_list(keys)).distinct()


def split_profile(df: DataFrame, split: str = "split", keys: str | Iterable[str] = "unit", order: str = "cycle") -> DataFrame:
    """A2: per split, the number of units and rows and the mean lifetime (last cycle) per unit."""
    keys = as_list(keys)
    per_unit = df.groupBy(split, *keys).agg(F.max(order).alias("_life"), F.count(F.lit(1)).alias("_n"))
    return per_unit.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_units"),
        F.sum("_n").alias("n_rows"),
        F.avg("_life").alias("avg_lifetime"),
    )


def sensor_spread(df: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """A6 + O1: sample std (and mean) of every sensor in one pass, ascending by std."""
    sensors = list(sensors)
    aggs = []
    for s in sensors:
        aggs += [F.stddev_samp(s).alias(f"sd__{s}"), F.avg(s).alias(f"m__{s}")]
    one = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(s).alias("sensor"), F.col(f"sd__{s}").alias("std"), F.col(f"m__{s}").alias("mean"))
        for s in sensors
    ])).alias("p")
    return one.select(stacked).select("p.*").orderBy(F.col("std").asc_nulls_first(), "sensor")


def flat_sensors(df: DataFrame, sensors: Sequence[str], tol: float = FLAT_TOLERANCE) -> DataFrame:
    """Sensors whose std is at most ``tol * greatest(|mean|, 1)`` (relative, never ``= 0``)."""
    spread = sensor_spread(df, sensors)
    flat = F.col("std").isNull() | (F.col("std") <= F.lit(tol) * F.greatest(F.abs(F.col("mean")), F.lit(1.0)))
    return spread.filter(flat).select("sensor")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Share of rows per class. The total is a window over the few class rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", (F.col("n") / total).alias("share"))
