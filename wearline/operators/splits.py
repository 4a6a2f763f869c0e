"""Leakage-free splits by unit.

Every unit gets a seeded hash ``md5("<seed>:<unit>")``; it decides the split, so the result
does not depend on partitioning, row order or cluster size, and DuckDB computes the same
hash. ``mode="exact"`` sends exactly ``ceil(share * units)`` units to validation (the units
with the smallest hashes, ranked bucket-wise, never in one task); ``mode="hash"`` compares
the hash with the share directly, needs no global count, and gives about ``share`` of units.
Which units land where differs from a NumPy shuffle by design.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.constants import SEED, VALIDATION_SHARE
from wearline.functions.columns import as_list
from wearline.operators.ranks import global_row_number, uniform_bounds

TRAIN = "train"
VALIDATION = "validation"


def unit_hash(keys: Iterable[str], seed: int = SEED) -> Column:
    """60-bit seeded hash of the unit key: first 15 hex digits of ``md5("seed:key...")``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def unit_assignment(
    df: DataFrame,
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
    keys: str | Iterable[str] = "unit",
    mode: str = "exact",
    out: str = "split",
) -> DataFrame:
    """One row per unit with ``split`` = ``'train'`` or ``'validation'``."""
    keys = as_list(keys)
    units = df.select(*keys).distinct().withColumn("_h", unit_hash(keys, seed))
    if mode == "hash":
        val = F.col("_h") < F.lit(int(share * 2**60))
        return units.select(*keys, F.when(val, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)).alias(out))
    if mode != "exact":
        raise ValueError(f"unknown split mode {mode!r}")
    # md5 bits are uniform, so equal-width buckets over [0, 2**60) are balanced: no sampling pass
    nb = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    ranked = global_row_number(units, ["_h", *keys], out="_rank", bounds=uniform_bounds(0.0, float(2**60), nb))
    k = F.ceil(F.lit(float(share)) * F.col("_rank_total"))
    return ranked.select(*keys, F.when(F.col("_rank") <= k, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)).alias(out))


def assign_split(
    df: DataFrame,
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
    keys: str | Iterable[str] = "unit",
    mode: str = "exact",
    out: str = "split",
) -> DataFrame:
    """Every row tagged with its unit's split."""
    keys = as_list(keys)
    if mode == "hash":
        val = unit_hash(keys, seed) < F.lit(int(share * 2**60))
        return df.withColumn(out, F.when(val, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)))
    return df.join(unit_assignment(df, share, seed, keys, mode, out), keys, "inner").select(*df.columns, out)


def split_by_unit(
    df: DataFrame,
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
    keys: str | Iterable[str] = "unit",
    mode: str = "exact",
) -> tuple[DataFrame, DataFrame]:
    """``(train, validation)`` frames; disjoint and complete by construction."""
    tagged = assign_split(df, share, seed, keys, mode, "_split")
    train = tagged.filter(F.col("_split") == TRAIN).drop("_split")
    val = tagged.filter(F.col("_split") == VALIDATION).drop("_split")
    return train, val


def split_overlap(a: DataFrame, b: DataFrame, keys: str | Iterable[str] = "unit") -> DataFrame:
    """Units present in both frames (the leakage check; must be empty)."""
    keys = as_list(keys)
    return a.select(*keys).intersect(b.select(*keys))
