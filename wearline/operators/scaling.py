"""Standard scaling with fitted parameters.

The fit is one pass of ``avg`` and ``stddev_pop`` per feature (NULL and NaN skipped, population
std), unpivoted to a ``feature, mean, scale`` table. A scale at or below
``FLAT_TOLERANCE * greatest(|mean|, 1)`` counts as zero variance and becomes 1: merged
partial aggregates of a constant column can give about 1e-15 instead of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.constants import FLAT_TOLERANCE
from wearline.functions.columns import as_list


def fit_scaler(df: DataFrame, cols: Sequence[str], tol: float = FLAT_TOLERANCE) -> DataFrame:
    """``feature, pos, mean, scale`` (one row per feature, in the given order)."""
    cols = as_list(cols)
    aggs = []
    for c in cols:
        x = F.nanvl(F.col(c), F.lit(None).cast("double"))  # NaN is missing too, as NULL is
        aggs += [F.avg(x).alias(f"m__{c}"), F.stddev_pop(x).alias(f"s__{c}")]
    one = df.agg(*aggs)
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.lit(i).alias("pos"), F.col(f"m__{c}").alias("mean"), F.col(f"s__{c}").alias("std"))
        for i, c in enumerate(cols)
    ])).alias("p")
    long = one.select(stacked).select("p.*")
    flat = F.col("std").isNull() | (F.col("std") <= F.lit(tol) * F.greatest(F.abs(F.col("mean")), F.lit(1.0)))
    return long.select("feature", "pos", "mean", F.when(flat, F.lit(1.0)).otherwise(F.col("std")).alias("scale"))


def scaler_literals(params: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float]]:
    """Fitted parameters as Python numbers: one row per feature, a proven bound (len(cols))."""
    cols = as_list(cols)
    rows = params.filter(F.col("feature").isin(cols)).select("feature", "mean", "scale").limit(len(cols) + 1).collect()
    if len(rows) > len(cols):
        raise ValueError("scaler table has more than one row per feature")
    got = {r["feature"]: (r["mean"], r["scale"]) for r in rows}
    missing = [c for c in cols if c not in got]
    if missing:
        raise ValueError(f"scaler has no parameters for {missing}")
    return got


def scale_features(
    df: DataFrame,
    params: DataFrame | dict,
    cols: Sequence[str],
    impute: str = "before",
    fill_cols: Sequence[str] | None = None,
    fill_value: float = 0.0,
) -> DataFrame:
    """M3: ``(x - mean) / scale`` for every feature column.

    The fitted table is read once (one row per feature) and inlined as literals, so scaling
    stays inside whole-stage codegen with no join at all.

    ``impute`` picks the convention for missing values:
    ``"before"`` fills ``fill_cols`` (default: all ``cols``) with 0 and then scales;
    ``"after"`` scales first (NULL stays NULL) and then fills with 0, so a missing value
    ends at the training mean; ``"none"`` leaves NULLs.
    """
    cols = as_list(cols)
    fill = as_list(fill_cols) if fill_cols is not None else cols
    lits = params if isinstance(params, dict) else scaler_literals(params, cols)
    if impute == "before":
        df = df.fillna(fill_value, subset=fill)
    elif impute not in ("after", "none"):
        raise ValueError(f"unknown impute mode {impute!r}")
    scaled = []
    for c in df.columns:
        if c in lits and c in cols:
            mean, scale = lits[c]
            mean_lit = F.lit(mean).cast("double") if mean is not None else F.lit(None).cast("double")
            scaled.append(((F.col(c) - mean_lit) / F.lit(float(scale))).alias(c))
        else:
            scaled.append(F.col(c))
    out = df.select(*scaled)
    if impute == "after":
        out = out.fillna(fill_value, subset=fill)
    return out
