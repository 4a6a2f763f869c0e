"""Paired comparison of two models on the same rows.

All statistics are aggregates; p-values are computed from the single aggregated row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearline.constants import BOOTSTRAP_RESAMPLES, CI_PERCENTILES, SEED
from wearline.functions.stats import ReplicateWeights, normal_pvalue, row_hash32, t_pvalue
from wearline.operators.ranks import ordered_prefix
from wearline.session import ship

FIXED_BITS = 40
LIMB_BITS = 20
LIMBS = 6
ROWS_AT_ONCE = 256
#: Up to so many ranks without ties, the signed-rank p-value is exact.
EXACT_RANKS = 50


def one_row(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Put single-row aggregates side by side as scalar subqueries (no join at all)."""
    cols = [F.col(c) for c in first.columns]
    for o in others:
        cols += [o.select(c).scalar().alias(c) for c in o.columns]
    return first.select(*cols)


def align(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("unit", "cycle")) -> DataFrame:
    """Rows predicted by both models (inner equi-join on the row key)."""
    return a.join(b, list(keys), "inner")


def paired_t(df: DataFrame, d: str = "d") -> DataFrame:
    """``n, mean_diff, sd_diff, t, dof`` of the paired difference (NULL and NaN skipped)."""
    x = _present(F.col(d))
    n = F.count(x)
    mean = F.avg(x)
    sd = F.stddev_samp(x)
    one = df.agg(n.alias("n"), mean.alias("mean_diff"), sd.alias("sd_diff"))
    t = F.try_divide(F.col("mean_diff"), F.col("sd_diff") / F.sqrt(F.col("n")))
    return one.select("n", "mean_diff", "sd_diff", t.alias("t"), (F.col("n") - 1).alias("dof"))


def wilcoxon(df: DataFrame, d: str = "d", buckets: int | None = None) -> DataFrame:
    """Wilcoxon signed-rank, zeros dropped, mid-ranks for ties, normal approximation.

    Rows are grouped by ``|d|`` (one row per distinct magnitude with its count and signs);
    a magnitude's mid-rank is ``below + (count + 1) / 2`` with ``below`` a bucket-wise
    running count. ``w`` = min(W+, W-); ``z`` uses the tie-corrected variance
    ``n(n+1)(2n+1)/24 - sum(t^3 - t)/48``. For small ``n`` without ties see
    :func:`exact_signed_rank_p`.
    """
    nz = df.select(_present(F.col(d)).alias("_d")).filter("_d IS NOT NULL AND _d <> 0").select(F.abs("_d").alias("_a"), (F.col("_d") > 0).alias("_pos"))
    g = nz.groupBy("_a").agg(
        F.count(F.lit(1)).cast("double").alias("_c"),
        F.sum(F.when(F.col("_pos"), 1).otherwise(0)).cast("double").alias("_np"),
    )
    p = ordered_prefix(g, ["_a"], {"cnt": F.col("_c")}, buckets)
    mid = F.col("cnt_before") + (F.col("_c") + 1.0) / 2.0
    one = p.agg(
        F.coalesce(F.sum("_c"), F.lit(0.0)).alias("n"),
        F.coalesce(F.sum(F.col("_np") * mid), F.lit(0.0)).alias("w_plus"),
        F.coalesce(F.sum((F.col("_c") - F.col("_np")) * mid), F.lit(0.0)).alias("w_minus"),
        F.coalesce(F.sum(F.col("_c") * F.col("_c") * F.col("_c") - F.col("_c")), F.lit(0.0)).alias("tie_term"),
    )
    n = F.col("n")
    var = n * (n + 1) * (2 * n + 1) / 24.0 - F.col("tie_term") / 48.0
    w = F.least(F.col("w_plus"), F.col("w_minus"))
    z = F.try_divide(w - n * (n + 1) / 4.0, F.sqrt(F.when(var > 0, var)))
    return one.select(n.cast("bigint").alias("n"), "w_plus", "w_minus", w.alias("w"), "tie_term", z.alias("z"))


def exact_signed_rank_p(n: Column, w: Column, tie_term: Column) -> Column:
    """Two-sided p of the signed-rank statistic from its exact null distribution.

    Without ties each rank 1..n counts with either sign, so the number of sign choices with rank
    sum s follows from those of n - 1 ranks: c_n(s) = c_(n-1)(s) + c_(n-1)(s - n). The counts are
    built up as one array on the aggregated row; p = 2 P(W <= w), at most 1. NULL beyond
    ``EXACT_RANKS`` ranks, where counts leave a double's whole numbers, with ties, and for no ranks.
    """
    ranks = F.least(n.cast("int"), F.lit(EXACT_RANKS))
    most = (ranks * (ranks + 1) / 2).cast("int")
    none = F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), most))
    add = lambda acc, k: F.transform(acc, lambda v, s: v + F.coalesce(F.get(acc, s - k), F.lit(0.0)))
    counts = F.aggregate(F.sequence(F.lit(1), F.greatest(ranks, F.lit(1))), none, add)
    below = F.aggregate(F.slice(counts, F.lit(1), w.cast("int") + 1), F.lit(0.0), lambda a, x: a + x)
    p = F.least(F.lit(1.0), F.lit(2.0) * below / F.pow(F.lit(2.0), ranks.cast("double")))
    return F.when((n >= 1) & (n <= EXACT_RANKS) & (tie_term == 0), p)


def fixed_point_limbs(x: np.ndarray) -> np.ndarray:
    """``floor(x * 2**40)`` as ``LIMBS`` integers of 20 bits each, the first one signed.

    Splitting at powers of two is exact in floating point, so sums of the limbs are exact
    integers whatever their order. Values of ``2**80`` or more do not fit and raise.
    """
    if not np.isfinite(x).all() or (np.abs(x) >= 2.0**80).any():
        raise ValueError("the bootstrap takes finite differences below 2**80")
    rest, step, limbs = np.floor(x * 2.0**FIXED_BITS), 2.0**LIMB_BITS, []
    for _ in range(LIMBS - 1):
        limbs.append(rest % step)
        rest = np.floor(rest / step)
    return np.stack([*limbs, rest][::-1])


def _present(x: Column) -> Column:
    """NaN counts as missing, as NULL does, in every statistic of this module."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))


def bootstrap_means(
    df: DataFrame,
    value: str = "d",
    keys: Sequence[str] = ("unit", "cycle"),
    resamples: int = BOOTSTRAP_RESAMPLES,
    seed: int = SEED,
) -> DataFrame:
    """Poisson bootstrap of the mean; one row per replicate ``rep, mean``.

    Each (row, replicate) gets a Poisson(1) weight from a seeded hash of the row key and the
    replicate number; a replicate's mean is sum(w * x) / sum(w) (Chamandy et al., 2012). Every
    partition keeps one running total per replicate and sends ``resamples`` rows on; no row is
    multiplied and the input is not shuffled.

    ``x`` enters as fixed point with 40 fractional bits (see :func:`fixed_point_limbs`) and
    ``w * x`` is summed in integers: the sums are exact, so every replicate mean is identical
    under any partitioning or merge order. A total beyond 38 decimal digits fails the job.
    NULL and NaN are skipped. It approximates, and does not reproduce, a NumPy draw.
    """
    ship(df.sparkSession)
    names = [f"s{i}" for i in range(LIMBS)]

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, total, seen = None, None, False
        for batch in batches:
            h, x = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if weights is None:
                weights, total = ReplicateWeights(resamples), np.zeros((LIMBS + 1, resamples), np.int64)
            for start in range(0, len(h), ROWS_AT_ONCE):
                seen = True
                w = weights.of(h[start : start + ROWS_AT_ONCE])
                limbs = fixed_point_limbs(x[start : start + ROWS_AT_ONCE])
                # at most 256 rows of 20 bits and small weights: exact in double
                total[0] += w.sum(0).astype(np.int64)
                total[1:] += (limbs @ w).astype(np.int64)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(resamples)), *[pa.array(t) for t in total]], names=["rep", "sw", *names]
            )

    rows = df.select(row_hash32(keys, seed).alias("h"), _present(F.col(value)).alias("x")).filter("x IS NOT NULL")
    parts = rows.mapInArrow(totals, "rep bigint, sw bigint, " + ", ".join(f"{n} bigint" for n in names))
    agg = parts.groupBy("rep").agg(F.sum("sw").alias("sw"), *[F.sum(n).alias(n) for n in names])
    # the total in units of 2**-40, in decimal
    total = F.col(names[0]).cast("decimal(38,0)")
    for n in names[1:]:
        total = total * F.lit(1 << LIMB_BITS) + F.col(n).cast("decimal(38,0)")
    mean = F.try_divide(total.cast("double") / F.lit(float(2**FIXED_BITS)), F.col("sw").cast("double"))
    return agg.select("rep", mean.alias("mean"))


def bootstrap_ci(reps: DataFrame, value: str = "mean", probs: Sequence[float] = CI_PERCENTILES) -> DataFrame:
    """Exact percentiles with linear interpolation (``percentile``)."""
    lo, hi = probs
    return reps.agg(
        F.percentile(F.col(value), F.lit(float(lo))).alias("ci_lower"),
        F.percentile(F.col(value), F.lit(float(hi))).alias("ci_upper"),
    )


def comparison_summary(
    df: DataFrame,
    a_err: str = "err_a",
    b_err: str = "err_b",
    keys: Sequence[str] = ("unit", "cycle"),
    names: tuple[str, str] = ("a", "b"),
    resamples: int = BOOTSTRAP_RESAMPLES,
    seed: int = SEED,
    alpha: float = 0.05,
) -> DataFrame:
    """One row with both MAEs, the mean difference, t and Wilcoxon statistics and
    p-values, the bootstrap CI, and the winner and significance computed from them."""
    ea, eb = _present(F.col(a_err)), _present(F.col(b_err))
    d = df.select(*keys, ea.alias("_ea"), eb.alias("_eb"), (ea - eb).alias("d"))
    maes = d.agg(F.avg("_ea").alias(f"mae_{names[0]}"), F.avg("_eb").alias(f"mae_{names[1]}"), F.count(F.lit(1)).alias("n_rows"))
    t = paired_t(d).select("mean_diff", "t", "dof")
    exact = exact_signed_rank_p(F.col("n"), F.col("w"), F.col("tie_term"))
    wx = wilcoxon(d).select(F.col("w").alias("wilcoxon_w"), F.col("z").alias("wilcoxon_z"), exact.alias("_exact_p"))
    ci = bootstrap_ci(bootstrap_means(d, "d", keys, resamples, seed))
    one = one_row(maes, t, wx, ci)
    one = one.withColumn("t_pvalue", t_pvalue(F.col("t"), F.col("dof").cast("double")))
    # exact where the null distribution can be counted, else from the normal form
    one = one.withColumn("wilcoxon_pvalue", F.coalesce("_exact_p", normal_pvalue(F.col("wilcoxon_z")))).drop("_exact_p")
    significant = (F.col("t_pvalue") < alpha) & (F.col("wilcoxon_pvalue") < alpha) & ((F.col("ci_upper") < 0) | (F.col("ci_lower") > 0))
    winner = F.when(F.col("mean_diff") < 0, F.lit(names[0])).when(F.col("mean_diff") > 0, F.lit(names[1])).otherwise(F.lit("tie"))
    return one.withColumn("winner", winner).withColumn("significant", significant)
