"""Exact evaluation metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.constants import DEFAULT_CUTOFF, RECALL_CUTOFF
from wearline.operators.ranks import ordered_prefix


def regression_metrics(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """A9 + A10: one row with ``n``, ``mae`` and ``rmse``."""
    err = F.col(truth) - F.col(pred)
    return df.agg(
        F.count(err).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
    )


def _rates(tp, fp, fn):
    precision = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    recall = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))
    return precision, recall, f1


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """``tn, fp, fn, tp`` as conditional sums, so empty cells show 0."""
    y, p = F.col(label), F.col(pred)

    def cnt(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return df.agg(
        cnt((y == 0) & (p == 0)).alias("tn"),
        cnt((y == 0) & (p == 1)).alias("fp"),
        cnt((y == 1) & (p == 0)).alias("fn"),
        cnt((y == 1) & (p == 1)).alias("tp"),
    )


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """A11 + A12: confusion counts plus precision, recall and F1 of class 1 (0 when undefined)."""
    c = confusion(df, label, pred)
    precision, recall, f1 = _rates(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select("tn", "fp", "fn", "tp", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def threshold_metrics(df: DataFrame, label: str, prob: str, cutoffs: Sequence[float] = (DEFAULT_CUTOFF, RECALL_CUTOFF)) -> DataFrame:
    """Precision / recall / F1 at each cutoff (inclusive), all cutoffs in one pass.

    Each cutoff is a literal, so the scan is read once and no row is duplicated.
    """
    y, p = F.col(label), F.col(prob)
    aggs = []
    for i, c in enumerate(cutoffs):
        hit = p >= F.lit(float(c))
        aggs += [
            F.sum(F.when(hit & (y == 1), 1).otherwise(0)).alias(f"tp{i}"),
            F.sum(F.when(hit & (y == 0), 1).otherwise(0)).alias(f"fp{i}"),
            F.sum(F.when(~hit & (y == 1), 1).otherwise(0)).alias(f"fn{i}"),
        ]
    one = df.agg(*aggs)
    rows = []
    for i, c in enumerate(cutoffs):
        tp, fp, fn = (F.coalesce(F.col(f"{k}{i}"), F.lit(0)) for k in ("tp", "fp", "fn"))
        precision, recall, f1 = _rates(tp, fp, fn)
        rows.append(F.struct(
            F.lit(float(c)).alias("cutoff"),
            tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"), fn.cast("bigint").alias("fn"),
            precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        ))
    return one.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


def roc_auc(df: DataFrame, score: str, label: str, buckets: int | None = None) -> DataFrame:
    """Exact ROC-AUC with ties (Mann-Whitney form); NULL when only one class is present.

    Rows are grouped by score (one row per distinct score, counts of positives and negatives),
    then each score's negatives-below count is a bucket-wise running sum; no step puts all
    rows, or all scores, in one task. AUC = sum(pos * (neg_below + neg / 2)) / (P * N).
    """
    g = (
        df.filter(F.col(score).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(score)
        .agg(
            F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("_pos"),
            F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("double").alias("_neg"),
        )
    )
    p = ordered_prefix(g, [score], {"neg": F.col("_neg")}, buckets)
    num = F.sum(F.col("_pos") * (F.col("neg_before") + 0.5 * F.col("_neg")))
    den = F.sum("_pos") * F.max("neg_total")
    return p.agg(F.try_divide(num, F.when(den > 0, den)).alias("roc_auc"))
