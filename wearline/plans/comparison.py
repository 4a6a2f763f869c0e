"""Model comparison job: tree regressor vs sequence-window challenger on the same rows.

1. labels (J1) and rolling features (W1/W2) -> unit split (D1) -> scaler (A8/M3) -> trees (M1)
2. 30-cycle window summaries (M6 inputs) on the same units -> challenger trees, early-stopped
   on a nested 15% of training units (D2, M7); beside it, ridge regression on convolution-kernel
   counts of the same windows
3. validation predictions of both, aligned on (unit, cycle) (J2) -> absolute errors (P14)
   -> MAEs, paired t, Wilcoxon, bootstrap CI, winner (A15-A20)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.constants import (
    BOOTSTRAP_RESAMPLES, EARLY_STOP_SHARE, KEPT_SENSORS, SEED, SEQUENCE_LENGTH, TREE_ROUNDS, VALIDATION_SHARE,
)
from wearline.operators import compare, labels, projections, sequences, splits
from wearline.operators.frames import deal, is_dealt, plain
from wearline.operators.kernels import kernel_columns, kernel_features
from wearline.operators.scaling import fit_scaler
from wearline.plans.models import fit_early_stopped, fit_regressor, predict_keyed
from wearline.plans.ridge import fit_ridge
from wearline.plans.training import prepare
from wearline.session import materialize


def challenger_predictions(
    df: DataFrame,
    sensors: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    rounds: int = TREE_ROUNDS,
    share: float = VALIDATION_SHARE,
    early_stop_share: float = EARLY_STOP_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """M6 + M7 + M8: challenger fitted on training units' windows, predicting the validation
    units' full windows; ``unit, cycle, rul, prediction``.

    A training unit shorter than a window gives one window padded with its first row; a
    validation unit shorter than a window is not predicted.
    """
    labelled = labels.label_rul(df if is_dealt(df) else deal(df, "unit"))
    summaries = sequences.window_summaries(labelled, sensors, n, short="pad")
    feats = sequences.summary_columns(sensors)
    summaries = summaries.fillna(0.0, subset=feats)
    # read by the challenger's fit and by its validation predictions
    tagged = materialize(splits.assign_split(summaries, share, seed))
    train = tagged.filter(F.col("split") == splits.TRAIN).drop("split")
    val = tagged.filter((F.col("split") == splits.VALIDATION) & ~F.col("padded")).drop("split")
    es = splits.assign_split(train, early_stop_share, seed, out="_es")
    fit_on, held_out = (es.filter(F.col("_es") == s).drop("_es") for s in (splits.TRAIN, splits.VALIDATION))
    model = fit_early_stopped(fit_on, held_out, feats, rounds=rounds, seed=seed)
    return model.transform(val).select("unit", "cycle", "rul", "prediction")


def kernel_predictions(
    df: DataFrame,
    sensors: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    kernels: int = 4,
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """M6 with a learner that sees the order inside the window: convolution-kernel counts of the
    training units' full windows, ridge regression in closed form, predictions of the validation
    units' full windows; ``unit, cycle, rul, prediction``. The levels are each sensor's training
    mean and the mean plus and minus its standard deviation, to six places."""
    labelled = labels.label_rul(df if is_dealt(df) else deal(df, "unit"))
    units = materialize(splits.unit_assignment(plain(labelled), share, seed))
    train_rows = projections.without_units(plain(labelled), units.filter(F.col("split") == splits.VALIDATION))
    spread = {r["feature"]: r for r in fit_scaler(train_rows, sensors).limit(len(sensors)).collect()}
    levels = {s: [round(spread[s]["mean"] + z * spread[s]["scale"], 6) for z in (-1, 0, 1)] for s in sensors if spread[s]["mean"] is not None}
    feats = kernel_columns(sensors, n, kernels, levels)
    windows = kernel_features(labelled, sensors, n, kernels, levels).select("unit", "cycle", "rul", *feats)
    tagged = materialize(windows.join(units, "unit"))
    model = fit_ridge(tagged.filter(F.col("split") == splits.TRAIN), feats)
    return model.transform(tagged.filter(F.col("split") == splits.VALIDATION)).select("unit", "cycle", "rul", "prediction")


def model_comparison(
    df: DataFrame,
    sensors: Sequence[str] = KEPT_SENSORS,
    n: int = SEQUENCE_LENGTH,
    rounds: int = TREE_ROUNDS,
    resamples: int = BOOTSTRAP_RESAMPLES,
    seed: int = SEED,
) -> DataFrame:
    """One row comparing the two models on the validation rows both predict, with the mean absolute
    error of the kernel learner (``mae_kernels``) on the same rows."""
    df = df if is_dealt(df) else deal(df, "unit")
    p = prepare(df, sensors, seed=seed)
    trees = fit_regressor(p.train, p.features, rounds=rounds, seed=seed)
    tree_preds = predict_keyed(trees, p.validation, out="tree_pred")
    challenger = challenger_predictions(df, sensors, n, rounds, seed=seed).withColumnRenamed("prediction", "challenger_pred")
    kernels = kernel_predictions(df, sensors, n, seed=seed).select("unit", "cycle", F.col("prediction").alias("kernel_pred"))
    aligned = compare.align(compare.align(challenger, tree_preds), kernels)
    errs = projections.errors(aligned, "rul", "tree_pred", "challenger_pred", "tree_error", "challenger_error")
    # Four statistics read these rows; score both models once, not once per statistic.
    errs = materialize(errs.withColumn("kernel_error", F.abs(F.col("rul") - F.col("kernel_pred"))))
    summary = compare.comparison_summary(errs, "tree_error", "challenger_error", names=("tree", "challenger"), resamples=resamples, seed=seed)
    return summary.withColumn("mae_kernels", errs.agg(F.avg("kernel_error")).scalar())
