"""Runnable jobs: training and fleet batch scoring, end to end on Spark.

Both take a caller's session and write to shared storage; neither collects data to the driver
beyond one row of metrics or counts. Text is parsed once, into Parquet; lines that are not
telemetry go to a quarantine table whose row count the job returns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wearline.constants import (
    BOOTSTRAP_RESAMPLES, DEFAULT_CUTOFF, FAILURE_HORIZON, KEPT_SENSORS, RECALL_CUTOFF, SEED, SEQUENCE_LENGTH, TREE_ROUNDS,
)
from wearline.operators import compare, projections
from wearline.operators.frames import deal
from wearline.operators.labels import label_fail_within
from wearline.operators.metrics import regression_metrics, roc_auc, threshold_metrics
from wearline.operators.splits import TRAIN, VALIDATION
from wearline.plans.comparison import challenger_predictions, kernel_predictions
from wearline.plans.ensemble import TreeEnsemble
from wearline.plans.models import fit_classifier, fit_regressor, importance, predict_proba, save_model
from wearline.plans.scoring import score_fleet
from wearline.plans.training import prepare
from wearline.sources.tables import read_scaler, write_predictions, write_scaler, write_scores, write_split
from wearline.sources.text import fleet_key, fleet_lines, land_lines


def train_job(
    spark: SparkSession,
    telemetry_path: str,
    out_dir: str,
    sensors: Sequence[str] = KEPT_SENSORS,
    rounds: int = TREE_ROUNDS,
    n: int = SEQUENCE_LENGTH,
    resamples: int = BOOTSTRAP_RESAMPLES,
    seed: int = SEED,
) -> DataFrame:
    """Text telemetry -> labels, rolling features, unit split, scaler -> both boosted-tree models.

    Writes under ``out_dir``: ``telemetry/`` and ``quarantine/`` (parsed once), ``model/`` and
    ``classifier/`` (pipelines), ``scaler/``, ``ensemble/`` (the regressor's nodes, scaler and their
    fingerprint, which fleet scoring loads), ``splits/`` (partitioned by split),
    ``val_predictions/``, ``class_probabilities/``, ``thresholds/`` (both cutoffs' metrics),
    ``roc_auc/``, ``importance/`` and ``classifier_importance/``, and ``comparison/`` (trees
    against the window challenger, and the error of the kernel learner, on the same rows). Returns
    the one-row validation metrics of the regressor with ``n_quarantined``, the lines that were not
    telemetry.
    """
    parsed, bad = land_lines(spark.read.text(telemetry_path), f"{out_dir}/telemetry", f"{out_dir}/quarantine")
    # long units are looked for once; labels, rolling features and both window learners share it
    telemetry = deal(parsed, "unit")
    p = prepare(telemetry, sensors, seed=seed)
    model = fit_regressor(p.train, p.features, rounds=rounds, seed=seed)
    save_model(model, f"{out_dir}/model")
    write_scaler(p.params, f"{out_dir}/scaler")
    TreeEnsemble.of(model).save(spark, f"{out_dir}/ensemble", p.params)
    tagged = p.train.withColumn("split", F.lit(TRAIN)).unionByName(p.validation.withColumn("split", F.lit(VALIDATION)))
    write_split(tagged, f"{out_dir}/splits")
    importance(model, p.features, spark).write.parquet(f"{out_dir}/importance")

    # scored once, with its target; the metrics and the comparison read what was written
    model.transform(p.validation).select("unit", "cycle", "rul", "prediction").write.parquet(f"{out_dir}/scored")
    scored = spark.read.parquet(f"{out_dir}/scored")
    write_predictions(scored, f"{out_dir}/val_predictions")

    label = f"fail_within_{FAILURE_HORIZON}"
    classifier = fit_classifier(label_fail_within(p.train, FAILURE_HORIZON), p.features, label, rounds=rounds, seed=seed)
    save_model(classifier, f"{out_dir}/classifier")
    importance(classifier, p.features, spark).write.parquet(f"{out_dir}/classifier_importance")
    labelled = label_fail_within(p.validation, FAILURE_HORIZON)
    predict_proba(classifier, labelled, ("unit", "cycle", label)).write.parquet(f"{out_dir}/class_probabilities")
    proba = spark.read.parquet(f"{out_dir}/class_probabilities")
    threshold_metrics(proba, label, "prob", [DEFAULT_CUTOFF, RECALL_CUTOFF]).write.parquet(f"{out_dir}/thresholds")
    roc_auc(proba, "prob", label).write.parquet(f"{out_dir}/roc_auc")

    challenger = challenger_predictions(telemetry, sensors, n, rounds, seed=seed).withColumnRenamed("prediction", "challenger")
    kernels = kernel_predictions(telemetry, sensors, n, seed=seed).select("unit", "cycle", F.col("prediction").alias("kernels"))
    aligned = compare.align(compare.align(challenger, scored.select("unit", "cycle", F.col("prediction").alias("tree"))), kernels)
    errs = projections.errors(aligned, "rul", "tree", "challenger", "tree_error", "challenger_error")
    errs.withColumn("kernels_error", F.abs(F.col("rul") - F.col("kernels"))).write.parquet(f"{out_dir}/errors")
    errs = spark.read.parquet(f"{out_dir}/errors")
    summary = compare.comparison_summary(errs, "tree_error", "challenger_error", names=("tree", "challenger"), resamples=resamples, seed=seed)
    summary.withColumn("mae_kernels", errs.agg(F.avg("kernels_error")).scalar()).write.parquet(f"{out_dir}/comparison")

    quarantined = bad.agg(F.count(F.lit(1)).alias("n")).scalar()
    return regression_metrics(scored, "rul", "prediction").withColumn("n_quarantined", quarantined)


def fleet_job(
    spark: SparkSession,
    fleet_paths: str | list[str],
    model_dir: str,
    out_path: str,
    sensors: Sequence[str] = KEPT_SENSORS,
) -> dict[str, int]:
    """Every fleet file in one scan -> newest state per (dataset, unit) -> scores, written
    partitioned by dataset; the parsed lines and the quarantined ones lie beside them. The model is
    the saved ensemble, which refuses a scaler that is not the one of its fit. Returns the rows
    read, the lines quarantined and the units scored."""
    landed, bad = land_lines(fleet_lines(spark, fleet_paths), f"{out_path}_telemetry", f"{out_path}_quarantine", keep=["dataset"])
    params = read_scaler(spark, f"{model_dir}/scaler")
    model = TreeEnsemble.load(spark, f"{model_dir}/ensemble", params)
    rows_seen, units_scored = Observation("rows_seen"), Observation("units_scored")
    scores = score_fleet(fleet_key(landed), model, params, sensors, ("dataset", "unit"), rows_seen=rows_seen, units_scored=units_scored)
    write_scores(scores, out_path)
    return {"rows_seen": rows_seen.get["n"], "units_scored": units_scored.get["n"], "quarantined": bad.count()}
