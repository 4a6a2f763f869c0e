"""Registered queries: one per operator id of the inventory, over the driver's test tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column names match the
SQL in :mod:`wearline.plans.oracle`. Floating outputs are rounded to 6 places (outputs only,
never inputs) so two engines' summation orders compare equal.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.constants import FAILURE_HORIZON, RECALL_CUTOFF, SEQUENCE_LENGTH
from wearline.functions.columns import feature_columns, round_doubles, sensor_columns
from wearline.operators import compare, labels, metrics, profile, projections, rolling, sequences, splits
from wearline.operators.frames import plain
from wearline.operators.kernels import kernel_columns, kernel_features
from wearline.operators.scaling import fit_scaler, scale_features
from wearline.session import materialize, shared_path
from wearline.sources import adapters, requests, tables, text

EV = ["sensor_2", "sensor_3"]          # kept sensors carried by tele_events
PARTS = adapters.PART_SENSORS          # kept sensors carried by tele_parts
EV_FEATS = feature_columns(EV)

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared stand-in frames -------------------------------------------------------------

def _te(spark, d):
    return adapters.tele_events(spark, d)


def _labelled(spark, d):
    return labels.label_rul(_te(spark, d))


def _tagged(spark, d):
    """Labelled events with their unit's split, written once (an intermediate table, as a
    stored predictions file would be): the metric and comparison operators read it several
    times."""
    return materialize(splits.assign_split(_labelled(spark, d)))


def _split(spark, d):
    t = _tagged(spark, d)
    return t.filter(F.col("split") == splits.TRAIN).drop("split"), t.filter(F.col("split") == splits.VALIDATION).drop("split")


def _avg_life(train: DataFrame):
    """Mean lifetime of the training units, as a scalar subquery."""
    return labels.lifetimes(train).agg(F.avg("max_cycle").alias("avg_life")).scalar()


def _formula_predictions(spark, d) -> DataFrame:
    """Validation rows with two formula predictions: a = avg_life - cycle, b = avg_life / 2."""
    return _formula_predictions_of(*_split(spark, d))


def _formula_predictions_of(train: DataFrame, val: DataFrame) -> DataFrame:
    life = _avg_life(train)
    return val.select("unit", "cycle", "rul", (life - F.col("cycle")).alias("pred_a"), (F.lit(0.5) * life).alias("pred_b"))


def _errors(spark, d) -> DataFrame:
    return projections.errors(_formula_predictions(spark, d), "rul", "pred_a", "pred_b")


def _classified(spark, d) -> DataFrame:
    """Validation rows with label fail_within_30 and prob = least(1, cycle / avg_life)."""
    train, val = _split(spark, d)
    life = _avg_life(train)
    lab = labels.label_fail_within(val, FAILURE_HORIZON)
    return lab.select("unit", "cycle", F.col(f"fail_within_{FAILURE_HORIZON}").alias("label"),
                      F.least(F.lit(1.0), F.col("cycle") / life).alias("prob"))


def _rolled(spark, d) -> DataFrame:
    return rolling.rolling_features(adapters.dealt_events(spark, d), EV)


# ---- sources -----------------------------------------------------------------------------

def s1_parse_telemetry(spark, d):
    return text.parse_telemetry(adapters.tele_text(spark, d))


def s8_explode_requests(spark, d):
    return requests.explode_requests(adapters.request_records(spark, d))


def s9_build_requests(spark, d):
    r = adapters.request_records(spark, d)
    return r.select("request_id", F.size("recent_cycles").alias("cycles_used"), requests.canonical_body().alias("body"))


def p17_validate_requests(spark, d):
    r = requests.validate_requests(adapters.request_records(spark, d))
    return r.select("request_id", F.size("recent_cycles").cast("bigint").alias("cycles_used"), "error")


# ---- projections and filters -------------------------------------------------------------

def p2_tag_dataset(spark, d):
    return text.tag_dataset(_te(spark, d), "FD001")


def p6_sensor_columns(spark, d):
    te = _te(spark, d)
    return te.select("unit", "cycle", *sensor_columns(te))


def p7_feature_projection(spark, d):
    return round_doubles(projections.select_features(_rolled(spark, d), EV))


def p3_fleet_key(spark, d):
    return text.fleet_key(adapters.tele_fleet(spark, d)).select("dataset", "unit", "cycle", "fleet_unit")


def p8_drop_flat(spark, d):
    return projections.drop_flat(_te(spark, d))


def p9_unit_filter(spark, d):
    return projections.by_units(_te(spark, d), [1, 2, 3])


def p11_fail_label(spark, d):
    return labels.label_fail_within(_labelled(spark, d), FAILURE_HORIZON).select("unit", "cycle", "rul", f"fail_within_{FAILURE_HORIZON}")


def p12_impute(spark, d):
    return round_doubles(projections.impute(_rolled(spark, d), [f"{s}_rollstd" for s in EV], 0.0))


def p14_errors(spark, d):
    return round_doubles(_errors(spark, d))


def p15_classify(spark, d):
    return round_doubles(projections.classify(_classified(spark, d), "prob", RECALL_CUTOFF, "pred"))


def p16_preview(spark, d):
    return round_doubles(projections.preview(_rolled(spark, d), 10))


def p18_trajectories(spark, d):
    return projections.trajectories(_te(spark, d), [1, 2, 3], EV)


# ---- joins --------------------------------------------------------------------------------

def j1_label_rul(spark, d):
    return _labelled(spark, d)


def j2_align(spark, d):
    """Formula predictions aligned with the end rows of 30-cycle validation sequences."""
    train, val = _split(spark, d)
    preds = _formula_predictions_of(train, val).select("unit", "cycle", "pred_a")
    seq_ends = sequences.sequences(val, EV, SEQUENCE_LENGTH, short="skip").select("unit", "cycle", F.col("rul").alias("true_rul"))
    return round_doubles(compare.align(seq_ends, preds))


def j3_by_units(spark, d):
    units = splits.unit_assignment(_te(spark, d)).filter(F.col("split") == splits.VALIDATION)
    return projections.by_units(_te(spark, d), units)


def j4_without_units(spark, d):
    units = splits.unit_assignment(_te(spark, d)).filter(F.col("split") == splits.VALIDATION)
    return projections.without_units(_te(spark, d), units)


def m3_scale_features(spark, d):
    """Validation rows scaled with parameters fitted on the training units (via plans.training)."""
    p = _prepared(spark, d)
    return round_doubles(p.validation.select("unit", "cycle", *EV_FEATS))


# ---- aggregations ---------------------------------------------------------------------------

def a1_lifetimes(spark, d):
    return labels.lifetimes(_te(spark, d))


def a2_split_profile(spark, d):
    return round_doubles(profile.split_profile(_tagged(spark, d)))


def a3_profile(spark, d):
    return profile.profile(_te(spark, d))


def a4_units(spark, d):
    return profile.units(_te(spark, d))


def a6_sensor_spread(spark, d):
    return round_doubles(profile.sensor_spread(_te(spark, d), ["sensor_1", *EV]))


def a6_flat_sensors(spark, d):
    return profile.flat_sensors(_te(spark, d), ["sensor_1", *EV])


def a7_class_balance(spark, d):
    lab = labels.label_fail_within(_labelled(spark, d), FAILURE_HORIZON)
    return round_doubles(profile.class_balance(lab, f"fail_within_{FAILURE_HORIZON}"))


def a8_fit_scaler(spark, d):
    train, _ = _split(spark, d)
    rolled = rolling.rolling_features(train, EV)
    return round_doubles(fit_scaler(rolled, EV_FEATS))


def a9_regression_metrics(spark, d):
    return round_doubles(metrics.regression_metrics(_formula_predictions(spark, d), "rul", "pred_a"))


def a11_confusion(spark, d):
    c = projections.classify(_classified(spark, d), "prob", 0.5, "pred")
    return metrics.confusion(c, "label", "pred")


def a12_classification_metrics(spark, d):
    c = projections.classify(_classified(spark, d), "prob", 0.5, "pred")
    return round_doubles(metrics.classification_metrics(c, "label", "pred"))


def a13_threshold_metrics(spark, d):
    return round_doubles(metrics.threshold_metrics(_classified(spark, d), "label", "prob", [0.5, 0.3]))


def a14_roc_auc(spark, d):
    return round_doubles(metrics.roc_auc(_classified(spark, d), "prob", "label"))


def a14_roc_auc_sensor(spark, d):
    """AUC of a raw sensor as the score (many distinct scores, few ties)."""
    lab = labels.label_fail_within(_labelled(spark, d), FAILURE_HORIZON)
    return round_doubles(metrics.roc_auc(lab, "sensor_2", f"fail_within_{FAILURE_HORIZON}"))


def a15_paired_t(spark, d):
    return round_doubles(compare.paired_t(_errors(spark, d)))


def a16_wilcoxon(spark, d):
    return round_doubles(compare.wilcoxon(_errors(spark, d)))


def a16_wilcoxon_exact(spark, d):
    """Unit groups instead of rows as the pairs: few enough for the exact null distribution."""
    groups = _errors(spark, d).groupBy((F.col("unit") % 40).alias("part")).agg(F.avg("d").alias("d"))
    one = compare.wilcoxon(groups)
    return round_doubles(one.select("n", "w", compare.exact_signed_rank_p(F.col("n"), F.col("w"), F.col("tie_term")).alias("p")))


def a17_mean_diff(spark, d):
    return round_doubles(_errors(spark, d).agg(F.avg("d").alias("mean_diff")))


def a18_bootstrap_means(spark, d):
    return round_doubles(compare.bootstrap_means(_errors(spark, d)))


def a19_bootstrap_ci(spark, d):
    return round_doubles(compare.bootstrap_ci(compare.bootstrap_means(_errors(spark, d))))


def a20_comparison_summary(spark, d):
    return round_doubles(compare.comparison_summary(_errors(spark, d), names=("a", "b")))


# ---- windows ------------------------------------------------------------------------------

def w1_rolling_features(spark, d):
    return round_doubles(_rolled(spark, d))


def w3_latest_per_unit(spark, d):
    return rolling.latest_per_unit(_te(spark, d))


def w4_last_k(spark, d):
    return rolling.last_k(_te(spark, d), 5)


def w5_current_state(spark, d):
    return round_doubles(rolling.current_state(_te(spark, d), EV))


def _parts_labelled(spark, d):
    return labels.label_rul(adapters.dealt_parts(spark, d))


def w6_sequences(spark, d):
    seqs = sequences.sequences(_parts_labelled(spark, d), PARTS, SEQUENCE_LENGTH, short="skip")
    return sequences.explode_sequences(seqs, PARTS)


def w7_sequences_pad(spark, d):
    seqs = sequences.sequences(_parts_labelled(spark, d), PARTS, SEQUENCE_LENGTH, short="pad")
    return sequences.explode_sequences(seqs, PARTS)


def w8_sequence_ids(spark, d):
    seqs = sequences.sequences(_parts_labelled(spark, d), PARTS, SEQUENCE_LENGTH, short="skip")
    return seqs.select("unit", "cycle", "rul")


def m6_window_summaries(spark, d):
    ws = sequences.window_summaries(_parts_labelled(spark, d), PARTS, SEQUENCE_LENGTH)
    return round_doubles(ws.select("unit", "cycle", "rul", *sequences.summary_columns(PARTS)))


def m6_kernel_features(spark, d):
    """Convolution-kernel counts of every 30-cycle window; the level of each sensor is its mean."""
    rows = adapters.dealt_parts(spark, d)
    means = plain(rows).agg(*[F.round(F.avg(s), 6).alias(s) for s in PARTS]).first()
    feats = kernel_columns(PARTS, SEQUENCE_LENGTH, 4, {s: [0.0] for s in PARTS})
    levels = {s: [means[s]] for s in PARTS}
    return kernel_features(rows, PARTS, SEQUENCE_LENGTH, 4, levels).select("unit", "cycle", *feats)


# ---- sets ---------------------------------------------------------------------------------

def u1_union_fleet(spark, d):
    """Two fleets from separate tables: units of ``events`` by type, and parts of ``lineitem``."""
    parts = text.tag_dataset(adapters.tele_parts(spark, d).select("unit", "cycle", F.lit(None).cast("double").alias("sensor_1"), *EV), "parts")
    return text.union_fleet(adapters.tele_fleet(spark, d), parts)


def u2_split_overlap(spark, d):
    train, val = _split(spark, d)
    return splits.split_overlap(train, val).agg(F.count(F.lit(1)).alias("n_overlap"))


# ---- splits -------------------------------------------------------------------------------

def d1_split_by_unit(spark, d):
    return splits.unit_assignment(_te(spark, d))


def d1_split_hash(spark, d):
    return splits.unit_assignment(_te(spark, d), mode="hash")


def d2_early_stop_split(spark, d):
    train, _ = _split(spark, d)
    return splits.unit_assignment(train, share=0.15)


# ---- requests -----------------------------------------------------------------------------

def m5_request_features(spark, d):
    from wearline.plans.scoring import request_features

    r = adapters.request_records(spark, d)
    return round_doubles(request_features(r.select("request_id", "recent_cycles"), EV))


# ---- models (rows-only checks) -------------------------------------------------------------

def _prepared(spark, d):
    from wearline.plans.training import prepare

    return prepare(adapters.dealt_events(spark, d), EV)


# What a session has fitted, by (application, folder, kind): fitted and saved to the shared folder by
# the first query that needs it, loaded from there by the others.
_FITTED: dict[tuple[str, str, str], tuple] = {}


def _fitted(spark, d):
    """The prepared splits, where the fitted regressor is saved as a pipeline, and where as nodes."""
    from wearline.plans.ensemble import TreeEnsemble
    from wearline.plans.models import fit_regressor, save_model

    key = (spark.sparkContext.applicationId, d, "regressor")
    if key not in _FITTED:
        p, path, nodes = _prepared(spark, d), shared_path(spark, "regressor"), shared_path(spark, "ensemble")
        model = fit_regressor(p.train, p.features)
        save_model(model, path)
        TreeEnsemble.of(model).save(spark, nodes, p.params)
        _FITTED[key] = (p, path, nodes)
    return _FITTED[key]


def _regressor(spark, d):
    from wearline.plans.models import load_model

    p, path, _ = _fitted(spark, d)
    return p, load_model(path)


def _classifier(spark, d):
    """The prepared splits and the fitted classifier."""
    from wearline.plans.models import fit_classifier, load_model, save_model

    key = (spark.sparkContext.applicationId, d, "classifier")
    if key not in _FITTED:
        p, path = _fitted(spark, d)[0] if (*key[:2], "regressor") in _FITTED else _prepared(spark, d), shared_path(spark, "classifier")
        save_model(fit_classifier(labels.label_fail_within(p.train, FAILURE_HORIZON), p.features), path)
        _FITTED[key] = (p, path)
    p, path = _FITTED[key]
    return p, load_model(path)


def _ensemble(spark, d):
    from wearline.plans.ensemble import TreeEnsemble

    p, _, nodes = _fitted(spark, d)
    return p, TreeEnsemble.load(spark, nodes)


def m1_regressor_predictions(spark, d):
    from wearline.plans.models import predict_keyed

    p, model = _regressor(spark, d)
    return predict_keyed(model, p.validation)


def _same(a: str, b: str):
    return F.coalesce(F.abs(F.col(a) - F.col(b)) <= 1e-9 * F.greatest(F.abs(F.col(a)), F.lit(1.0)), F.lit(False))


def m1_compiled_predictions(spark, d):
    """Every validation row: whether the trees as an expression predict what the model predicts."""
    p, model = _regressor(spark, d)
    both = model.transform(p.validation).withColumnRenamed("prediction", "_model")
    scored = _ensemble(spark, d)[1].transform(both)
    return scored.select("unit", "cycle", _same("_model", "prediction").alias("same"))


def m2_compiled_probabilities(spark, d):
    """The classifier's probability of every validation row, against its trees as an expression."""
    from pyspark.ml.functions import vector_to_array

    from wearline.plans.ensemble import TreeEnsemble

    p, model = _classifier(spark, d)
    both = model.transform(p.validation).select("*", vector_to_array("probability")[1].alias("_model"))
    return TreeEnsemble.of(model).transform(both).select("unit", "cycle", _same("_model", "prob").alias("same"))


def m2_classifier_probabilities(spark, d):
    from wearline.plans.models import predict_proba

    p, model = _classifier(spark, d)
    return predict_proba(model, p.validation)


def a21_importance(spark, d):
    return _ensemble(spark, d)[1].importance(spark)


def a21_importance_check(spark, d):
    """Importances summed from the node table against the ones the model reports."""
    p, model = _regressor(spark, d)
    reported = model.stages[-1].featureImportances.toArray().tolist()
    own = spark.createDataFrame([(f, float(v)) for f, v in zip(p.features, reported, strict=True)], "feature string, reported double")
    return a21_importance(spark, d).join(own, "feature").select("feature", _same("reported", "importance").alias("same"))


def o2_top_order(spark, d):
    """The ranks of O2: whether the feature there, by the node table, is the one the model's vector has there."""
    p, model = _regressor(spark, d)
    reported = model.stages[-1].featureImportances.toArray().tolist()
    own = spark.createDataFrame(sorted(zip(p.features, map(float, reported), strict=True), key=lambda x: (-x[1], x[0]))[:5], "feature string, importance double")
    rank = F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature"))
    # five rows on either side
    mine = o2_top_importance(spark, d).select(rank.alias("rank"), F.col("feature").alias("own"))
    return own.select(rank.alias("rank"), "feature").join(mine, "rank").select("rank", (F.col("feature") == F.col("own")).alias("same"))


def s11_fingerprint(spark, d):
    """The saved model is loaded with the scaler of its fit and refused with another one."""
    from wearline.plans.ensemble import TreeEnsemble

    p, _, nodes = _fitted(spark, d)
    other = p.params.withColumn("mean", F.col("mean") + 1e-9)
    checks = []
    for name, params in (("own scaler", p.params), ("another scaler", other)):
        try:
            TreeEnsemble.load(spark, nodes, params)
            checks.append((name, True))
        except ValueError:
            checks.append((name, False))
    return spark.createDataFrame(checks, "scaler string, loaded boolean")


def o2_top_importance(spark, d):
    from wearline.plans.models import top_importance

    return top_importance(a21_importance(spark, d), 5)


def m4_score_fleet(spark, d):
    from wearline.plans.scoring import score_fleet

    p, model = _ensemble(spark, d)
    return score_fleet(adapters.tele_fleet(spark, d), model, p.scaler, EV, ("dataset", "unit"))


def m4_scored_units(spark, d):
    """What of M4 does not depend on the fit: the unit, its newest cycle, and that it is scored."""
    scored = m4_score_fleet(spark, d)
    return scored.select("dataset", "unit", "cycle", F.col("predicted_rul").isNotNull().alias("is_scored"))


def m5_score_requests(spark, d):
    from wearline.plans.scoring import score_requests

    p, model = _ensemble(spark, d)
    return score_requests(adapters.request_records(spark, d), model, p.scaler, EV)


def m5_scored_requests(spark, d):
    """What of M5 does not depend on the fit: readings used, error, and whether it is scored."""
    scored = m5_score_requests(spark, d)
    return scored.select("request_id", "cycles_used", "error", F.col("predicted_rul").isNotNull().alias("is_scored"))


def m5_stream_scores(spark, d):
    """M5 as a stream over request files: half of them arrive, the stream ends, the rest arrives, it is
    started again from its checkpoint, and once more with nothing new; the sink is read back."""
    from wearline.operators.scaling import scaler_literals
    from wearline.streaming.requests import read_request_stream, score_request_stream, start_scoring

    p, model = _ensemble(spark, d)
    params = scaler_literals(p.params, p.features)
    path = shared_path(spark, "request-stream")
    arriving = adapters.request_records(spark, d).select("request_id", "recent_cycles", (F.pmod(F.xxhash64("request_id"), F.lit(2))).alias("half"))
    for half in (0, 1, None):
        if half is not None:
            arriving.filter(F.col("half") == half).drop("half").write.mode("append").json(f"{path}/in")
        stream = score_request_stream(read_request_stream(spark, f"{path}/in", max_files_per_trigger=4), model, params, EV)
        start_scoring(stream, f"{path}/out", name=f"scores_{uuid.uuid4().hex}", checkpoint_location=f"{path}/checkpoint").awaitTermination()
    scored = spark.read.parquet(f"{path}/out")
    return scored.select("request_id", "cycles_used", "error", F.col("predicted_rul").isNotNull().alias("is_scored"))


def m6_kernel_predictions(spark, d):
    """Ridge regression on convolution-kernel counts of 30-cycle windows (M6)."""
    from wearline.plans.comparison import kernel_predictions

    return kernel_predictions(adapters.dealt_parts(spark, d), PARTS)


def a20_model_comparison(spark, d):
    """Trees on rolling features vs the window-summary challenger, aligned and compared."""
    from wearline.plans.comparison import model_comparison

    return round_doubles(model_comparison(adapters.dealt_parts(spark, d), PARTS, SEQUENCE_LENGTH))


def m6_challenger_predictions(spark, d):
    """Challenger on 30-cycle window summaries, early-stopped on held-out training units (M6 + M7)."""
    from wearline.plans.comparison import challenger_predictions

    return challenger_predictions(adapters.dealt_parts(spark, d), PARTS).select("unit", "cycle", "prediction")


def m8_keyed_predictions(spark, d):
    """What of M8 does not depend on the fit: the validation rows that carry a prediction."""
    return m1_regressor_predictions(spark, d).select("unit", "cycle", F.col("prediction").isNotNull().alias("is_scored"))


def a20_statistics(spark, d):
    """A20 but for its p-values (tested apart) and what follows from them."""
    return a20_comparison_summary(spark, d).drop("t_pvalue", "wilcoxon_pvalue", "significant")


# ---- tables written and read back ------------------------------------------------------------

def s2_read_fleet(spark, d):
    """Text files of one fleet, one folder for each dataset, read by one scan."""
    path = shared_path(spark, "fleet-text")
    adapters.fleet_text(spark, d).write.partitionBy("folder").text(path)
    return text.read_fleet(spark, path, pattern=r"folder=(\w+)").select("dataset", "unit", "cycle", "sensor_2", "sensor_3", "fleet_unit")


def s3_s5_split_csv(spark, d):
    """S5 as CSV, S3 back with its types: the validation rows."""
    path = shared_path(spark, "split-csv")
    tables.write_split(_tagged(spark, d), path, fmt="csv")
    return tables.read_split(spark, path, "validation", fmt="csv").select("unit", "cycle", "rul", "sensor_2", "sensor_3")


def s4_s6_predictions(spark, d):
    path = shared_path(spark, "predictions")
    tables.write_predictions(_formula_predictions(spark, d), path, pred="pred_a")
    return round_doubles(tables.read_predictions(spark, path))


def s7_scores(spark, d):
    path = shared_path(spark, "scores")
    newest = rolling.latest_per_unit(adapters.tele_fleet(spark, d), ["dataset", "unit"])
    tables.write_scores(newest.withColumnRenamed("sensor_2", "prediction"), path)
    return tables.read_scores(spark, path)


def s10_scaler_table(spark, d):
    path = shared_path(spark, "scaler")
    tables.write_scaler(a8_fit_scaler(spark, d), path)
    return tables.read_scaler(spark, path)


QUERIES: dict[str, Query] = {
    "s1_parse_telemetry": s1_parse_telemetry,
    "s8_explode_requests": s8_explode_requests,
    "s9_build_requests": s9_build_requests,
    "p17_validate_requests": p17_validate_requests,
    "p2_tag_dataset": p2_tag_dataset,
    "p6_sensor_columns": p6_sensor_columns,
    "p7_feature_projection": p7_feature_projection,
    "p3_fleet_key": p3_fleet_key,
    "p8_drop_flat": p8_drop_flat,
    "p9_unit_filter": p9_unit_filter,
    "p11_fail_label": p11_fail_label,
    "p12_impute": p12_impute,
    "p14_errors": p14_errors,
    "p15_classify": p15_classify,
    "p16_preview": p16_preview,
    "p18_trajectories": p18_trajectories,
    "j1_label_rul": j1_label_rul,
    "j2_align": j2_align,
    "j3_by_units": j3_by_units,
    "j4_without_units": j4_without_units,
    "m3_scale_features": m3_scale_features,
    "a1_lifetimes": a1_lifetimes,
    "a2_split_profile": a2_split_profile,
    "a3_profile": a3_profile,
    "a4_units": a4_units,
    "a6_sensor_spread": a6_sensor_spread,
    "a6_flat_sensors": a6_flat_sensors,
    "a7_class_balance": a7_class_balance,
    "a8_fit_scaler": a8_fit_scaler,
    "a9_regression_metrics": a9_regression_metrics,
    "a11_confusion": a11_confusion,
    "a12_classification_metrics": a12_classification_metrics,
    "a13_threshold_metrics": a13_threshold_metrics,
    "a14_roc_auc": a14_roc_auc,
    "a14_roc_auc_sensor": a14_roc_auc_sensor,
    "a15_paired_t": a15_paired_t,
    "a16_wilcoxon": a16_wilcoxon,
    "a17_mean_diff": a17_mean_diff,
    "a18_bootstrap_means": a18_bootstrap_means,
    "a19_bootstrap_ci": a19_bootstrap_ci,
    "a20_comparison_summary": a20_comparison_summary,
    "w1_rolling_features": w1_rolling_features,
    "w3_latest_per_unit": w3_latest_per_unit,
    "w4_last_k": w4_last_k,
    "w5_current_state": w5_current_state,
    "w6_sequences": w6_sequences,
    "w7_sequences_pad": w7_sequences_pad,
    "w8_sequence_ids": w8_sequence_ids,
    "m6_window_summaries": m6_window_summaries,
    "u1_union_fleet": u1_union_fleet,
    "u2_split_overlap": u2_split_overlap,
    "d1_split_by_unit": d1_split_by_unit,
    "d1_split_hash": d1_split_hash,
    "d2_early_stop_split": d2_early_stop_split,
    "m5_request_features": m5_request_features,
    "m1_regressor_predictions": m1_regressor_predictions,
    "m2_classifier_probabilities": m2_classifier_probabilities,
    "a21_importance": a21_importance,
    "o2_top_importance": o2_top_importance,
    "m4_score_fleet": m4_score_fleet,
    "m5_score_requests": m5_score_requests,
    "a20_model_comparison": a20_model_comparison,
    "m6_challenger_predictions": m6_challenger_predictions,
    "a16_wilcoxon_exact": a16_wilcoxon_exact,
    "a21_importance_check": a21_importance_check,
    "m1_compiled_predictions": m1_compiled_predictions,
    "m2_compiled_probabilities": m2_compiled_probabilities,
    "m5_stream_scores": m5_stream_scores,
    "o2_top_order": o2_top_order,
    "m6_kernel_features": m6_kernel_features,
    "m6_kernel_predictions": m6_kernel_predictions,
    "s11_fingerprint": s11_fingerprint,
    "m4_scored_units": m4_scored_units,
    "m5_scored_requests": m5_scored_requests,
    "m8_keyed_predictions": m8_keyed_predictions,
    "a20_statistics": a20_statistics,
    "s2_read_fleet": s2_read_fleet,
    "s3_s5_split_csv": s3_s5_split_csv,
    "s4_s6_predictions": s4_s6_predictions,
    "s7_scores": s7_scores,
    "s10_scaler_table": s10_scaler_table,
}
