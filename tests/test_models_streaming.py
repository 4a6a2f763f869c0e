import json
import os

import pytest
from pyspark.sql import functions as F

from wearline.constants import ALL_SENSORS
from wearline.operators.rolling import current_state
from wearline.operators.scaling import scaler_literals
from wearline.plans import models
from wearline.plans.scoring import request_features, score_fleet, score_requests
from wearline.plans.training import prepare
from wearline.sources.adapters import request_records, tele_events, tele_fleet
from wearline.streaming.requests import read_request_stream, score_request_stream, start_scoring

EV = ["sensor_2", "sensor_3"]


@pytest.fixture(scope="module")
def fitted(spark, sf_small):
    p = prepare(tele_events(spark, sf_small), EV)
    model = models.fit_regressor(p.train, p.features, rounds=5)
    return p, model


def test_prepare_splits_are_disjoint_and_scaled(spark, sf_small, fitted):
    p, _ = fitted
    tu = {r.unit for r in p.train.select("unit").distinct().collect()}
    vu = {r.unit for r in p.validation.select("unit").distinct().collect()}
    assert tu and vu and not (tu & vu)
    means = p.train.agg(*[F.avg(c).alias(c) for c in p.features]).first().asDict()
    assert all(abs(v) < 1e-9 for v in means.values())
    assert p.validation.filter(F.greatest(*[F.col(c).isNull() for c in p.features])).count() == 0


def test_regressor_predicts_every_validation_row(spark, fitted):
    p, model = fitted
    preds = models.predict_keyed(model, p.validation)
    assert preds.count() == p.validation.count()
    assert preds.filter(F.col("prediction").isNull()).count() == 0


def test_model_save_load_round_trip(spark, fitted, scratch):
    p, model = fitted
    path = os.path.join(scratch, "model")
    models.save_model(model, path)
    again = models.load_model(path)
    a = models.predict_keyed(model, p.validation).orderBy("unit", "cycle").collect()
    b = models.predict_keyed(again, p.validation).orderBy("unit", "cycle").collect()
    assert a == b


def test_importance_and_top_k(spark, fitted):
    p, model = fitted
    imp = models.importance(model, p.features, spark)
    assert imp.count() == len(p.features)
    assert abs(sum(r.importance for r in imp.collect()) - 1.0) < 1e-9
    top = models.top_importance(imp, 3).collect()
    assert len(top) == 3 and top[0].importance >= top[-1].importance


def test_classifier_probabilities(spark, fitted):
    p, _ = fitted
    from wearline.operators.labels import label_fail_within

    clf = models.fit_classifier(label_fail_within(p.train), p.features, rounds=3)
    probs = models.predict_proba(clf, p.validation).collect()
    assert probs and all(0.0 <= r.prob <= 1.0 for r in probs)


def test_fleet_scoring_one_row_per_unit(spark, sf_small, fitted):
    p, model = fitted
    fleet = tele_fleet(spark, sf_small)
    scores = score_fleet(fleet, model, p.params, EV, ("dataset", "unit"))
    assert scores.columns == ["dataset", "unit", "cycle", "predicted_rul"]
    assert scores.count() == fleet.select("dataset", "unit").distinct().count()


def test_request_features_equal_rolling_at_last_row(spark, sf_small):
    te = tele_events(spark, sf_small)
    req = request_records(spark, sf_small)
    got = {r.request_id: r for r in request_features(req.select("request_id", "recent_cycles"), EV).collect()}
    want = current_state(te, EV).collect()
    assert len(got) == len(want)
    for w in want:
        g = got[str(w.unit)]
        for c in ("sensor_2", "sensor_2_rollmean", "sensor_2_rollstd", "sensor_3_rollmean", "sensor_3_rollstd"):
            assert g[c] == pytest.approx(w[c], rel=1e-9, abs=1e-9)


def test_score_requests_keeps_invalid_rows(spark, sf_small, fitted):
    p, model = fitted
    req = request_records(spark, sf_small).select("request_id", "recent_cycles")
    bad = spark.createDataFrame([("too_long", [{s: 1.0 for s in ALL_SENSORS}] * 6), ("none", [])], req.schema)
    out = {r.request_id: r for r in score_requests(req.unionByName(bad), model, p.params, EV).collect()}
    assert out["too_long"].error == "too_many_readings" and out["too_long"].predicted_rul is None
    assert out["none"].error == "empty"
    good = [r for k, r in out.items() if k not in ("too_long", "none")]
    assert good and all(r.error is None and r.predicted_rul is not None and r.cycles_used == 5 for r in good)


def test_streaming_request_scoring_matches_batch(spark, sf_small, fitted, scratch):
    p, model = fitted
    req = request_records(spark, sf_small).select("request_id", "recent_cycles")
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    rows = [r.asDict(recursive=True) for r in req.collect()]
    with open(os.path.join(src, "part-0.json"), "w") as fh:
        for r in rows:
            fh.write(json.dumps(r) + "\n")
    lits = scaler_literals(p.params, p.features)
    stream = read_request_stream(spark, src)
    q = start_scoring(score_request_stream(stream, model, lits, EV), os.path.join(scratch, "out"),
                      checkpoint_location=os.path.join(scratch, "ckpt"))
    q.awaitTermination(120)
    streamed = {r.request_id: r.predicted_rul for r in spark.read.parquet(os.path.join(scratch, "out")).collect()}
    batch = {r.request_id: r.predicted_rul for r in score_requests(req, model, lits, EV).collect()}
    assert streamed.keys() == batch.keys()
    for k, v in batch.items():
        assert streamed[k] == pytest.approx(v)


def test_fleet_scoring_counts_by_observation(spark, sf_small, fitted, scratch):
    from pyspark.sql import Observation

    from wearline.sources.tables import write_scores

    p, model = fitted
    fleet = tele_fleet(spark, sf_small)
    rows_seen, units_scored = Observation("rows"), Observation("units")
    scores = score_fleet(fleet, model, p.params, EV, ("dataset", "unit"), rows_seen=rows_seen, units_scored=units_scored)
    write_scores(scores, os.path.join(scratch, "scores"))
    assert rows_seen.get["n"] == fleet.count()
    assert units_scored.get["n"] == fleet.select("dataset", "unit").distinct().count()


def test_train_then_fleet_jobs_on_text_files(spark, sf_small, scratch):
    from wearline.plans.jobs import fleet_job, train_job
    from wearline.sources.adapters import tele_text
    from wearline.sources.tables import read_scaler, read_scores, write_scaler

    text = tele_text(spark, sf_small)
    text.write.mode("overwrite").text(os.path.join(scratch, "train_FD001.txt"))
    text.write.mode("overwrite").text(os.path.join(scratch, "test_FD001.txt"))
    text.write.mode("overwrite").text(os.path.join(scratch, "test_FD002.txt"))
    metrics = train_job(spark, os.path.join(scratch, "train_FD001.txt"), os.path.join(scratch, "out"), EV, rounds=3).first()
    assert metrics.n > 0 and metrics.mae >= 0
    counts = fleet_job(spark, os.path.join(scratch, "test_FD00*.txt"), os.path.join(scratch, "out"),
                       os.path.join(scratch, "scores"), EV)
    n_units = tele_events(spark, sf_small).select("unit").distinct().count()
    assert counts == {"rows_seen": 2 * text.count(), "units_scored": 2 * n_units, "quarantined": 0}
    assert metrics.n_quarantined == 0
    read = lambda name: spark.read.parquet(os.path.join(scratch, "out", name))
    assert read("comparison").first().mae_kernels > 0
    write_scaler(read_scaler(spark, os.path.join(scratch, "out", "scaler")).withColumn("mean", F.col("mean") + 1), os.path.join(scratch, "out", "scaler2"))
    os.rename(os.path.join(scratch, "out", "scaler"), os.path.join(scratch, "out", "scaler1"))
    os.rename(os.path.join(scratch, "out", "scaler2"), os.path.join(scratch, "out", "scaler"))
    with pytest.raises(ValueError, match="not fitted with this scaler"):
        fleet_job(spark, os.path.join(scratch, "test_FD00*.txt"), os.path.join(scratch, "out"), os.path.join(scratch, "refused"), EV)
    assert read("thresholds").count() == 2 and read("roc_auc").count() == 1 and read("comparison").count() == 1
    assert read("importance").count() == read("classifier_importance").count() == 6
    scores = read_scores(spark, os.path.join(scratch, "scores"))
    assert sorted(r.dataset for r in scores.select("dataset").distinct().collect()) == ["FD001", "FD002"]
