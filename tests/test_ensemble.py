"""Tree ensembles as node tables, and ridge regression by exact normal equations."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wearline.plans import models, ridge
from wearline.plans.ensemble import TreeEnsemble, pipeline_prefix


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(900).select(
        "id", (F.col("id") % 23).cast("double").alias("a b"), F.sin("id").alias("b"), F.cos("id").alias("c")
    )
    return df.withColumn("y", F.col("a b") * F.col("b") + F.col("id") % 3).withColumn("k", (F.col("y") > 2).cast("double")).cache()


FEATS = ["a b", "b", "c"]


@pytest.fixture(scope="module")
def fitted(rows):
    return models.fit_regressor(rows, FEATS, "y", rounds=12, depth=4)


def _apart(df, a, b):
    return df.agg(F.max(F.abs(F.col(a) - F.col(b))), F.count(F.lit(1)), F.count(b)).first()


def test_expression_equals_the_regressor(spark, rows, fitted):
    both = TreeEnsemble.of(fitted).transform(fitted.transform(rows).withColumnRenamed("prediction", "model"))
    apart, n, scored = _apart(both, "model", "prediction")
    assert apart < 1e-9 and n == scored == 900


def test_expression_equals_the_classifier(spark, rows):
    model = models.fit_classifier(rows, FEATS, "k", rounds=6, depth=3)
    both = model.transform(rows).select("*", vector_to_array("probability")[1].alias("model"))
    ensemble = TreeEnsemble.of(model)
    apart, n, scored = _apart(ensemble.transform(both), "model", "prob")
    assert apart < 1e-9 and n == scored and ensemble.kind == "classification"
    assert ensemble.transform(both).filter("pred_default <> prediction").count() == 0


def test_missing_features_have_no_prediction(spark, fitted):
    df = spark.createDataFrame([(None, 1.0, 2.0), (1.0, 1.0, 2.0)], "`a b` double, b double, c double")
    assert [r.prediction is None for r in TreeEnsemble.of(fitted).transform(df).collect()] == [True, False]


def test_prefix_equals_a_fit_of_fewer_rounds(spark, rows, fitted):
    again = models.fit_regressor(rows, FEATS, "y", rounds=5, depth=4).transform(rows).withColumnRenamed("prediction", "refit").drop("features")
    ensemble = TreeEnsemble.of(fitted).prefix(5)
    assert ensemble.n_trees == 5 and TreeEnsemble.of(fitted).n_trees == 12
    assert _apart(ensemble.transform(again), "refit", "prediction")[0] < 1e-9
    short = pipeline_prefix(fitted, 5)
    assert len(short.stages[-1].trees) == 5
    assert _apart(short.transform(again), "refit", "prediction")[0] < 1e-9


def test_importances_equal_the_models(spark, fitted):
    own = {r.feature: r.importance for r in TreeEnsemble.of(fitted).importance(spark).collect()}
    assert [own[f] for f in FEATS] == pytest.approx(fitted.stages[-1].featureImportances.toArray().tolist(), abs=1e-9)


def test_save_load_and_fingerprint(spark, rows, fitted, scratch):
    params = spark.createDataFrame([(f, i, 0.5 * i, 1.0 + i) for i, f in enumerate(FEATS)], "feature string, pos int, mean double, scale double")
    ensemble = TreeEnsemble.of(fitted)
    ensemble.save(spark, f"{scratch}/model", params)
    assert TreeEnsemble.load(spark, f"{scratch}/model") == ensemble
    assert TreeEnsemble.load(spark, f"{scratch}/model", params.repartition(3)) == ensemble
    with pytest.raises(ValueError, match="not fitted with this scaler"):
        TreeEnsemble.load(spark, f"{scratch}/model", params.withColumn("scale", F.col("scale") * 1.0000001))
    ensemble.prefix(11).table(spark).write.mode("overwrite").parquet(f"{scratch}/model/nodes")
    with pytest.raises(ValueError, match="files were changed"):
        TreeEnsemble.load(spark, f"{scratch}/model")


def test_ridge_equals_the_direct_solution_and_any_partitioning(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 30, (400, 5))
    x[:, 3] = 7
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.integers(0, 5, 400)
    df = spark.createDataFrame([(*map(int, r), int(t)) for r, t in zip(x, y)], "a int, b int, c int, d int, e int, rul bigint")
    fits = [ridge.fit_ridge(df.repartition(n), list("abcde"), ridge=0.01) for n in (1, 3, 8)]
    assert fits[0] == fits[1] == fits[2] and fits[0].weights[3] == 0.0
    live = [0, 1, 2, 4]
    z = (x[:, live] - x[:, live].mean(0)) / x[:, live].std(0)
    w = np.linalg.solve(z.T @ z / 400 + 0.01 * np.eye(4), z.T @ (y - y.mean()) / 400) / x[:, live].std(0)
    assert [fits[0].weights[i] for i in live] == pytest.approx(w.tolist(), rel=1e-9)
    want = y.mean() + (x[:, live] - x[:, live].mean(0)) @ w
    assert [r.prediction for r in fits[0].transform(df).collect()] == pytest.approx(want.tolist(), rel=1e-9)


def test_gram_is_exact_and_refuses_what_does_not_fit(spark):
    df = spark.createDataFrame([(2**22, None), (-3, 5)], "a bigint, b bigint")
    assert {(r.i, r.j): int(r.s) for r in ridge.gram(df, ["a", "b"]).collect()} == {(0, 0): 2**44 + 9, (0, 1): -15, (1, 1): 25}
    with pytest.raises(Exception, match="2\\*\\*23"):
        ridge.gram(spark.createDataFrame([(2**23,)], "a bigint"), ["a"]).collect()
