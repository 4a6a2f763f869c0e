"""Boosting over binned rows against Spark ML's own boosting, on rows built here."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from wearline.plans import boosting, models
from wearline.plans.ensemble import node_table

FEATS = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def table(spark):
    r = np.random.default_rng(7)
    n = 3000
    x = np.c_[r.normal(size=n), r.integers(0, 7, n), r.exponential(size=n) * (r.random(n) < 0.5), np.full(n, 3.0), r.normal(size=n)]
    y = np.round(50 * x[:, 0] + 5 * x[:, 1] ** 2 + r.normal(size=n) * 10 + 100)
    k = y > r.normal(size=n) * 50 + 120
    rows = [(*map(float, row), int(a), int(b)) for row, a, b in zip(x, y, k, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, e double, y int, k int").repartition(5, "a").cache()


def _nodes(model):
    return [tuple(r) for r in node_table(model).orderBy("tree", "node").collect()]


@pytest.mark.parametrize("kind", ["regression", "classification"])
def test_the_trees_are_those_of_spark(table, kind):
    # more rounds than lie between two checkpoints
    common = dict(maxIter=12, maxDepth=4, stepSize=0.1, seed=42, featuresCol="features")
    if kind == "regression":
        own, label = models.fit_regressor(table, FEATS, "y", 12, 4), "prediction"
        estimator = GBTRegressor(labelCol="y", **common)
    else:
        own, label = models.fit_classifier(table, FEATS, "k", 12, 4), "rawPrediction"
        estimator = GBTClassifier(labelCol="k", **common)
    theirs = Pipeline(stages=[VectorAssembler(inputCols=FEATS, outputCol="features"), estimator]).fit(table)
    for a, b in zip(_nodes(own), _nodes(theirs), strict=True):
        assert a[:4] == b[:4] and a[5:7] == b[5:7] and a[4] == (b[4] and pytest.approx(b[4], rel=1e-12))
        assert a[7:] == pytest.approx(b[7:], rel=1e-6, abs=1e-6)
    found, expected = (np.array([r[0] if kind == "regression" else r[0].toArray()[1] for r in m.transform(table.orderBy(*FEATS)).select(label).collect()]) for m in (own, theirs))
    assert found == pytest.approx(expected, rel=1e-7, abs=1e-7)
    assert own.stages[-1].featureImportances.toArray() == pytest.approx(theirs.stages[-1].featureImportances.toArray(), abs=1e-7)
    assert type(own.stages[-1]) is type(theirs.stages[-1]) and own.stages[-1].getOrDefault("maxDepth") == 4


def test_the_trees_do_not_depend_on_partitions_blocks_or_groups_of_nodes(table, monkeypatch):
    whole = _nodes(models.fit_regressor(table, FEATS, "y", 3, 5))
    for name, value in (("BLOCK_ROWS", 1000), ("TASK_ROWS", 300), ("NODES_AT_ONCE", 3), ("FEW_TASKS", 1)):
        monkeypatch.setattr(boosting, name, value)
    cut = _nodes(models.fit_regressor(table.repartition(7, "b", "c"), FEATS, "y", 3, 5))
    # squares of the targets, which only the impurity shows, are not exact
    assert cut == whole


def test_rows_are_held_as_two_bytes_a_pair_of_features(table):
    """What a level of a tree reads: the codes of the pairs and a target of 8 bytes."""
    rows = table.select(*FEATS, F.col("y").cast("double"))
    thresholds = [boosting.candidates(np.array([r[0] for r in table.select(f).collect()]), 3000.0, 3000, 32) for f in FEATS]
    blocks = rows.mapInArrow(boosting._blocks(thresholds), "n int, codes binary, label binary").collect()
    assert sum(b.n for b in blocks) == 3000 and sum(len(b.codes) for b in blocks) == 3 * 2 * 3000
    assert thresholds[1].tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and not len(thresholds[3]) and len(thresholds[0]) == 31


def test_a_large_sample_gives_no_more_bins_than_fit():
    values = np.random.default_rng(3).normal(size=11_000)
    assert len(boosting.candidates(values, 10_000.0, 10**6, 32)) == 31
    assert len(boosting.candidates(values[:9_000], 10_000.0, 10**6, 32)) <= 31


def test_nothing_is_left_persisted(spark, table):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    models.fit_regressor(table, FEATS, "y", 12, 2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


@pytest.mark.parametrize("change", [None, float("nan"), float("inf")])
def test_values_that_are_no_numbers_are_refused(table, change):
    odd = F.when(F.col("b") == 3, F.lit(change).cast("double")).otherwise(F.col("e"))
    with pytest.raises(Exception, match="a feature or label to fit on is"):
        models.fit_regressor(table.withColumn("e", odd), FEATS, "y", 2, 2)


def test_odd_labels_and_tables(spark, table):
    with pytest.raises(Exception, match="labels are 0 and 1"):
        models.fit_classifier(table, FEATS, "y", 2, 2)
    with pytest.raises(ValueError, match="no rows"):
        models.fit_regressor(table.limit(0), FEATS, "y", 2, 2)
    for label in (0.0, 0.1):
        same = models.fit_regressor(table.withColumn("y", F.lit(label)), FEATS, "y", 3, 3)
        # nothing to split: a leaf a tree
        assert len(_nodes(same)) == 3 and same.transform(table.limit(1)).first().prediction == pytest.approx(label, abs=1e-9)
