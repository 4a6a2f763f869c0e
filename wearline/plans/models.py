"""Boosted-tree models with Spark ML.

Models are Spark ML's; their trees are grown by :mod:`wearline.plans.boosting`, which gives the
trees that Spark ML's own boosting gives. It persists binned rows (memory, spilling to disk)
because it rescans them, and checkpoints them to the cluster's shared ``spark.checkpoint.dir``,
which cuts lineage and lets a lost executor's work be recovered from storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.constants import PATIENCE, SEED, TREE_DEPTH, TREE_ROUNDS, TREE_STEP
from wearline.plans.boosting import fit_trees
from wearline.plans.ensemble import TreeEnsemble, pipeline_prefix
from wearline.session import checkpoint_dir

VECTOR = "features"


def _tree_kwargs(df: DataFrame, rounds: int, depth: int, step: float, seed: int) -> dict:
    checkpoint_dir(df.sparkSession)
    return dict(
        maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed, featuresCol=VECTOR, cacheNodeIds=True, checkpointInterval=10
    )


def _fit(df: DataFrame, feats: Sequence[str], estimator) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(feats), outputCol=VECTOR, handleInvalid="error")
    return PipelineModel(stages=[assembler, fit_trees(df, feats, estimator)])


def fit_regressor(
    df: DataFrame,
    feats: Sequence[str],
    label: str = "rul",
    rounds: int = TREE_ROUNDS,
    depth: int = TREE_DEPTH,
    step: float = TREE_STEP,
    seed: int = SEED,
) -> PipelineModel:
    """M1: boosted regression trees on the feature columns."""
    est = GBTRegressor(labelCol=label, predictionCol="prediction", **_tree_kwargs(df, rounds, depth, step, seed))
    return _fit(df, feats, est)


def best_round(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """The round (from 1) with the least error before ``patience`` rounds pass without a better one."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_early_stopped(
    df: DataFrame,
    held_out: DataFrame,
    feats: Sequence[str],
    label: str = "rul",
    rounds: int = TREE_ROUNDS,
    depth: int = TREE_DEPTH,
    step: float = TREE_STEP,
    seed: int = SEED,
    patience: int = PATIENCE,
) -> PipelineModel:
    """M7: boosted regression trees, kept up to the best round on ``held_out`` rows.

    All rounds are fitted once and the held-out error of each is read off; the best prefix is
    taken from the fitted trees, which are the trees that a fit of just those rounds gives.
    """
    model = fit_regressor(df, feats, label, rounds, depth, step, seed)
    vectors = model.stages[0].transform(held_out)
    errors = model.stages[-1].evaluateEachIteration(vectors, "squared")
    keep = best_round(errors, patience)
    return model if keep == rounds else pipeline_prefix(model, keep)


def fit_classifier(
    df: DataFrame,
    feats: Sequence[str],
    label: str = "fail_within_30",
    rounds: int = TREE_ROUNDS,
    depth: int = TREE_DEPTH,
    step: float = TREE_STEP,
    seed: int = SEED,
) -> PipelineModel:
    """M2: boosted classification trees with class probabilities."""
    est = GBTClassifier(labelCol=label, predictionCol="pred_default", **_tree_kwargs(df, rounds, depth, step, seed))
    return _fit(df, feats, est)


def predict_keyed(model: PipelineModel, df: DataFrame, keys: Sequence[str] = ("unit", "cycle"), out: str = "prediction") -> DataFrame:
    """M8: predictions keyed by the row key."""
    return model.transform(df).select(*keys, F.col("prediction").alias(out))


def predict_proba(model: PipelineModel, df: DataFrame, keys: Sequence[str] = ("unit", "cycle"), out: str = "prob") -> DataFrame:
    """Class-1 probability keyed by the row key (for P15, A13, A14)."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df)
    return scored.select(*keys, vector_to_array(F.col("probability"))[1].alias(out))


def importance(model: PipelineModel, feats: Sequence[str], spark=None) -> DataFrame:
    """One row per feature with its share of the gains of the trees' nodes."""
    return TreeEnsemble.of(model).importance(spark or SparkSession.getActiveSession()).filter(F.col("feature").isin(list(feats)))


def top_importance(imp: DataFrame, k: int = 10) -> DataFrame:
    """O2: the ``k`` most important features, descending (a top-k)."""
    return imp.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (assembler + trees) to a shared path."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
