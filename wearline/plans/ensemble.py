"""Fitted tree ensembles as node tables and column expressions.

A fitted model's saved trees are read once into a flat node table, one row a node: at most rounds
times 2^(depth+1) rows, whatever the data. From it come

* a column expression (nested ``CASE`` of each tree, weighted and summed), so scoring is a
  projection in the JVM without assembling vectors;
* the ensemble's first rounds, without fitting them again;
* importances, as sums of the gains of the nodes that split on a feature;
* a fingerprint of nodes and scaler, which is saved beside them and checked at load.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.session import shared_path
from wearline.sources.tables import SCALER, read_scaler, write_scaler

_WHOLE, _REAL, _WORD = T.IntegerType(), T.DoubleType(), T.StringType()
_TYPES = {
    "tree": _WHOLE, "weight": _REAL, "node": _WHOLE, "feature": _WORD, "threshold": _REAL, "left": _WHOLE, "right": _WHOLE,
    "prediction": _REAL, "gain": _REAL, "rows": _REAL,
}
NODES = T.StructType([T.StructField(c, k) for c, k in _TYPES.items()])
_ABOUT = T.StructType([T.StructField("kind", _WORD), T.StructField("features", T.ArrayType(_WORD)), T.StructField("fingerprint", _WORD)])
REGRESSION, CLASSIFICATION = "regression", "classification"


def _saved(model: PipelineModel) -> str:
    """Where the trees of a pipeline's last stage are saved in the shared folder."""
    path = shared_path(SparkSession.getActiveSession(), "trees")
    model.stages[-1].write().save(path)
    return path


def node_table(model: PipelineModel) -> DataFrame:
    """The nodes of a fitted pipeline (assembler, boosted trees); leaves have no feature."""
    spark = SparkSession.getActiveSession()
    feats = model.stages[0].getInputCols()
    path = _saved(model)
    # one row a tree: its number, its parameters, its weight
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "about", "weight").drop("about")
    names = F.array(*[F.lit(f) for f in feats])
    n = "nodeData"
    inner = F.col(f"{n}.leftChild") >= 0
    # a tree's nodes are few: the weights reach them by an ordinary join of two model tables
    nodes = spark.read.parquet(f"{path}/data").withColumnRenamed("treeID", "tree").join(weights, "tree")
    return nodes.select(
        F.col("tree").cast("int"),
        "weight",
        F.col(f"{n}.id").cast("int").alias("node"),
        F.when(inner, F.get(names, F.col(f"{n}.split.featureIndex"))).alias("feature"),
        F.when(inner, F.get(F.col(f"{n}.split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.col(f"{n}.leftChild").cast("int").alias("left"),
        F.col(f"{n}.rightChild").cast("int").alias("right"),
        F.col(f"{n}.prediction").alias("prediction"),
        F.col(f"{n}.gain").alias("gain"),
        F.get(F.col(f"{n}.impurityStats"), F.lit(0)).alias("rows"),
    )


def fingerprint(nodes: DataFrame, params: DataFrame) -> Column:
    """A hash of all nodes and of the scaler's rows, as a scalar: any other fit has another one."""

    def digest(df: DataFrame, columns: Sequence[str]) -> Column:
        row = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]))
        return df.select(row.alias("h")).agg(F.sha2(F.concat_ws("", F.sort_array(F.collect_list("h"))), 256).alias("h")).scalar()

    return F.sha2(F.concat(digest(nodes, NODES.names), digest(params, SCALER.names)), 256)


def _number(x: float) -> str:
    """A double literal of exactly this value."""
    return f"{x!r}D"


@dataclass(frozen=True)
class TreeEnsemble:
    """A fitted ensemble as its nodes."""

    kind: str
    features: tuple[str, ...]
    nodes: tuple[Row, ...]

    @classmethod
    def of(cls, model: PipelineModel) -> TreeEnsemble:
        kind = CLASSIFICATION if isinstance(model.stages[-1], GBTClassificationModel) else REGRESSION
        return cls(kind, tuple(model.stages[0].getInputCols()), tuple(node_table(model).orderBy("tree", "node").collect()))

    @property
    def n_trees(self) -> int:
        return len({r.tree for r in self.nodes})

    def prefix(self, rounds: int) -> TreeEnsemble:
        """The ensemble's first ``rounds`` trees."""
        return replace(self, nodes=tuple(r for r in self.nodes if r.tree < rounds))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.nodes), NODES)

    def raw(self) -> Column:
        """The weighted sum of the trees: a value goes left where it is at most the threshold, NaN goes
        right; NULL where a feature is missing.

        The test for missing features is a function on an array, which keeps the projection out of
        whole-stage code: that would put all trees into one method beyond the size the JVM
        compiles, while a projection of its own is split into one small method for each part.
        """
        trees: dict[int, dict[int, Row]] = defaultdict(dict)
        for r in self.nodes:
            trees[r.tree][r.node] = r

        def walk(tree: dict[int, Row], at: int) -> str:
            r = tree[at]
            if r.left < 0:
                return _number(r.prediction)
            name = r.feature.replace("`", "``")
            return f"CASE WHEN `{name}` <= {_number(r.threshold)} THEN {walk(tree, r.left)} ELSE {walk(tree, r.right)} END"

        # one text a tree: nested brackets around many of them are slow to parse
        parts = [F.lit(tree[0].weight) * F.expr(walk(tree, 0)) for _, tree in sorted(trees.items())]
        # summed in halves, so that the expression is no deeper than needed
        while len(parts) > 1:
            parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
        missing = F.exists(F.array(*[F.col(f).cast("double") for f in self.features]), lambda x: x.isNull())
        return F.when(~missing, parts[0])

    def probability(self) -> Column:
        """Class 1's probability: 1 / (1 + exp(-2 margin))."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * self.raw()))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` (regression), or ``prob`` and ``prediction`` (classes)."""
        if self.kind == REGRESSION:
            return df.withColumn("prediction", self.raw())
        return df.withColumn("prob", self.probability()).withColumn("prediction", (F.col("prob") > 0.5).cast("double"))

    def importance(self, spark: SparkSession) -> DataFrame:
        """``feature, importance`` of every feature: gains times rows of the nodes that split on
        it, summed over all trees and normalised."""
        gains = self.table(spark).filter("feature IS NOT NULL").groupBy("feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
        total = gains.agg(F.sum("g")).scalar()
        names = spark.createDataFrame([(f,) for f in self.features], "feature string")
        return names.join(gains, "feature", "left").select("feature", F.coalesce(F.try_divide(F.col("g"), total), F.lit(0.0)).alias("importance"))

    def save(self, spark: SparkSession, path: str, params: DataFrame) -> None:
        """Nodes, scaler and their fingerprint."""
        self.table(spark).write.parquet(f"{path}/nodes")
        write_scaler(params, f"{path}/scaler")
        about = spark.range(1).select(
            F.lit(self.kind).alias("kind"),
            F.array(*[F.lit(f) for f in self.features]).alias("features"),
            fingerprint(spark.read.schema(NODES).parquet(f"{path}/nodes"), read_scaler(spark, f"{path}/scaler")).alias("fingerprint"),
        )
        about.write.parquet(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str, params: DataFrame | None = None) -> TreeEnsemble:
        """The saved ensemble. ``params``, the scaler that is going to feed it (by default the one saved
        with it), must be the one of its fit: else, or where a file was changed, this raises."""
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes")
        scaler = read_scaler(spark, f"{path}/scaler") if params is None else params.select(*[F.col(f.name).cast(f.dataType) for f in SCALER])
        about = spark.read.schema(_ABOUT).parquet(f"{path}/about").withColumn("now", fingerprint(nodes, scaler)).first()
        if about is None or about.now != about.fingerprint:
            raise ValueError(f"the model at {path} was not fitted with this scaler, or its files were changed")
        return cls(about.kind, tuple(about.features), tuple(nodes.orderBy("tree", "node").collect()))


def pipeline_prefix(model: PipelineModel, rounds: int) -> PipelineModel:
    """A fitted regressor's first ``rounds`` trees as a pipeline, read from its saved trees."""
    spark = SparkSession.getActiveSession()
    path, out = _saved(model), shared_path(spark, "prefix")
    about = json.loads(spark.read.text(f"{path}/metadata").first().value)
    about["numTrees"] = rounds
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    for part in ("data", "treesMetadata"):
        rows = spark.read.parquet(f"{path}/{part}")
        # the tree's number comes first in both
        rows.filter(F.col(rows.columns[0]) < rounds).write.parquet(f"{out}/{part}")
    return PipelineModel(stages=[*model.stages[:-1], GBTRegressionModel.load(out)])
