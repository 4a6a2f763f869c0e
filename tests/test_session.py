"""The shared folder on a cluster: what is named there is used, whatever its scheme."""

import pytest
from pyspark.sql import functions as F

from wearline.operators.compare import bootstrap_means
from wearline.operators.metrics import roc_auc
from wearline.session import checkpoint_dir, materialize, shared_path


@pytest.fixture
def cluster(spark, monkeypatch):
    """The session, taken for one of a standalone cluster."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://master:7077")
    return spark


def test_a_mounted_folder_is_used_on_a_cluster(cluster):
    folder = checkpoint_dir(cluster)
    assert folder.startswith("file:")
    assert shared_path(cluster, "x").startswith(f"{folder}/x-")
    df = materialize(cluster.range(100).withColumn("label", (F.col("id") >= 40).cast("int")))
    assert df.count() == 100
    assert roc_auc(df, "id", "label").first()[0] == 1.0


def test_the_bootstrap_ships_its_code(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "_wearline_shipped", False, raising=False)
    sent = []
    monkeypatch.setattr(spark.sparkContext, "addPyFile", sent.append)
    df = spark.createDataFrame([(1, 1, 0.5)], "unit long, cycle long, d double")
    bootstrap_means(df, resamples=3)
    assert len(sent) == 1
