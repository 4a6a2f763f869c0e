"""Session-level helpers. Library code never sets ``master`` or creates a session itself."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    The context's own setting wins; otherwise the session conf is read and applied to the
    context, so ``DataFrame.checkpoint()`` and ML checkpointing write to the shared folder.
    A session on one machine gets a folder of its own where none is named; on a cluster a
    missing folder raises. The scheme does not tell whether a named one is shared: a mounted
    volume is ``file:`` too. Spark itself fails a ``checkpoint()`` of which parts are missing.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not folder and sc.master.startswith("local"):
            folder = tempfile.mkdtemp(prefix="wearline-checkpoint-", dir="/tmp")
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder


def ship(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_wearline_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="wearline-code-")), "wearline-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    sc._wearline_shipped = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame that several later jobs read, once: a reliable ``checkpoint()``.

    Lineage is cut and a lost executor's share is read back from storage rather than
    recomputed. ``localCheckpoint`` is never used, and the frame keeps its partitioning, so
    what is fitted on it does not depend on the size of the cluster.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
