"""Parquet/CSV readers and writers for splits, predictions, scores and scaler tables.

Writers produce directories of part files (never ``coalesce(1)``), readers take explicit
schemas (no inference pass).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A scaler table with more rows than this is not one.
MAX_FEATURES = 100_000

PREDICTIONS = T.StructType([
    T.StructField("unit", T.LongType()), T.StructField("cycle", T.LongType()), T.StructField("prediction", T.DoubleType()),
])
SCORES = T.StructType([
    T.StructField("dataset", T.StringType()), T.StructField("unit", T.LongType()),
    T.StructField("cycle", T.LongType()), T.StructField("predicted_rul", T.DoubleType()),
])
def split_schema(columns: Sequence[str], split: str = "split") -> T.StructType:
    """Types of a split's columns: keys and target whole numbers, tags text, all else double."""
    whole, words = {"unit", "cycle", "rul", "max_cycle"}, {"dataset", "fleet_unit", split}
    kind = lambda c: T.LongType() if c in whole else T.StringType() if c in words else T.DoubleType()
    return T.StructType([T.StructField(c, kind(c)) for c in columns])


SCALER = T.StructType([
    T.StructField("feature", T.StringType()), T.StructField("pos", T.IntegerType()),
    T.StructField("mean", T.DoubleType()), T.StructField("scale", T.DoubleType()),
])


def _reader(spark: SparkSession, schema: T.StructType | None, fmt: str):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    return r.format(fmt)


def write_split(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet") -> None:
    """One dataset partitioned by split, so a reader of one split prunes the other."""
    w = df.write.mode("overwrite").partitionBy(split).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def read_split(spark: SparkSession, path: str, which: str | None = None, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """S3: a written split; ``which`` becomes a partition filter.

    CSV carries no types: without a ``schema`` the header names the columns and
    :func:`split_schema` gives their types.
    """
    if schema is None and fmt == "csv":
        schema = split_schema(spark.read.option("header", True).csv(path).columns)
    df = _reader(spark, schema, fmt).load(path)
    return df if which is None else df.filter(F.col("split") == which)


def write_predictions(df: DataFrame, path: str, keys: Sequence[str] = ("unit", "cycle"), pred: str = "prediction", fmt: str = "parquet") -> None:
    """``unit, cycle, prediction``."""
    out = df.select(*[F.col(k).cast("bigint") for k in keys], F.col(pred).cast("double").alias("prediction"))
    w = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def read_predictions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S4."""
    return _reader(spark, PREDICTIONS, fmt).load(path)


def score_table(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """P13 + S7 layout: ``dataset, unit, cycle`` as integers, ``predicted_rul`` double."""
    return df.select(
        F.col("dataset").cast("string"), F.col("unit").cast("bigint"), F.col("cycle").cast("bigint"),
        F.col(pred).cast("double").alias("predicted_rul"),
    )


def write_scores(df: DataFrame, path: str, pred: str = "prediction", fmt: str = "parquet") -> None:
    """Fleet predictions as a directory, partitioned by dataset (takes raw model output
    with a ``prediction`` column or an already formatted score table)."""
    if pred not in df.columns and "predicted_rul" in df.columns:
        pred = "predicted_rul"
    w = score_table(df, pred).write.mode("overwrite").partitionBy("dataset").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def read_scores(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _reader(spark, SCORES, fmt).load(path)


def write_scaler(params: DataFrame, path: str) -> None:
    """The fitted ``feature, pos, mean, scale`` table; ``pos`` keeps the feature order."""
    params.select("feature", F.col("pos").cast("int"), "mean", "scale").write.mode("overwrite").parquet(path)


def read_scaler(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCALER).parquet(path)


def feature_order(params: DataFrame) -> list[str]:
    """The stored feature order (one row per feature, a proven bound)."""
    rows = params.select("feature", "pos").orderBy("pos").limit(MAX_FEATURES + 1).collect()
    if len(rows) > MAX_FEATURES:
        raise ValueError(f"a scaler table of more than {MAX_FEATURES} features")
    return [r["feature"] for r in rows]
