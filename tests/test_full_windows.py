"""Windows computed batch by batch against Spark's own sliding aggregates, and what their plans hold."""

import io
import math
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.operators.frames import full_windows, own_rows
from wearline.operators.kernels import WIDTH, _sum, dilations, kernel_columns, kernel_features, kernel_places
from wearline.operators.sequences import summary_columns, window_summaries
from wearline.plans.catalog import QUERIES

N = 20


def _rows(spark):
    """Units of 1 to 90 rows, one without a key; missing, NaN and infinite readings, long flat stretches."""
    rng, rows = random.Random(7), []
    for unit in [None, *range(12)]:
        for cycle in range(1, rng.choice([1, 19, 20, 21, 45, 90]) + 1):
            a = rng.choice([None, float("nan"), float("inf"), -0.0]) if rng.random() < 0.04 else rng.gauss(1e5, 3.0)
            b = 7.7 if 10 < cycle < 60 else rng.random()
            rows.append((unit, cycle, 90 - cycle, a, b, f"x{cycle}"))
    return spark.createDataFrame(rows, "unit long, cycle long, rul long, a double, b double, note string").repartition(3)


def _plain(rows):
    bits = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(bits(v) for v in r) for r in rows)


@pytest.fixture(params=[7, 10_000])
def small_batches(spark, request):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, request.param)
    yield
    spark.conf.set(key, was)


@pytest.mark.parametrize("chunk_rows", [None, 25, 100_000])
def test_summaries_are_sparks_own_to_the_bit(spark, small_batches, chunk_rows):
    df = _rows(spark)
    w = Window.partitionBy("unit").orderBy("cycle").rowsBetween(-(N - 1), 0)
    cols = [F.count(F.lit(1)).over(w).alias("_n")]
    for s in ("a", "b"):
        cols += [
            F.first(s).over(w).alias(f"{s}_wfirst"), F.avg(s).over(w).alias(f"{s}_wmean"),
            F.stddev_samp(s).over(w).alias(f"{s}_wstd"), F.regr_slope(F.col(s), F.col("cycle").cast("double")).over(w).alias(f"{s}_wslope"),
        ]
    names = [*df.columns, *summary_columns(["a", "b"])]
    expected = df.select(*df.columns, *cols).filter(F.col("_n") == N).select(*names)
    got = window_summaries(df, ["a", "b"], N, chunk_rows=chunk_rows)
    assert got.columns == names
    assert _plain(got.collect()) == _plain(expected.collect())


@pytest.mark.parametrize("chunk_rows", [None, 25, 100_000])
def test_kernel_counts_are_those_of_sliding_sums(spark, small_batches, chunk_rows):
    df, levels = _rows(spark), {"a": [1e5], "b": [0.5, 7.7]}
    row = Window.partitionBy("unit").orderBy("cycle")
    flags, frames = {}, {}
    for s in ("a", "b"):
        for d in dilations(N):
            at = [F.lag(s, d * (WIDTH - 1 - i)).over(row) for i in range(WIDTH)]
            for j, p in enumerate(kernel_places(3)):
                flags[f"{s}_k{d}_{j}"] = F.lit(3.0) * _sum([at[i] for i in p]) > _sum(at)
                frames[f"{s}_k{d}_{j}"] = -(N - 1 - d * (WIDTH - 1))
        for i, v in enumerate(levels[s]):
            flags[f"{s}_over{i}"], frames[f"{s}_over{i}"] = F.col(s) > v, -(N - 1)
    names = kernel_columns(["a", "b"], N, 3, levels)
    flagged = df.select(*df.columns, *[flags[c].cast("int").alias(c) for c in names])
    counted = flagged.select(
        *df.columns, F.count(F.lit(1)).over(row.rowsBetween(-(N - 1), 0)).alias("_n"),
        *[F.coalesce(F.sum(c).over(row.rowsBetween(frames[c], 0)), F.lit(0)).cast("int").alias(c) for c in names],
    )
    expected = counted.filter(F.col("_n") == N).drop("_n")
    got = kernel_features(df, ["a", "b"], N, 3, levels, chunk_rows=chunk_rows)
    assert got.columns == expected.columns
    assert _plain(got.collect()) == _plain(expected.collect())


@pytest.mark.parametrize("name", ["m6_kernel_features", "m6_window_summaries"])
def test_no_aggregate_slides_over_the_window(spark, sf_small, name):
    out = io.StringIO()
    with redirect_stdout(out):
        QUERIES[name](spark, sf_small).explain()
    assert "RowFrame, -" not in out.getvalue().replace("RowFrame, -29, -29", "")
    assert "MapInArrow" in out.getvalue()


def test_an_empty_table_gives_no_window(spark):
    df = _rows(spark).limit(0)
    assert window_summaries(df, ["a"], N).count() == 0
    assert kernel_features(df, ["a"], N, 2).count() == 0


def test_windows_keep_other_columns(spark):
    frame = _rows(spark).filter("unit = 3 or unit = 4").withColumn("_own", F.lit(True)).withColumn("tags", F.array("note", F.lit(None)))
    out = T.StructType([T.StructField("k", T.IntegerType())])
    import pyarrow as pa

    got = own_rows(full_windows(frame, ["unit"], "cycle", 2, {"b": F.col("b")}, out, lambda values, starts: [pa.array(starts * 0, pa.int32())]))
    assert all(r.tags == [r.note, None] and r.k == 0 for r in got.collect())
    assert got.count() == frame.filter("cycle > 1").count()
