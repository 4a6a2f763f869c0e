"""Frames of long units: ranges, tails, cycle numbers and labels equal the plain per-unit forms."""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline.constants import SEQUENCE_LENGTH
from wearline.functions.columns import round_doubles
from wearline.operators import frames, labels, rolling, sequences
from wearline.operators.kernels import kernel_columns, kernel_features
from wearline.plans.catalog import QUERIES
from wearline.sources import adapters


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def _hot(spark):
    """Unit 0 holds 60 % of the rows, with gaps between its cycles; one unit's key is null."""
    hot = spark.range(1200).select(F.lit(0).cast("bigint").alias("unit"), (F.col("id") * F.col("id") % 7 + F.col("id") * 9).alias("cycle"))
    cold = spark.range(760).select((F.col("id") % 38 + 1).alias("unit"), (F.floor(F.col("id") / 38) + 1).cast("bigint").alias("cycle"))
    none = spark.range(40).select(F.lit(None).cast("bigint").alias("unit"), F.col("id").alias("cycle"))
    return hot.unionByName(cold).unionByName(none).withColumn("sensor_2", F.round(F.sin(F.col("cycle") * 1.3 + F.coalesce("unit", F.lit(5))), 3))


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("name", ["w1_rolling_features", "w6_sequences", "w7_sequences_pad", "w8_sequence_ids", "m6_window_summaries", "m6_kernel_features"])
def test_one_scan_and_one_shuffle(spark, sf_small, name):
    tree = _plan(QUERIES[name](spark, sf_small))
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") == 1 and "Join" not in tree


def test_a_hot_unit_is_split_with_one_shuffle_of_the_data(spark):
    df = _hot(spark)
    dealt = frames.deal(df, "unit", "cycle", 100)
    sizes = {(r.unit, r._chunk): r["count"] for r in dealt.groupBy("unit", "_chunk").count().collect()}
    assert max(sizes.values()) <= 100 and len([k for k in sizes if k[0] == 0]) == 12
    tree = _plan(rolling.rolling_features(labels.label_rul(dealt), ["sensor_2"]))
    # the ranges' tails are a small table; its rows are the only other ones that move
    assert tree.count("Exchange hash") + tree.count("- Exchange") <= 2 and tree.count("Window") >= 1
    tails = frames.chunk_frames(dealt, "unit", "cycle", 4)[0].filter("NOT _own")
    assert tails.count() == 11 * 4


@pytest.mark.parametrize("rows", [7, 100, 1000])
def test_dealt_frames_equal_plain_windows(spark, rows):
    df = _hot(spark)
    dealt = frames.deal(df, "unit", "cycle", rows)
    plain = Window.partitionBy("unit").orderBy("cycle")
    want = df.withColumn("rul", F.max("cycle").over(Window.partitionBy("unit")) - F.col("cycle"))
    _same(frames.plain(labels.label_rul(dealt)), want)
    got = round_doubles(rolling.rolling_features(labels.label_rul(dealt), ["sensor_2"], 5), 9)
    w = plain.rowsBetween(-4, 0)
    _same(got, round_doubles(want.withColumn("sensor_2_rollmean", F.avg("sensor_2").over(w)).withColumn("sensor_2_rollstd", F.stddev_samp("sensor_2").over(w)), 9))
    for short in ("skip", "pad"):
        a = sequences.sequences(labels.label_rul(dealt), ["sensor_2"], 30, short=short)
        _same(a, sequences.sequences(want, ["sensor_2"], 30, short=short, chunk_rows=None))


def test_cycles_are_numbered_across_ranges(spark):
    df = _hot(spark).withColumnRenamed("cycle", "at")
    dealt = frames.number_cycles(frames.deal(df, "unit", "at", 50), "unit", ["at"])
    want = df.withColumn("cycle", F.row_number().over(Window.partitionBy("unit").orderBy("at")).cast("bigint"))
    _same(frames.plain(dealt), want)
    _same(frames.plain(labels.label_rul(dealt)), want.withColumn("rul", F.max("cycle").over(Window.partitionBy("unit")) - F.col("cycle")))


def test_equal_order_values_stay_in_one_range(spark):
    df = spark.range(500).select(F.lit("u").alias("unit"), F.floor(F.col("id") / 40).alias("at"), F.col("id").alias("n"))
    dealt = frames.number_cycles(frames.deal(df, "unit", "at", 60), "unit", ["at", "n"])
    assert dealt.groupBy("at").agg(F.countDistinct("_chunk").alias("c")).filter("c > 1").count() == 0
    assert dealt.filter("cycle <> n + 1").count() == 0


def test_dealt_views_equal_the_plain_ones(spark, sf_small, monkeypatch):
    monkeypatch.setattr(adapters, "deal", lambda df, keys, order: frames.deal(df, keys, order, 20))
    for dealt, plain in ((adapters.dealt_events, adapters.tele_events), (adapters.dealt_parts, adapters.tele_parts)):
        frame = dealt(spark, sf_small)
        assert frame.select("_chunk").distinct().count() > 1
        _same(frames.plain(frame), plain(spark, sf_small))


def test_kernel_features_of_a_split_unit_equal_the_plain_ones(spark):
    df = _hot(spark)
    levels = {"sensor_2": [-0.5, 0.25]}
    got = kernel_features(df, ["sensor_2"], SEQUENCE_LENGTH, 3, levels, chunk_rows=45)
    assert got.columns == [*df.columns, *kernel_columns(["sensor_2"], SEQUENCE_LENGTH, 3, levels)]
    _same(got, kernel_features(df, ["sensor_2"], SEQUENCE_LENGTH, 3, levels, chunk_rows=None))


def test_kernel_features_equal_numpy(spark):
    import numpy as np

    from wearline.operators.kernels import dilations, kernel_places

    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=50), 2)
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "unit int, cycle int, a double")
    rows = {r.cycle: r for r in kernel_features(df, ["a"], 30, 4, {"a": [0.1]}).collect()}
    assert sorted(rows) == list(range(29, 50))
    for t, r in rows.items():
        w = x[t - 29 : t + 1]
        assert r.a_over0 == (w > 0.1).sum()
        for d in dilations(30):
            for j, heavy in enumerate(kernel_places(4)):
                kernel = np.full(9, -1.0)
                kernel[list(heavy)] = 2.0
                sums = [(kernel * w[i : i + 8 * d + 1 : d]).sum() for i in range(30 - 8 * d)]
                assert abs(r[f"a_k{d}_{j}"] - sum(s > 0 for s in sums)) <= sum(abs(s) < 1e-9 for s in sums)
