import math

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline.operators.rolling import current_state, last_k, latest_per_unit, rolling_features
from wearline.sources.adapters import EVENT_SENSORS, tele_events


def _plain_rolling(df, sensors, n):
    w = Window.partitionBy("unit").orderBy("cycle").rowsBetween(-(n - 1), 0)
    cols = []
    for s in sensors:
        cols += [F.avg(s).over(w).alias(f"{s}_rollmean"), F.stddev_samp(s).over(w).alias(f"{s}_rollstd")]
    return df.select(*df.columns, *cols)


def _close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if not isinstance(a, float):
        return a == b
    return math.isclose(a, b, rel_tol=tol, abs_tol=tol)


def _assert_frames_equal(got, want, keys=("unit", "cycle")):
    g = {tuple(r[k] for k in keys): r.asDict() for r in got.collect()}
    w = {tuple(r[k] for k in keys): r.asDict() for r in want.collect()}
    assert g.keys() == w.keys()
    for k, row in w.items():
        for c, v in row.items():
            assert _close(g[k][c], v), (k, c, g[k][c], v)


@pytest.mark.parametrize("chunk_rows", [None, 3, 7, 100_000])
def test_chunked_rolling_equals_plain_window(spark, sf_small, chunk_rows):
    te = tele_events(spark, sf_small)
    got = rolling_features(te, ["sensor_2", "sensor_3"], 5, chunk_rows=chunk_rows)
    want = _plain_rolling(te, ["sensor_2", "sensor_3"], 5)
    assert got.columns == want.columns
    _assert_frames_equal(got, want)


def test_chunked_rolling_with_gaps_and_sparse_chunks(spark):
    # cycles with gaps so some chunks hold fewer rows than the frame needs
    rows = [(1, c, float(c * c % 17)) for c in [1, 2, 9, 30, 31, 32, 33, 70, 140, 141, 200, 205, 206, 207, 208, 209]]
    rows += [(2, c, float(c)) for c in range(1, 40)]
    df = spark.createDataFrame(rows, "unit long, cycle long, sensor_2 double")
    got = rolling_features(df, ["sensor_2"], 5, chunk_rows=10)
    want = _plain_rolling(df, ["sensor_2"], 5)
    _assert_frames_equal(got, want)


def test_rolling_matches_pandas_min_periods_one(spark):
    pdf = pd.DataFrame({"unit": [1] * 7, "cycle": list(range(1, 8)), "sensor_2": [1.0, 4.0, 2.0, 8.0, 5.0, 7.0, 3.0]})
    df = spark.createDataFrame(pdf)
    got = rolling_features(df, ["sensor_2"], 5, chunk_rows=2).orderBy("cycle").toPandas()
    exp_mean = pdf["sensor_2"].rolling(5, min_periods=1).mean()
    exp_std = pdf["sensor_2"].rolling(5, min_periods=1).std()
    assert got["sensor_2_rollmean"].tolist() == pytest.approx(exp_mean.tolist())
    assert math.isnan(exp_std[0]) and (got["sensor_2_rollstd"][0] is None or math.isnan(got["sensor_2_rollstd"][0]))
    assert got["sensor_2_rollstd"][1:].tolist() == pytest.approx(exp_std[1:].tolist())


def test_current_state_equals_latest_of_rolling(spark, sf_small):
    te = tele_events(spark, sf_small)
    fused = current_state(te, ["sensor_2", "sensor_3"], 5)
    slow = latest_per_unit(rolling_features(te, ["sensor_2", "sensor_3"], 5))
    assert fused.columns == slow.columns
    _assert_frames_equal(fused, slow, keys=("unit",))


def test_last_k_keeps_newest_rows(spark, sf_small):
    te = tele_events(spark, sf_small)
    got = last_k(te, 5).groupBy("unit").agg(F.count("*").alias("n"), F.min("cycle").alias("lo"), F.max("cycle").alias("hi"))
    life = te.groupBy("unit").agg(F.max("cycle").alias("m"))
    bad = got.join(life, "unit").filter((F.col("n") != 5) | (F.col("hi") != F.col("m")) | (F.col("lo") != F.col("m") - 4))
    assert bad.count() == 0


def test_event_sensors_present(spark, sf_small):
    te = tele_events(spark, sf_small)
    assert te.columns == ["unit", "cycle", *EVENT_SENSORS]


def test_rolling_with_composite_fleet_key(spark, sf_small):
    from wearline.sources.adapters import tele_fleet

    tf = tele_fleet(spark, sf_small)
    got = rolling_features(tf, ["sensor_2"], 5, keys=("dataset", "unit"), chunk_rows=4)
    w = Window.partitionBy("dataset", "unit").orderBy("cycle").rowsBetween(-4, 0)
    want = tf.select(*tf.columns, F.avg("sensor_2").over(w).alias("sensor_2_rollmean"),
                     F.stddev_samp("sensor_2").over(w).alias("sensor_2_rollstd"))
    _assert_frames_equal(got, want, keys=("dataset", "unit", "cycle"))


def test_rolling_skips_missing_readings_like_pandas(spark):
    vals = [1.0, None, 4.0, 2.0, None, 8.0, 5.0]
    pdf = pd.DataFrame({"unit": [1] * 7, "cycle": list(range(1, 8)), "sensor_2": vals})
    df = spark.createDataFrame([(1, c, v) for c, v in zip(range(1, 8), vals)], "unit long, cycle long, sensor_2 double")
    got = rolling_features(df, ["sensor_2"], 5, chunk_rows=3).orderBy("cycle").toPandas()
    exp_mean = pdf["sensor_2"].rolling(5, min_periods=1).mean()
    exp_std = pdf["sensor_2"].rolling(5, min_periods=1).std()
    for g, e in zip(got["sensor_2_rollmean"], exp_mean):
        assert (pd.isna(g) and pd.isna(e)) or g == pytest.approx(e)
    for g, e in zip(got["sensor_2_rollstd"], exp_std):
        assert (pd.isna(g) and pd.isna(e)) or g == pytest.approx(e)
