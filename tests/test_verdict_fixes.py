"""Large values, missing values, keys, tags, early stopping, padding and session state."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearline.constants import KEPT_SENSORS
from wearline.functions.columns import feature_columns
from wearline.functions.stats import ReplicateWeights, poisson1_weight, replicate_uniform, t_two_sided
from wearline.operators import compare, projections, ranks, sequences
from wearline.operators.rolling import rolling_features
from wearline.plans import models
from wearline.sources import tables, text


def _numbered(spark, n, value):
    return spark.range(n).select(F.lit(1).alias("unit"), F.col("id").alias("cycle"), value.alias("d"))


def test_bootstrap_of_large_values_is_not_clamped(spark):
    for x in (1e9, -3.25e12, 2.0**60):
        means = [r["mean"] for r in compare.bootstrap_means(_numbered(spark, 50, F.lit(x)), resamples=40).collect()]
        assert means == [pytest.approx(x, rel=1e-12)] * 40


def test_bootstrap_refuses_what_does_not_fit(spark):
    with pytest.raises(Exception, match="2\\*\\*80"):
        compare.bootstrap_means(_numbered(spark, 5, F.lit(1e30)), resamples=5).collect()


def test_nan_is_missing_in_every_statistic(spark):
    d = _numbered(spark, 40, F.when(F.col("id") < 20, F.lit(float("nan"))).otherwise(F.lit(4.0) + F.col("id") % 2))
    clean = d.filter(~F.isnan("d"))
    assert compare.paired_t(d).first() == compare.paired_t(clean).first()
    assert compare.wilcoxon(d).first() == compare.wilcoxon(clean).first()
    one = lambda x: sorted(tuple(r) for r in compare.bootstrap_means(x, resamples=30).collect())
    assert one(d) == one(clean)


def test_numpy_weights_equal_the_column_expression(spark):
    hashes = [0, 1, 12345, 2**32 - 1, 987654321]
    rows = spark.createDataFrame([(h, r) for h in hashes for r in range(300)], "h bigint, r bigint")
    expected = {(x.h, x.r): x.w for x in rows.select("h", "r", poisson1_weight(replicate_uniform(F.col("h"), F.col("r"))).alias("w")).collect()}
    got = ReplicateWeights(300).of(np.array(hashes))
    assert all(got[i, r] == expected[h, r] for i, h in enumerate(hashes) for r in range(300))


def test_p_values_hold_for_many_degrees_of_freedom():
    for dof in (1e6, 0.99e7, 1.01e7, 1e12, 1e15):
        assert t_two_sided(2.0, dof) == pytest.approx(0.0455002638963584 * (1 + 5.93 / dof), rel=1e-8)


def test_best_round_stops_after_patience():
    falling = [100.0 / (i + 1) for i in range(40)]
    assert models.best_round(falling) == 40
    assert models.best_round([5.0, 3.0, 4.0, 4.0, 4.0, 2.0], patience=3) == 2
    assert models.best_round([5.0, 3.0, 4.0, 4.0, 2.0, 4.0], patience=3) == 5
    assert models.best_round([5.0] * 20) == 1


def test_early_stopping_keeps_the_best_prefix(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1200, 2))
    y = 10 * np.sin(x[:, 0]) + 3 * x[:, 1] + rng.normal(0, 0.3, 1200)
    rows = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "f0 double, f1 double, rul double")
    parts = rows.randomSplit([0.7, 0.3], seed=5)
    model = models.fit_early_stopped(parts[0], parts[1], ["f0", "f1"], rounds=12, depth=3)
    whole = models.fit_regressor(parts[0], ["f0", "f1"], rounds=12, depth=3)
    errors = whole.stages[-1].evaluateEachIteration(whole.stages[0].transform(parts[1]), "squared")
    assert len(model.stages[-1].trees) == models.best_round(errors) > 1


def test_untagged_files_and_large_units_stay_apart(spark, scratch):
    for name in ("plant_a", "plant_b"):
        with open(os.path.join(scratch, f"{name}.txt"), "w") as f:
            f.write("".join(f"3000000000 {c} " + " ".join(["1"] * 24) + "\n" for c in (1, 2, 3)))
    fleet = text.read_fleet(spark, os.path.join(scratch, "*.txt"))
    assert sorted((r.fleet_unit, r.n) for r in fleet.groupBy("fleet_unit").agg(F.count("*").alias("n")).collect()) == [
        ("plant_a_3000000000", 3), ("plant_b_3000000000", 3),
    ]


def test_type_suffixes_are_no_numbers(spark):
    rest = " ".join(["1"] * 22)
    lines = spark.createDataFrame([(f"1 1 1.0d 2 {rest}",), (f"1 2 1.0 2f {rest}",), (f"1 3 1.0e3 -.5 {rest}",)], "value string")
    assert [r.cycle for r in text.parse_telemetry(lines).collect()] == [3]
    assert {r.error for r in text.malformed_lines(lines).collect()} == {"bad_number"}


def test_lines_are_parsed_once_and_bad_ones_kept(spark, scratch):
    good = "1 1 " + " ".join(["1"] * 24)
    lines = spark.createDataFrame([(good,), ("not telemetry",), ("",)], "value string")
    rows, bad = text.land_lines(lines, f"{scratch}/good", f"{scratch}/bad")
    assert rows.count() == 1 and [tuple(r) for r in bad.collect()] == [("not telemetry", "field_count")]
    assert "regexp" not in rows._jdf.queryExecution().toString()


def test_csv_split_comes_back_typed(spark, scratch):
    df = spark.createDataFrame([(1, 2, 3, 0.5, "train"), (2, 1, 4, 1.5, "validation")], "unit bigint, cycle bigint, rul bigint, sensor_2 double, split string")
    tables.write_split(df, f"{scratch}/csv", fmt="csv")
    back = tables.read_split(spark, f"{scratch}/csv", "train", fmt="csv")
    assert dict(back.dtypes) == dict(df.dtypes) and back.first().sensor_2 == 0.5


def test_literal_units_need_one_key(spark):
    df = spark.createDataFrame([("a", 1, 1, 2.0)], "dataset string, unit int, cycle int, sensor_2 double")
    with pytest.raises(ValueError):
        projections.by_units(df, ["a"], ["dataset", "unit"])
    with pytest.raises(ValueError):
        projections.trajectories(df, ["a"], ["sensor_2"], ["dataset", "unit", "cycle"])


def test_ranks_leave_nothing_cached(spark):
    spark.catalog.clearCache()
    before = set(spark.sparkContext._jsc.getPersistentRDDs().keySet())
    ranks.global_row_number(spark.range(100).withColumnRenamed("id", "v"), ["v"], buckets=4).count()
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keySet()) == before


def test_short_units_give_one_padded_summary(spark):
    rows = [(1, c, 10 - c, float(c)) for c in range(1, 4)] + [(2, c, 10 - c, float(c)) for c in range(1, 8)]
    df = spark.createDataFrame(rows, "unit bigint, cycle bigint, rul bigint, sensor_2 double")
    out = sequences.window_summaries(df, ["sensor_2"], 5, short="pad").collect()
    short = [r for r in out if r.unit == 1]
    assert len(short) == 1 and short[0].padded and short[0].cycle == 3 and short[0].rul == 7
    assert short[0].sensor_2_wfirst == 1.0 and short[0].sensor_2_wmean == pytest.approx((1 + 1 + 1 + 2 + 3) / 5)
    assert sorted(r.cycle for r in out if r.unit == 2 and not r.padded) == [5, 6, 7]


def test_all_kept_sensors_make_42_features(spark):
    rows = [(1, c, *[float(c * (i + 1)) for i in range(len(KEPT_SENSORS))]) for c in range(1, 8)]
    df = spark.createDataFrame(rows, "unit bigint, cycle bigint, " + ", ".join(f"{s} double" for s in KEPT_SENSORS))
    feats = feature_columns()
    out = rolling_features(df).orderBy("cycle").collect()
    assert len(feats) == 42 and set(feats) <= set(out[0].asDict())
    assert out[-1].sensor_21_rollmean == pytest.approx(14 * 5.0) and out[0].sensor_21_rollstd is None
