import fractions
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wearline.functions import stats
from wearline.operators import compare, labels, metrics, profile, projections, ranks, scaling, sequences, splits
from wearline.sources.adapters import tele_events, tele_parts


# ---- ranks ---------------------------------------------------------------------------------

@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_global_row_number_equals_window(spark, buckets):
    rng = random.Random(7)
    rows = [(float(rng.randint(0, 50)), i) for i in range(400)]
    df = spark.createDataFrame(rows, "v double, id long")
    got = {r.id: (r.rn, r.rn_total) for r in ranks.global_row_number(df, ["v", "id"], buckets=buckets).collect()}
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(Window.orderBy("v", "id")).alias("rn")).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert {v[1] for v in got.values()} == {400}


def test_ordered_prefix_with_fixed_bounds(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(50)], "k double, w double")
    out = {r.k: r.w_before for r in ranks.ordered_prefix(df, ["k"], {"w": F.col("w")}, bounds=[10.0, 25.0]).collect()}
    assert out == {float(i): float(sum(j % 3 for j in range(i))) for i in range(50)}


# ---- labels, splits, profiles -----------------------------------------------------------------

def test_label_rul_and_horizon(spark):
    df = spark.createDataFrame([(1, c) for c in range(1, 41)] + [(2, c) for c in range(5, 9)], "unit long, cycle long")
    lab = labels.label_fail_within(labels.label_rul(df), 30)
    got = {(r.unit, r.cycle): (r.rul, r.fail_within_30) for r in lab.collect()}
    assert got[(1, 1)] == (39, 0) and got[(1, 10)] == (30, 1) and got[(2, 5)] == (3, 1)


@pytest.mark.parametrize("n_units,share", [(150, 0.2), (7, 0.2), (100, 0.15), (1, 0.2)])
def test_exact_split_counts_and_disjoint(spark, n_units, share):
    df = spark.createDataFrame([(u, c) for u in range(n_units) for c in range(3)], "unit long, cycle long")
    a = splits.unit_assignment(df, share=share).collect()
    n_val = sum(r.split == "validation" for r in a)
    assert len(a) == n_units and n_val == math.ceil(share * n_units)
    train, val = splits.split_by_unit(df, share=share)
    assert splits.split_overlap(train, val).count() == 0
    assert train.count() + val.count() == df.count()


def test_split_stable_under_repartition(spark, sf_small):
    te = tele_events(spark, sf_small)
    a = {(r.unit, r.split) for r in splits.unit_assignment(te).collect()}
    b = {(r.unit, r.split) for r in splits.unit_assignment(te.repartition(7)).collect()}
    c = {(r.unit, r.split) for r in splits.unit_assignment(te.repartition(1), mode="exact").collect()}
    assert a == b == c


def test_hash_split_is_close_to_share(spark):
    df = spark.createDataFrame([(u,) for u in range(5000)], "unit long")
    n_val = splits.unit_assignment(df, mode="hash").filter("split = 'validation'").count()
    assert abs(n_val - 1000) < 120


def test_profiles(spark, sf_small):
    te = tele_events(spark, sf_small)
    one = profile.profile(te).first()
    assert one.n_rows == te.count() and one.n_units == te.select("unit").distinct().count()
    flat = [r.sensor for r in profile.flat_sensors(te, ["sensor_1", "sensor_2", "sensor_3"]).collect()]
    assert flat == ["sensor_1"]
    spread = profile.sensor_spread(te, ["sensor_1", "sensor_2", "sensor_3"]).collect()
    assert spread[0].sensor == "sensor_1"
    bal = profile.class_balance(labels.label_fail_within(labels.label_rul(te)), "fail_within_30").collect()
    assert sum(r.share for r in bal) == pytest.approx(1.0)


def test_observe_counts_without_extra_job(spark, sf_small):
    te = tele_events(spark, sf_small)
    obs_df, obs = profile.observe_counts(te)
    obs_df.write.format("noop").mode("overwrite").save()
    assert obs.get["n_rows"] == te.count()


# ---- scaling -----------------------------------------------------------------------------------

def test_scaler_population_std_and_flat_columns(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, None], "b": [14.62] * 4})
    df = spark.createDataFrame(pdf).repartition(3)
    params = {r.feature: (r.mean, r.scale) for r in scaling.fit_scaler(df, ["a", "b"]).collect()}
    assert params["a"] == pytest.approx((2.0, np.std([1.0, 2.0, 3.0])))
    assert params["b"][1] == 1.0


def test_imputation_conventions(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "a double")
    params = scaling.fit_scaler(train, ["a"])
    rows = spark.createDataFrame([(None,), (3.0,)], "a double")
    before = [r.a for r in scaling.scale_features(rows, params, ["a"], "before").collect()]
    after = [r.a for r in scaling.scale_features(rows, params, ["a"], "after").collect()]
    none = [r.a for r in scaling.scale_features(rows, params, ["a"], "none").collect()]
    assert before == [pytest.approx(-2.0), pytest.approx(1.0)]   # 0 filled, then (0 - 2) / 1
    assert after == [0.0, pytest.approx(1.0)]                    # NULL scaled stays NULL, then 0 = the mean
    assert none[0] is None


# ---- metrics -----------------------------------------------------------------------------------

def _brute_auc(scores, ys):
    pos = [s for s, y in zip(scores, ys) if y == 1]
    neg = [s for s, y in zip(scores, ys) if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2])
def test_roc_auc_matches_pairwise_count(spark, seed):
    rng = random.Random(seed)
    data = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(data, "score double, label int")
    got = metrics.roc_auc(df, "score", "label", buckets=4).first().roc_auc
    assert got == pytest.approx(_brute_auc(*zip(*data)), abs=1e-12)


def test_roc_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1)], "score double, label int")
    assert metrics.roc_auc(df, "score", "label").first().roc_auc is None


def test_classification_and_threshold_metrics(spark):
    data = [(0.9, 1), (0.4, 1), (0.35, 0), (0.2, 0), (0.6, 0), (0.3, 1)]
    df = spark.createDataFrame(data, "prob double, label int")
    c = projections.classify(df, "prob", 0.5, "pred")
    m = metrics.classification_metrics(c, "label", "pred").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (2, 1, 2, 1)
    assert m.precision == pytest.approx(0.5) and m.recall == pytest.approx(1 / 3) and m.f1 == pytest.approx(0.4)
    th = {r.cutoff: r for r in metrics.threshold_metrics(df, "label", "prob", [0.5, 0.3]).collect()}
    assert (th[0.3].tp, th[0.3].fp, th[0.3].fn) == (3, 2, 0)
    none = metrics.classification_metrics(projections.classify(df, "prob", 2.0, "pred"), "label", "pred").first()
    assert none.precision == 0.0


def test_regression_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (5.0, 1.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert r.mae == pytest.approx(3.0) and r.rmse == pytest.approx(math.sqrt(10.0))


# ---- comparison --------------------------------------------------------------------------------

def _brute_wilcoxon(d):
    d = np.asarray([x for x in d if x != 0])
    r = pd.Series(np.abs(d)).rank(method="average").to_numpy()
    wp, wm = r[d > 0].sum(), r[d < 0].sum()
    n = len(d)
    _, counts = np.unique(np.abs(d), return_counts=True)
    var = n * (n + 1) * (2 * n + 1) / 24 - (counts ** 3 - counts).sum() / 48
    w = min(wp, wm)
    return wp, wm, w, (w - n * (n + 1) / 4) / math.sqrt(var)


def test_wilcoxon_matches_rank_brute_force(spark):
    rng = random.Random(3)
    d = [round(rng.gauss(0.3, 1.0), 1) for _ in range(500)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(d)], "id long, d double")
    got = compare.wilcoxon(df, buckets=5).first()
    wp, wm, w, z = _brute_wilcoxon(d)
    assert (got.w_plus, got.w_minus, got.w) == pytest.approx((wp, wm, w))
    assert got.z == pytest.approx(z)
    assert stats.normal_two_sided(got.z) == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))


def _t_pdf(x, v):
    return math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi) * (1 + x * x / v) ** (-(v + 1) / 2)


@pytest.mark.parametrize("t,v", [(2.0, 10), (0.5, 3), (4.2, 40), (1.0, 1)])
def test_t_pvalue_matches_numeric_integral(t, v):
    # two-sided p = 1 - integral of the pdf over [-|t|, |t|] (Simpson's rule)
    n, a = 20000, abs(t)
    h = 2 * a / n
    s = _t_pdf(-a, v) + _t_pdf(a, v) + sum((4 if i % 2 else 2) * _t_pdf(-a + i * h, v) for i in range(1, n))
    assert stats.t_two_sided(t, v) == pytest.approx(1 - s * h / 3, abs=1e-9)


def test_paired_t(spark):
    d = [1.0, 2.0, 3.0, 4.5]
    df = spark.createDataFrame([(x,) for x in d], "d double")
    r = compare.paired_t(df).first()
    assert r.t == pytest.approx(np.mean(d) / (np.std(d, ddof=1) / 2)) and r.dof == 3


def test_bootstrap_is_partition_independent_and_centred(spark):
    rng = random.Random(5)
    rows = [(i, i % 7, rng.gauss(2.0, 1.0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "unit long, cycle long, d double")
    a = {r.rep: r.mean for r in compare.bootstrap_means(df, resamples=200).collect()}
    b = {r.rep: r.mean for r in compare.bootstrap_means(df.repartition(5), resamples=200).collect()}
    assert a == b  # bitwise equal: integer sums
    assert np.mean(list(a.values())) == pytest.approx(np.mean([r[2] for r in rows]), abs=0.02)
    ci = compare.bootstrap_ci(compare.bootstrap_means(df, resamples=200)).first()
    assert ci.ci_lower < np.mean([r[2] for r in rows]) < ci.ci_upper


def test_poisson_weights_have_unit_mean():
    cdf = stats.poisson1_cdf()
    assert cdf[0] == pytest.approx(math.exp(-1)) and cdf[-1] == 1.0


def test_comparison_summary_picks_the_better_model(spark):
    rng = random.Random(9)
    rows = [(i, 1, abs(rng.gauss(1, 0.5)), abs(rng.gauss(3, 0.5))) for i in range(400)]
    df = spark.createDataFrame(rows, "unit long, cycle long, err_a double, err_b double")
    s = compare.comparison_summary(df, resamples=300).first()
    assert s.winner == "a" and s.significant is True
    assert s.t_pvalue < 1e-6 and s.wilcoxon_pvalue < 1e-6 and s.ci_upper < 0


# ---- sequences --------------------------------------------------------------------------------

def test_sequence_counts_skip_and_pad(spark, sf_small):
    tp = labels.label_rul(tele_parts(spark, sf_small))
    sizes = [r.n for r in tp.groupBy("unit").agg(F.count("*").alias("n")).collect()]
    skip = sequences.sequences(tp, ["sensor_2", "sensor_3"], 30, short="skip")
    pad = sequences.sequences(tp, ["sensor_2", "sensor_3"], 30, short="pad")
    assert skip.count() == sum(max(0, n - 29) for n in sizes)
    assert pad.count() == skip.count() + sum(n < 30 for n in sizes)
    assert {len(r.seq) for r in pad.select("seq").collect()} == {30}


def test_pad_repeats_first_row_and_skip_matches_numpy(spark):
    rows = [(1, c, float(c), float(-c), 10 - c) for c in range(1, 5)]           # short unit
    rows += [(2, c, float(c * c), 1.0, 40 - c) for c in range(1, 34)]          # long unit
    df = spark.createDataFrame(rows, "unit long, cycle long, a double, b double, rul long")
    pad = {(r.unit, r.cycle): r for r in sequences.sequences(df, ["a", "b"], 30, short="pad", chunk_rows=8).collect()}
    short = pad[(1, 4)]
    assert short.rul == 6 and short.seq[:27] == [[1.0, -1.0]] * 27 and short.seq[27:] == [[2.0, -2.0], [3.0, -3.0], [4.0, -4.0]]
    long_rows = np.array([[c * c, 1.0] for c in range(1, 34)])
    for end in range(30, 34):
        assert pad[(2, end)].seq == long_rows[end - 30:end].tolist()
        assert pad[(2, end)].rul == 40 - end


def test_window_summaries_match_numpy(spark):
    rows = [(1, c, float((c * 7) % 11)) for c in range(1, 41)]
    df = spark.createDataFrame(rows, "unit long, cycle long, a double")
    out = {r.cycle: r for r in sequences.window_summaries(df, ["a"], 30, chunk_rows=9).collect()}
    assert sorted(out) == list(range(30, 41))
    x = np.array([r[2] for r in rows])
    for end in (30, 35, 40):
        w = x[end - 30:end]
        c = np.arange(end - 29, end + 1, dtype=float)
        r = out[end]
        assert r.a_wfirst == w[0] and r.a_wmean == pytest.approx(w.mean()) and r.a_wstd == pytest.approx(w.std(ddof=1))
        assert r.a_wslope == pytest.approx(np.polyfit(c, w, 1)[0])


def test_fixed_point_limbs_reconstruct_exactly():
    rng = random.Random(11)
    xs = [-1234567.125, -0.5, -1e-9, 0.0, 3.0e-13, 0.1, 2.0 / 3.0, 4095.999, 8e6] + [rng.uniform(-5e5, 5e5) for _ in range(200)]
    xs += [1e9, -3.7e14, 2.0**79, -(2.0**79) + 2.0**30]
    for x, column in zip(xs, compare.fixed_point_limbs(np.array(xs)).T, strict=True):
        total = 0
        for limb in column:
            total = total * 2**20 + int(limb)
        assert total == math.floor(fractions.Fraction(x) * 2**40)
        assert all(0 <= v < 2**20 for v in column[1:])
