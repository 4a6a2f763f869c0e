"""Exact keys, exact signed-rank p-values, canonical request bodies, streams that are restarted."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from wearline.constants import ALL_SENSORS, TELEMETRY_COLUMNS
from wearline.operators import compare
from wearline.sources import requests, text


def _line(unit, cycle):
    return " ".join([unit, cycle, *["1.5"] * (len(TELEMETRY_COLUMNS) - 2)])


def test_large_keys_stay_apart(spark):
    keys = ["9007199254740993", "9007199254740992", "-9223372036854775808", "9223372036854775807", "+12", "007"]
    lines = spark.createDataFrame([(_line(k, "1"),) for k in keys], "value string")
    assert sorted(r.unit for r in text.parse_telemetry(lines).collect()) == sorted(int(k) for k in keys)


def test_other_spellings_of_whole_keys(spark):
    good, bad = ["1.0", "1e3", "-2.50e1", "9007199254740992.0"], ["1.5", "9007199254740994.0", "9223372036854775808", "1e300", "nan", "inf", "x"]
    lines = spark.createDataFrame([(_line(k, "1"),) for k in good + bad], "value string")
    assert sorted(r.unit for r in text.parse_telemetry(lines).collect()) == [-25, 1, 1000, 2**53]
    assert [r.error for r in text.malformed_lines(lines).collect()] == ["bad_key"] * len(bad)


def test_good_rows_do_not_keep_their_line(spark):
    lines = spark.createDataFrame([(_line("1", "1"),), (_line("x", "1"),)], "value string")
    assert [(r.error, r.line is None) for r in text.parse_lines(lines).collect()] == [(None, True), ("bad_key", False)]


def _enumerated(n, w):
    sums = [sum(c) for k in range(n + 1) for c in itertools.combinations(range(1, n + 1), k)]
    return min(1.0, 2 * sum(s <= w for s in sums) / 2**n)


def test_exact_signed_rank_p_equals_enumeration(spark):
    cases = [(n, float(w), 0.0) for n in (1, 2, 5, 9, 11) for w in range(0, n * (n + 1) // 4 + 1, 3)]
    p = compare.exact_signed_rank_p(F.col("n"), F.col("w"), F.col("tie_term"))
    for r in spark.createDataFrame(cases, "n bigint, w double, tie_term double").select("*", p.alias("p")).collect():
        assert r.p == pytest.approx(_enumerated(r.n, r.w), abs=1e-15)


def test_exact_p_only_where_it_holds(spark):
    cases = [(50, 300.0, 0.0), (51, 300.0, 0.0), (20, 50.0, 6.0), (0, 0.0, 0.0)]
    p = compare.exact_signed_rank_p(F.col("n"), F.col("w"), F.col("tie_term"))
    got = [r.p for r in spark.createDataFrame(cases, "n bigint, w double, tie_term double").select(p.alias("p")).collect()]
    # two-sided p of W = 300 of 50 ranks lies near the normal form's 0.00113
    assert got[0] == pytest.approx(0.00113, abs=3e-4) and got[1:] == [None] * 3


def test_summary_takes_the_exact_p(spark):
    rows = [(1, i, float(i + 1), 0.5 * (i % 2) * 2 + 0.37 * i) for i in range(9)]
    one = compare.comparison_summary(spark.createDataFrame(rows, "unit int, cycle int, err_a double, err_b double"), resamples=20).first()
    assert one.wilcoxon_pvalue == pytest.approx(_enumerated(9, one.wilcoxon_w))


def test_canonical_bodies_are_json(spark):
    reading = {s: i / 4 for i, s in enumerate(ALL_SENSORS)}
    other = reading | {"sensor_3": None}
    df = spark.createDataFrame([("a", [reading, other]), ("b", [])], requests.REQUEST)
    got = {r.request_id: json.loads(r.body) for r in df.select("request_id", requests.canonical_body().alias("body")).collect()}
    assert got == {"a": [reading, other], "b": []}
    again = requests.parse_request_json(df.select(F.concat(F.lit('{"request_id":"a","recent_cycles":'), requests.canonical_body(), F.lit("}")).alias("body")))
    assert again.first().recent_cycles[1].sensor_3 is None


def test_restarted_stream_scores_each_request_once(spark, sf_small):
    from wearline.plans.catalog import QUERIES

    got = QUERIES["m5_stream_scores"](spark, sf_small)
    batch = QUERIES["m5_scored_requests"](spark, sf_small)
    assert got.count() == got.select("request_id").distinct().count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
