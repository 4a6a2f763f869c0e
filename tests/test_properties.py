"""Properties: results do not depend on partitioning, and a hot unit does not land in one task."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wearline.functions.columns import round_doubles
from wearline.operators import compare, labels, metrics, rolling
from wearline.operators.frames import CHUNK, chunk_frames
from wearline.sources import text
from wearline.sources.adapters import tele_events


def _rows(df, keys):
    return sorted(tuple(r[c] for c in keys) + tuple(round(r[c], 9) if isinstance(r[c], float) else r[c]
                                                    for c in df.columns if c not in keys) for r in df.collect())


@pytest.mark.parametrize("n", [1, 4, 7])
def test_rolling_and_state_unchanged_under_repartition(spark, sf_small, n):
    te = tele_events(spark, sf_small)
    base = _rows(rolling.rolling_features(te, ["sensor_2", "sensor_3"], chunk_rows=11), ["unit", "cycle"])
    again = _rows(rolling.rolling_features(te.repartition(n), ["sensor_2", "sensor_3"], chunk_rows=11), ["unit", "cycle"])
    assert base == again
    assert _rows(rolling.current_state(te, ["sensor_2"]), ["unit"]) == _rows(rolling.current_state(te.repartition(n), ["sensor_2"]), ["unit"])


@pytest.mark.parametrize("n", [1, 4, 7])
def test_auc_and_wilcoxon_unchanged_under_repartition(spark, sf_small, n):
    lab = labels.label_fail_within(labels.label_rul(tele_events(spark, sf_small)))
    a = metrics.roc_auc(lab, "sensor_2", "fail_within_30").first().roc_auc
    b = metrics.roc_auc(lab.repartition(n), "sensor_2", "fail_within_30", buckets=n).first().roc_auc
    assert a == pytest.approx(b, abs=1e-12)
    d = lab.select((F.col("sensor_2") - F.col("sensor_3") / 10).alias("d"))
    wa = compare.wilcoxon(d).first()
    wb = compare.wilcoxon(d.repartition(n), buckets=n + 1).first()
    assert (wa.w_plus, wa.w_minus, wa.tie_term) == (wb.w_plus, wb.w_minus, wb.tie_term)


def test_hot_unit_is_spread_over_chunks(spark):
    # unit 0 holds 60% of the rows
    hot = spark.range(6000).select(F.lit(0).cast("bigint").alias("unit"), (F.col("id") + 1).alias("cycle"))
    cold = spark.range(4000).select((F.col("id") % 40 + 1).alias("unit"), (F.floor(F.col("id") / 40) + 1).cast("bigint").alias("cycle"))
    df = hot.unionByName(cold).withColumn("sensor_2", F.sin(F.col("cycle") * 1.3 + F.col("unit")))
    frame, part = chunk_frames(df, "unit", "cycle", 4, chunk_rows=500)
    largest = frame.groupBy(*part).count().agg(F.max("count")).first()[0]
    assert largest <= 500 + 4  # a chunk's own rows plus its halo, whatever the unit's size
    got = round_doubles(rolling.rolling_features(df, ["sensor_2"], chunk_rows=500), 9)
    want = round_doubles(rolling.rolling_features(df, ["sensor_2"], chunk_rows=None), 9)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


_spaces = st.sampled_from([" ", "  ", "\t", " \t ", "   "])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(1, 400),
                          st.lists(st.floats(-1e4, 1e4, allow_nan=False).map(lambda x: round(x, 4)), min_size=24, max_size=24),
                          st.lists(_spaces, min_size=27, max_size=27)), min_size=1, max_size=8))
def test_parser_reads_any_spacing(spark, lines):
    raw, expected = [], []
    for unit, cycle, vals, seps in lines:
        fields = [str(unit), str(cycle)] + [repr(v) for v in vals]
        line = seps[0] + "".join(f + s for f, s in zip(fields, seps[1:]))
        raw.append((line,))
        expected.append((unit, cycle, *vals))
    got = text.parse_telemetry(spark.createDataFrame(raw, "value string")).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected)
