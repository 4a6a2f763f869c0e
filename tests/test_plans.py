"""Plan shape: the scale properties the README claims, read from the physical plans."""

import contextlib
import io
import os

import pytest

from wearline.operators.labels import label_fail_within
from wearline.operators.rolling import current_state, last_k, rolling_features
from wearline.operators.scaling import fit_scaler, scale_features
from wearline.plans import comparison, models
from wearline.plans.catalog import QUERIES
from wearline.plans.ensemble import TreeEnsemble
from wearline.plans.training import prepare
from wearline.sources.adapters import PART_SENSORS, dealt_events, dealt_parts, tele_events

# one fit serves the others; the classifier's and the challenger's plans are read with two rounds below
SKIP = {"m2_classifier_probabilities", "m2_compiled_probabilities", "m6_challenger_predictions", "a20_model_comparison"}


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def parquet_events(spark, sf_small, tmp_path_factory):
    path = os.path.join(str(tmp_path_factory.mktemp("tele")), "tele")
    tele_events(spark, sf_small).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_no_cartesian_or_nested_loop_join(spark, sf_small, name):
    plan = _plan(QUERIES[name](spark, sf_small))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_no_cartesian_join_in_the_fitted_queries(spark, sf_small):
    """The queries of SKIP, with two rounds of boosting."""
    p = prepare(dealt_events(spark, sf_small), ["sensor_2", "sensor_3"])
    parts = dealt_parts(spark, sf_small)
    classifier = models.fit_classifier(label_fail_within(p.train), p.features, rounds=2)
    frames = [
        models.predict_proba(classifier, p.validation),
        TreeEnsemble.of(classifier).transform(p.validation),
        comparison.challenger_predictions(parts, PART_SENSORS, rounds=2),
        comparison.model_comparison(parts, PART_SENSORS, rounds=2, resamples=20),
    ]
    for df in frames:
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_last_k_and_current_state_limit_before_the_shuffle(parquet_events):
    for df in (last_k(parquet_events, 5), current_state(parquet_events, ["sensor_2"])):
        tree = _plan(df).split("\n\n")[0]
        lines = tree.splitlines()
        partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l]
        exchange = [i for i, l in enumerate(lines) if "Exchange" in l]
        # the deepest WindowGroupLimit sits below (after, in print order) the exchange: partial first
        assert partial and exchange and max(partial) > min(exchange)
        assert "Partial" in _plan(df)


def test_rolling_window_never_partitions_by_unit_alone(parquet_events):
    # the units of the small table are long if more than 20 rows are
    plan = _plan(rolling_features(parquet_events, ["sensor_2"], chunk_rows=20))
    windows = [l for l in plan.splitlines() if "avg(sensor_2" in l and "windowspecdefinition" in l]
    assert windows and all("_chunk" in l for l in windows)


def test_scaling_is_a_projection(parquet_events):
    params = fit_scaler(parquet_events, ["sensor_2", "sensor_3"])
    plan = _plan(scale_features(parquet_events, params, ["sensor_2", "sensor_3"]))
    assert "Join" not in plan and "Exchange" not in plan
    assert "ReadSchema: struct<unit:bigint,cycle:bigint,sensor_1:double,sensor_2:double,sensor_3:double>" in plan
