"""Queries that write a table to a ``file:`` folder, in a session taken for one of a standalone cluster."""

import datetime

import pytest

from wearline.plans import models
from wearline.plans.catalog import QUERIES

FAILED = [
    "a12_classification_metrics",
    "a13_threshold_metrics",
    "a14_roc_auc",
    "a15_paired_t",
    "a14_roc_auc_sensor",
    "a16_wilcoxon",
    "a17_mean_diff",
    "a16_wilcoxon_exact",
    "a18_bootstrap_means",
    "a20_comparison_summary",
    "a19_bootstrap_ci",
    "a20_model_comparison",
    "a20_statistics",
    "a21_importance",
    "a21_importance_check",
    "a2_split_profile",
    "a8_fit_scaler",
    "a9_regression_metrics",
    "d2_early_stop_split",
    "j2_align",
    "m1_compiled_predictions",
    "m1_regressor_predictions",
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    day = lambda i: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=i)
    events = [
        (u * 100 + c, day(c), u, "FD001", float((u * 7 + c * c) % 23), f'{{"k": {(u + c * 3) % 11}}}')
        for u in range(1, 13) for c in range(29 + u)
    ]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    items = [
        (p * 100 + c, p, 1, 1, float(c % 17), float((p * c) % 29), (c % 5) / 10, (c % 3) / 10, "N", "O", day(c))
        for p in range(1, 9) for c in range(34 + p)
    ]
    spark.createDataFrame(
        items,
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return folder


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://master:7077")
    # what is fitted is not looked at here, so two rounds do
    for fit in (models.fit_regressor, models.fit_early_stopped):
        label, _, *rest = fit.__defaults__
        monkeypatch.setattr(fit, "__defaults__", (label, 2, *rest))
    return spark


@pytest.mark.parametrize("name", FAILED)
def test_a_mounted_folder_serves_the_query(cluster, tables, name):
    assert cluster.sparkContext.getCheckpointDir().startswith("file:")
    assert QUERIES[name](cluster, tables).count() > 0
