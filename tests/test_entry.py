import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from wearline.operators import scaling
from wearline.plans.catalog import EV_FEATS
from wearline.sources import tables

from wearline.plans.catalog import QUERIES
from wearline.plans.oracle import oracle_sql

MODEL_QUERIES = {
    "m1_regressor_predictions", "m2_classifier_probabilities", "a21_importance", "o2_top_importance",
    "m4_score_fleet", "m5_score_requests", "m6_challenger_predictions", "m6_kernel_predictions",
    "a20_model_comparison",
}


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and "sensor_2_rollmean" in df.columns


TABLES = ["events", "lineitem"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())
    # only fitted values and the p-value summary go without SQL
    assert set(QUERIES) - set(oracle_sql()) <= MODEL_QUERIES | {"a20_comparison_summary"}


def _plain(v):
    """Numbers alike in both engines: to six places, no negative zero, no NaN."""
    if isinstance(v, bool) or not isinstance(v, (int, float, decimal.Decimal)):
        return v
    return None if v != v else round(float(v), 6) + 0.0


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(oracle_sql())))
def test_query_equals_its_sql(spark, sf_small, duck, name):
    df = QUERIES[name](spark, sf_small)
    expected = duck.execute(oracle_sql()[name]).to_arrow_table()
    assert sorted(df.columns) == sorted(expected.column_names)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(_plain(r[c]) for c in columns) for r in expected.to_pylist()), key=repr)


def test_scaler_table_round_trip(spark, sf_small, scratch):
    from wearline.plans.catalog import _split
    from wearline.operators.rolling import rolling_features

    train, _ = _split(spark, sf_small)
    params = scaling.fit_scaler(rolling_features(train, ["sensor_2", "sensor_3"]), EV_FEATS)
    path = os.path.join(scratch, "scaler")
    tables.write_scaler(params, path)
    back = tables.read_scaler(spark, path)
    assert tables.feature_order(back) == EV_FEATS
    assert scaling.scaler_literals(back, EV_FEATS) == scaling.scaler_literals(params, EV_FEATS)
