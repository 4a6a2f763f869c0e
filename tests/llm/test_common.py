"""Lookups with hot keys, and written tables that are deleted."""

import os

import pytest
from pyspark.sql import functions as F

from wearline.llm import common


@pytest.mark.parametrize("few", [0, 10**6])
@pytest.mark.parametrize("bar", [0, 1, 5, 10**6])
def test_lookups_equal_a_join_on_either_side_of_the_bar(spark, monkeypatch, bar, few):
    monkeypatch.setattr(common, "FEW_FACTS", few)
    rows = spark.range(300).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("x"))
    facts = rows.filter("k <> 5").groupBy("k").agg(F.count("*").alias("n"), F.max("x").alias("y"))
    got, want = common.looked_up(rows, facts, ["k"], "n", bar), rows.join(facts, "k")
    assert sorted(map(tuple, got.select("k", "x", "n", "y").collect())) == sorted(map(tuple, want.select("k", "x", "n", "y").collect()))


def test_the_number_of_hot_keys_is_bounded():
    assert common.hot_bar(10) == common.HOT_LEAST
    for rows in (10**7, 10**9, 10**13):
        assert rows / (common.hot_bar(rows) + 1) <= common.HOT_SHARE


def test_discarded_tables_are_gone(spark):
    df = common.land(spark.range(10), "gone")
    path = df._landed_at.removeprefix("file://").removeprefix("file:")
    assert df.count() == 10 and os.path.isdir(path)
    common.discard(df)
    assert not os.path.exists(path)
