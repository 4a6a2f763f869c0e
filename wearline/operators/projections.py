"""Projections, filters and row-level predicates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from wearline.constants import DEFAULT_CUTOFF, FLAT_SENSORS
from wearline.functions.columns import as_list, feature_columns


def select_features(df: DataFrame, sensors: Sequence[str], keep: Iterable[str] = ("unit", "cycle")) -> DataFrame:
    """Keys plus the fixed-order feature columns."""
    return df.select(*as_list(keep), *feature_columns(sensors))


def drop_flat(df: DataFrame, flat: Iterable[str] = FLAT_SENSORS) -> DataFrame:
    """Drop the flat sensors (the list may come from :func:`wearline.operators.profile.flat_sensors`)."""
    return df.drop(*as_list(flat))


def by_units(df: DataFrame, units: DataFrame | Sequence, keys: str | Iterable[str] = "unit") -> DataFrame:
    """Keep rows of the chosen units.

    A DataFrame of units becomes a left-semi join (no duplication, AQE may broadcast it);
    a short literal list becomes ``isin`` and is pushed to the Parquet scan; it names units by
    one key, so several keys need a DataFrame.
    """
    keys = as_list(keys)
    if not isinstance(units, DataFrame) and len(keys) > 1:
        raise ValueError("units with several keys must be given as a DataFrame")
    if isinstance(units, DataFrame):
        return df.join(units.select(*keys).distinct(), keys, "left_semi")
    return df.filter(F.col(keys[0]).isin(list(units)))


def without_units(df: DataFrame, units: DataFrame, keys: str | Iterable[str] = "unit") -> DataFrame:
    """Rows of every unit not in ``units`` (left-anti join)."""
    keys = as_list(keys)
    return df.join(units.select(*keys).distinct(), keys, "left_anti")


def impute(df: DataFrame, cols: Iterable[str], value: float = 0.0) -> DataFrame:
    """Replace NULL and NaN with ``value`` in ``cols``."""
    return df.fillna(value, subset=as_list(cols))


def errors(df: DataFrame, truth: str, a: str, b: str, a_err: str = "err_a", b_err: str = "err_b", diff: str = "d") -> DataFrame:
    """Absolute error of two predictions and their paired difference ``err_a - err_b``."""
    ea = F.abs(F.col(truth) - F.col(a))
    eb = F.abs(F.col(truth) - F.col(b))
    return df.withColumn(a_err, ea).withColumn(b_err, eb).withColumn(diff, F.col(a_err) - F.col(b_err))


def positive_probability(df: DataFrame, probability: str = "probability", out: str = "prob") -> DataFrame:
    """The class-1 probability out of a Spark ML probability vector."""
    return df.withColumn(out, vector_to_array(F.col(probability))[1])


def classify(df: DataFrame, prob: str = "prob", cutoff: float = DEFAULT_CUTOFF, out: str = "pred") -> DataFrame:
    """Class 1 when ``prob >= cutoff`` (inclusive)."""
    return df.withColumn(out, (F.col(prob) >= F.lit(cutoff)).cast("int"))


def preview(df: DataFrame, n: int = 10, order: Sequence[str] = ("unit", "cycle")) -> DataFrame:
    """The first ``n`` rows in key order (a top-n: ``TakeOrderedAndProject``)."""
    return df.orderBy(*order).limit(n)


def trajectories(
    df: DataFrame, units: DataFrame | Sequence, sensors: Sequence[str], keys: Sequence[str] = ("unit", "cycle")
) -> DataFrame:
    """Long-form (unit, cycle, sensor, value) for chosen units and sensors (the data behind a
    plot); the last of ``keys`` is the order, the others name the unit."""
    picked = by_units(df, units, list(keys[:-1])).select(*keys, *sensors)
    return picked.unpivot(list(keys), list(sensors), "sensor", "value")
