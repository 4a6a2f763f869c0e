"""Column-list helpers (schema only, no Spark job)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.constants import KEPT_SENSORS


def as_list(cols: str | Iterable[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def mean_col(sensor: str) -> str:
    return f"{sensor}_rollmean"


def std_col(sensor: str) -> str:
    return f"{sensor}_rollstd"


def feature_columns(sensors: Sequence[str] = KEPT_SENSORS) -> list[str]:
    """Raw sensors, then their rolling means, then their rolling stds, in that fixed order."""
    sensors = list(sensors)
    return sensors + [mean_col(s) for s in sensors] + [std_col(s) for s in sensors]


def sensor_columns(df: DataFrame, needle: str = "sensor") -> list[str]:
    """Every column whose name contains ``needle``, in frame order."""
    return [c for c in df.columns if needle in c]


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The subset of ``cols`` that the frame actually has, in the given order."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (outputs only, never inputs) so engines compare equal."""
    out: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), places).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
