"""Scoring requests as records: build, parse, validate, explode."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.constants import ALL_SENSORS, REQUEST_MAX_READINGS, REQUEST_MIN_READINGS, ROLLING_WINDOW
from wearline.functions.columns import as_list
from wearline.operators.rolling import last_k

READING = T.StructType([T.StructField(s, T.DoubleType(), True) for s in ALL_SENSORS])
REQUEST = T.StructType([
    T.StructField("request_id", T.StringType(), True),
    T.StructField("recent_cycles", T.ArrayType(READING, True), True),
])


def build_requests(
    df: DataFrame, k: int = ROLLING_WINDOW, keys: str | Iterable[str] = "unit", order: str = "cycle"
) -> DataFrame:
    """The newest ``k`` readings of every unit as one request, oldest first.

    W4 keeps at most ``k`` rows per unit (partial limit before the shuffle), then the readings
    are collected as ``struct(cycle, sensors...)`` and sorted by cycle; wrapping keeps NULL
    sensors inside the array.
    """
    keys = as_list(keys)
    recent = last_k(df, k, keys, order)
    packed = F.struct(F.col(order).alias("_o"), *[F.col(s).cast("double").alias(s) for s in ALL_SENSORS])
    grouped = recent.groupBy(*keys).agg(F.sort_array(F.collect_list(packed)).alias("_r"))
    readings = F.transform("_r", lambda r: F.struct(*[r[s].alias(s) for s in ALL_SENSORS]))
    rid = F.concat_ws("_", *[F.col(c).cast("string") for c in keys])
    return grouped.select(*keys, rid.alias("request_id"), readings.alias("recent_cycles"))


def canonical_body(readings: str = "recent_cycles", places: int = 6) -> Column:
    """A request's readings as text that any engine can write: a list of objects, oldest first, sensors
    in their order, every number with ``places`` decimals, ``null`` where one is missing."""
    number = lambda r, s: F.coalesce(F.format_string(f"%.{places}f", r[s]), F.lit("null"))
    fields = lambda r: F.concat_ws(",", *[F.concat(F.lit(f'"{s}":'), F.when(r[s].isNull(), "null").otherwise(number(r, s))) for s in ALL_SENSORS])
    rows = F.transform(F.col(readings), lambda r: F.concat(F.lit("{"), fields(r), F.lit("}")))
    return F.concat(F.lit("["), F.concat_ws(",", rows), F.lit("]"))


def parse_request_json(df: DataFrame, body: str = "body") -> DataFrame:
    """Raw JSON bodies ``{"request_id": ..., "recent_cycles": [{...}, ...]}`` to typed records."""
    parsed = F.from_json(F.col(body), REQUEST)
    return df.select(parsed["request_id"].alias("request_id"), parsed["recent_cycles"].alias("recent_cycles"))


def _missing_sensor(r: Column) -> Column:
    miss = F.lit(False)
    for s in ALL_SENSORS:
        miss = miss | r[s].isNull() | F.isnan(r[s])
    return miss


def validate_requests(df: DataFrame, readings: str = "recent_cycles") -> DataFrame:
    """Add ``error`` (NULL when valid). Invalid requests stay as rows; the job never fails.

    Rules: 1 to 5 readings, each with all 21 sensors present.
    """
    n = F.size(F.col(readings))
    error = (
        F.when(F.col(readings).isNull() | (n < REQUEST_MIN_READINGS), F.lit("empty"))
        .when(n > REQUEST_MAX_READINGS, F.lit("too_many_readings"))
        .when(F.exists(F.col(readings), _missing_sensor), F.lit("missing_sensor"))
    )
    return df.withColumn("error", error)


def explode_requests(df: DataFrame, readings: str = "recent_cycles", id_col: str = "request_id") -> DataFrame:
    """One row per reading, ``pos`` 1 = oldest."""
    ex = df.select(id_col, F.posexplode(F.col(readings)).alias("_pos", "_r"))
    return ex.select(id_col, (F.col("_pos") + 1).cast("bigint").alias("pos"), *[F.col("_r")[s].alias(s) for s in ALL_SENSORS])
