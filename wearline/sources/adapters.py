"""Stand-in telemetry built from the driver's test tables.

These views only give rows in the schema the operators expect (unit, cycle, sensors); they
do none of an operator's work. Keys are aliased *before* any window so later windows on
``unit`` reuse the same shuffle.

- ``tele_events``: unit = ``user_id``; cycle = row number by ``ts, event_id``;
  ``sensor_1`` = 518.67 (a flat sensor), ``sensor_2`` = ``value``,
  ``sensor_3`` = ``props.k`` as double.
- ``tele_parts``: unit = ``l_partkey``; cycle by ``l_shipdate, l_orderkey, l_linenumber``;
  ``sensor_2/3/4/7`` = quantity, extended price, discount, tax.
- ``tele_fleet``: ``tele_events`` keyed by ``(dataset = event_type, unit = user_id)``.
- ``tele_text``: ``tele_events`` rendered as whitespace-separated text lines.
- ``request_records``: the newest 5 rows of every ``tele_events`` unit as one request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearline.constants import ALL_SENSORS, OP_SETTINGS, TELEMETRY_COLUMNS
from wearline.operators.frames import deal, helpers, number_cycles

EVENT_SENSORS = ["sensor_1", "sensor_2", "sensor_3"]
PART_SENSORS = ["sensor_2", "sensor_3", "sensor_4", "sensor_7"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_sensors() -> list[Column]:
    return [
        F.lit(518.67).alias("sensor_1"),
        F.col("value").alias("sensor_2"),
        F.get_json_object("props", "$.k").try_cast("double").alias("sensor_3"),
    ]


def tele_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("unit"), "ts", "event_id", *_event_sensors()
    )
    cycle = F.row_number().over(Window.partitionBy("unit").orderBy("ts", "event_id")).cast("bigint")
    return ev.select("unit", cycle.alias("cycle"), *EVENT_SENSORS)


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tele_events`` dealt for windows (:func:`wearline.operators.frames.deal`): cycles are numbered
    range by range, and windows on the result need no further shuffle."""
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), "ts", "event_id", *_event_sensors())
    numbered = number_cycles(deal(ev, "unit", "ts"), "unit", ["ts", "event_id"])
    return numbered.select("unit", "cycle", *EVENT_SENSORS, *helpers(numbered))


def dealt_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tele_parts`` dealt for windows, as :func:`dealt_events`."""
    numbered = number_cycles(deal(_part_rows(spark, sf_dir), "unit", "l_shipdate"), "unit", ["l_shipdate", "l_orderkey", "l_linenumber"])
    return numbered.select("unit", "cycle", *PART_SENSORS, *helpers(numbered))


def _part_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("unit"),
        "l_shipdate", "l_orderkey", "l_linenumber",
        F.col("l_quantity").alias("sensor_2"),
        F.col("l_extendedprice").alias("sensor_3"),
        F.col("l_discount").alias("sensor_4"),
        F.col("l_tax").alias("sensor_7"),
    )


def tele_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _part_rows(spark, sf_dir)
    order = Window.partitionBy("unit").orderBy("l_shipdate", "l_orderkey", "l_linenumber")
    return li.select("unit", F.row_number().over(order).cast("bigint").alias("cycle"), *PART_SENSORS)


def tele_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset"), F.col("user_id").alias("unit"), "ts", "event_id", *_event_sensors()
    )
    cycle = F.row_number().over(Window.partitionBy("dataset", "unit").orderBy("ts", "event_id")).cast("bigint")
    return ev.select("dataset", "unit", cycle.alias("cycle"), *EVENT_SENSORS)


# Separators between consecutive fields of a rendered line, by field position mod 3.
_SEPARATORS = [" ", "  ", " \t "]


def tele_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tele_events`` as 26-field text lines with irregular spacing; absent fields are ``NaN``.

    Even cycles get a leading space and odd cycles a trailing tab, so the parser sees both.
    """
    te = tele_events(spark, sf_dir)
    fields: list[Column] = []
    for i, name in enumerate(TELEMETRY_COLUMNS):
        if name in te.columns:
            fields.append(F.col(name).cast("string"))
        else:
            fields.append(F.lit("NaN"))
        if i < len(TELEMETRY_COLUMNS) - 1:
            fields.append(F.lit(_SEPARATORS[i % 3]))
    lead = F.when(F.col("cycle") % 2 == 0, F.lit(" ")).otherwise(F.lit(""))
    trail = F.when(F.col("cycle") % 2 == 1, F.lit("\t")).otherwise(F.lit(""))
    return te.select(F.concat(lead, *fields, trail).alias("value"))


def fleet_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tele_fleet`` as text lines, with the folder that each line belongs to."""
    fleet = tele_fleet(spark, sf_dir)
    fields = [F.col(n).cast("string") if n in fleet.columns else F.lit("NaN") for n in TELEMETRY_COLUMNS]
    return fleet.select(F.concat_ws("  ", *fields).alias("value"), F.col("dataset").alias("folder"))


def request_records(spark: SparkSession, sf_dir: str, k: int = 5) -> DataFrame:
    """One scoring request per ``tele_events`` unit: its newest ``k`` readings, oldest first.

    Sensors the events table does not carry are sent as 0.0 so every reading is complete.
    """
    from wearline.sources.requests import build_requests

    te = tele_events(spark, sf_dir)
    filled = te.select(
        "unit", "cycle", *[F.col(s) if s in te.columns else F.lit(0.0).alias(s) for s in ALL_SENSORS]
    )
    return build_requests(filled, k=k)


__all__ = [
    "tele_events", "tele_parts", "tele_fleet", "tele_text", "request_records", "table",
    "EVENT_SENSORS", "PART_SENSORS", "OP_SETTINGS",
]
