"""Fleet scoring (M4) and request scoring (M5), distributed to the end.

Fleet: latest state of every unit (W5) -> scale (M3) -> ``model.transform`` -> score table. The
model is a fitted pipeline, or a :class:`wearline.plans.ensemble.TreeEnsemble`, whose trees are
an expression on the feature columns (no vectors are assembled).
Requests: each request carries its own <= 5 readings, so features are array lambdas on the
row itself (no window, no shuffle); the same function runs on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wearline.constants import KEPT_SENSORS, ROLLING_WINDOW
from wearline.functions.columns import as_list, feature_columns, mean_col, std_col
from wearline.operators.rolling import current_state
from wearline.operators.scaling import scale_features
from wearline.plans.ensemble import TreeEnsemble
from wearline.sources.requests import validate_requests
from wearline.sources.tables import score_table


def score_fleet(
    fleet: DataFrame,
    model: PipelineModel | TreeEnsemble,
    params: DataFrame | dict,
    sensors: Sequence[str] = KEPT_SENSORS,
    keys: str | Iterable[str] = ("dataset", "unit"),
    n: int = ROLLING_WINDOW,
    impute: str = "before",
    rows_seen: Observation | None = None,
    units_scored: Observation | None = None,
) -> DataFrame:
    """M4: ``dataset, unit, cycle, predicted_rul`` for the newest cycle of every unit.

    ``rows_seen`` / ``units_scored`` (A5) receive ``n`` = rows read and units scored from
    the scoring job itself; no extra job counts them.
    """
    keys = as_list(keys)
    feats = feature_columns(sensors)
    if rows_seen is not None:
        fleet = fleet.observe(rows_seen, F.count(F.lit(1)).alias("n"))
    state = current_state(fleet, sensors, n, keys)
    if units_scored is not None:
        state = state.observe(units_scored, F.count(F.lit(1)).alias("n"))
    scaled = scale_features(state, params, feats, impute)
    scored = model.transform(scaled)
    if "dataset" not in keys:
        scored = scored.withColumn("dataset", F.lit(None).cast("string"))
    return score_table(scored)


def _values(readings: str, sensor: str, n: int) -> Column:
    vals = F.transform(F.col(readings), lambda r: r[sensor])
    k = F.least(F.size(vals), F.lit(n))
    return F.slice(vals, F.size(vals) - k + 1, k)


def _mean(vals: Column) -> Column:
    total = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(vals))


def _std(vals: Column) -> Column:
    m = _mean(vals)
    ss = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.when(F.size(vals) > 1, F.sqrt(ss / (F.size(vals) - 1)))


def request_features(
    df: DataFrame, sensors: Sequence[str] = KEPT_SENSORS, n: int = ROLLING_WINDOW, readings: str = "recent_cycles"
) -> DataFrame:
    """M5 features: for each sensor, the newest reading and the mean / sample std of the newest
    ``n`` readings; equal to W1/W2 at the last row of the same history."""
    cols: list[Column] = []
    for s in sensors:
        cols.append(F.try_element_at(F.col(readings), F.lit(-1))[s].alias(s))
    for s in sensors:
        cols.append(_mean(_values(readings, s, n)).alias(mean_col(s)))
    for s in sensors:
        cols.append(_std(_values(readings, s, n)).alias(std_col(s)))
    keep = [c for c in df.columns if c != readings]
    return df.select(*keep, F.size(F.col(readings)).cast("int").alias("cycles_used"), *cols)


def score_requests(
    df: DataFrame,
    model: PipelineModel | TreeEnsemble,
    params: DataFrame | dict,
    sensors: Sequence[str] = KEPT_SENSORS,
    n: int = ROLLING_WINDOW,
    id_col: str = "request_id",
) -> DataFrame:
    """M5: ``request_id, predicted_rul, cycles_used, error``; invalid requests stay as rows
    with an ``error`` and no prediction, so one bad request never fails the batch or stream."""
    feats = feature_columns(sensors)
    checked = validate_requests(df.select(id_col, "recent_cycles"))
    # one pass: a rejected request is scored as an empty one and its prediction dropped
    usable = F.when(F.col("error").isNull(), F.col("recent_cycles"))
    rows = checked.select(id_col, "error", F.coalesce(F.size("recent_cycles"), F.lit(0)).alias("_sent"), usable.alias("recent_cycles"))
    scored = model.transform(scale_features(request_features(rows, sensors, n).fillna(0.0, subset=feats), params, feats, "before"))
    ok = F.col("error").isNull()
    return scored.select(
        id_col, F.when(ok, F.col("prediction")).alias("predicted_rul"), F.greatest("_sent", F.lit(0)).cast("int").alias("cycles_used"), "error"
    )
