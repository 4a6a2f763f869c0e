"""Training preparation: labels -> rolling features -> unit split -> scaler -> scaled splits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearline.constants import KEPT_SENSORS, ROLLING_WINDOW, SEED, VALIDATION_SHARE
from wearline.functions.columns import as_list, feature_columns
from wearline.operators.frames import deal, is_dealt
from wearline.operators.labels import label_rul
from wearline.operators.rolling import rolling_features
from wearline.operators.scaling import fit_scaler, scale_features, scaler_literals
from wearline.operators.splits import TRAIN, VALIDATION, assign_split
from wearline.session import materialize


@dataclass
class Prepared:
    train: DataFrame
    validation: DataFrame
    params: DataFrame
    features: list[str]
    scaler: dict[str, tuple[float | None, float]]


def prepare(
    df: DataFrame,
    sensors: Sequence[str] = KEPT_SENSORS,
    keys: str | Iterable[str] = "unit",
    n: int = ROLLING_WINDOW,
    share: float = VALIDATION_SHARE,
    seed: int = SEED,
    impute: str = "before",
) -> Prepared:
    """Rolling features are computed on the whole input before the split (windows never cross
    units), the scaler sees training units only, and both splits are scaled with it.

    ``impute="before"`` fills missing features with 0 and then scales (serving convention,
    our default for both sides); ``"after"`` scales first and fills afterwards, so a missing
    value ends at the training mean.
    """
    keys = as_list(keys)
    feats = feature_columns(sensors)
    # dealt once: labels and rolling features share one shuffle
    rolled = rolling_features(label_rul(df if is_dealt(df) else deal(df, keys), keys), sensors, n, keys)
    # Read by the scaler fit now and by both splits (boosting, scoring) later: written once.
    tagged = materialize(assign_split(rolled, share, seed, keys))
    train = tagged.filter(F.col("split") == TRAIN).drop("split")
    val = tagged.filter(F.col("split") == VALIDATION).drop("split")
    fit_on = train.fillna(0.0, subset=feats) if impute == "before" else train
    # fitted once: the table that is stored and the literals that scale are the same numbers
    params = materialize(fit_scaler(fit_on, feats))
    lits = scaler_literals(params, feats)
    return Prepared(
        train=scale_features(train, lits, feats, impute),
        validation=scale_features(val, lits, feats, impute),
        params=params,
        features=feats,
        scaler=lits,
    )
