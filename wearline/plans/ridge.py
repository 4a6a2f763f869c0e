"""Ridge regression on whole-number features, from exact normal equations.

Each partition adds up the products of its rows' features in integers; the sums of all partitions
are one row for each pair of features. They are exact, so the coefficients do not depend on how
the data was partitioned, and one closed-form solution of a system as small as the features
gives the fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RIDGE = 1e-3
ROWS_AT_ONCE = 65_536


def gram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j, s``: the sum over all rows of ``columns[i] * columns[j]``, for i <= j, exactly.

    Values must be whole numbers below 2**23; a missing one counts as 0.
    """
    k = len(columns)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((k, k), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                x = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in range(k)], axis=1)
                if (np.abs(x) >= 2**23).any():
                    raise ValueError("the normal equations take whole numbers below 2**23")
                # 65,536 products below 2**46 fit 64 bits
                out += x.T @ x
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(out[i, j])], names=["i", "j", "s"])

    rows = df.select(*[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in columns])
    parts = rows.mapInArrow(totals, "i int, j int, s bigint")
    return parts.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))


@dataclass(frozen=True)
class RidgeModel:
    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]

    def predict(self) -> Column:
        out = F.lit(self.intercept)
        for f, w in zip(self.features, self.weights, strict=True):
            if w:
                out = out + F.lit(w) * F.col(f)
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.predict())


def fit_ridge(df: DataFrame, feats: Sequence[str], label: str = "rul", ridge: float = RIDGE) -> RidgeModel:
    """The weights that minimise the mean squared error plus ``ridge`` times their squares, features
    taken by their standard deviations; a constant feature gets no weight."""
    df = df.withColumn("_one", F.lit(1))
    columns = ["_one", *feats, label]
    k = len(columns)
    rows = gram(df, columns).limit(k * k).collect()
    g = np.zeros((k, k))
    for r in rows:
        g[r.i, r.j] = g[r.j, r.i] = float(r.s)
    n = g[0, 0]
    if not n:
        raise ValueError("no rows to fit")
    mean = g[0] / n
    cov = g / n - np.outer(mean, mean)
    sd = np.sqrt(np.clip(np.diag(cov), 0, None))
    live = np.flatnonzero(sd[1:-1] > 1e-9) + 1
    weights = np.zeros(k - 2)
    if len(live):
        corr = cov[np.ix_(live, live)] / np.outer(sd[live], sd[live])
        target = cov[live, -1] / sd[live]
        weights[live - 1] = np.linalg.solve(corr + ridge * np.eye(len(live)), target) / sd[live]
    intercept = mean[-1] - float(weights @ mean[1:-1])
    return RidgeModel(tuple(feats), float(intercept), tuple(float(w) for w in weights))
