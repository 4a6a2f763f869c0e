"""Global running sums and ranks without a single-partition window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task. Instead, rows
are range-bucketed on the first order column with split points from ``approxQuantile``
(the driver receives at most ``buckets`` numbers), bucket totals (one row per bucket, a
proven size bound) are turned into bucket offsets and broadcast, and the running sum inside
each bucket is an ordinary window partitioned by bucket. Split points only balance the
buckets; correctness does not depend on them, because bucket order agrees with row order.

Callers group by value first (one row per distinct score, per unit, ...), so a value that
repeats a billion times is still one row here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.session import materialize

BUCKET = "_bucket"


def _bucket_count(df: DataFrame, buckets: int | None) -> int:
    if buckets:
        return int(buckets)
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def ordered_prefix(
    df: DataFrame,
    order: Sequence[str],
    sums: Mapping[str, Column],
    buckets: int | None = None,
    rel_err: float = 1e-3,
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """For each ``name -> expr`` add ``name_before`` (sum of ``expr`` over rows strictly
    before this one in ``order``) and ``name_total`` (sum over all rows).

    ``order`` must identify rows uniquely; its first column must be numeric. ``bounds``
    gives known split points (e.g. for a uniform hash) and skips the ``approxQuantile`` pass.
    """
    order = list(order)
    nb = _bucket_count(df, buckets)
    keyed = df.withColumn("_bk", F.col(order[0]).cast("double"))
    for name, expr in sums.items():
        keyed = keyed.withColumn(f"_w_{name}", expr)
    if bounds is None:
        probs = [i / nb for i in range(1, nb)]
        if probs:
            # The split points and the result read the same rows: written once to the shared
            # folder, so nothing stays cached in the session.
            keyed = materialize(keyed)
            bounds = keyed.approxQuantile("_bk", probs, rel_err)
        else:
            bounds = []
    splits = [float("-inf"), *sorted({b for b in bounds if b == b and abs(b) != float("inf")}), float("inf")]
    if len(splits) > 2:
        bucketed = Bucketizer(splits=splits, inputCol="_bk", outputCol=BUCKET, handleInvalid="keep").transform(keyed)
    else:
        bucketed = keyed.withColumn(BUCKET, F.lit(0.0))

    totals = bucketed.groupBy(BUCKET).agg(*[F.sum(f"_w_{n}").alias(f"_t_{n}") for n in sums])
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        BUCKET,
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(everything).alias(f"{n}_total") for n in sums],
    )
    joined = bucketed.join(F.broadcast(offsets), BUCKET)
    inside = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = joined.select(
        *df.columns,
        *[(F.col(f"_o_{n}") + F.coalesce(F.sum(f"_w_{n}").over(inside), F.lit(0))).alias(f"{n}_before") for n in sums],
        *[F.col(f"{n}_total") for n in sums],
    )
    return out


def uniform_bounds(lo: float, hi: float, buckets: int) -> list[float]:
    """Equal-width split points for a key known to be uniform on ``[lo, hi)``."""
    return [lo + (hi - lo) * i / buckets for i in range(1, buckets)]


def global_row_number(
    df: DataFrame, order: Sequence[str], out: str = "rn", buckets: int | None = None, bounds: Sequence[float] | None = None
) -> DataFrame:
    """``row_number() over (order by ...)`` computed bucket-wise; also adds ``<out>_total`` = row count."""
    p = ordered_prefix(df, order, {"_n": F.lit(1)}, buckets, bounds=bounds)
    return p.select(
        *df.columns,
        (F.col("_n_before") + 1).cast("bigint").alias(out),
        F.col("_n_total").cast("bigint").alias(f"{out}_total"),
    )
