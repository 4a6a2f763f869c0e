"""Convolution-kernel features of fixed-length windows (M6): what a window's order tells.

A kernel has nine weights, three of them 2 and the others -1, so they sum to zero, and a dilation;
it is laid on a sensor at every place of the ``n``-row window where it fits, and the feature is the
number of places where the sum is positive. Zero sums make the features independent of a sensor's
offset and scale. What the sums cannot see, the level, is told by the number of steps above given
values of the sensor.

A convolution is computed once for each row of a batch and counted up to the row; a window's count
is the difference of two of these, so a row costs the same whatever ``n``. Everything runs on the
frames of :mod:`wearline.operators.frames`. All features are whole numbers,
so sums over them are exact in any order.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.constants import CHUNK_ROWS, SEQUENCE_LENGTH
from wearline.functions.columns import as_list
from wearline.operators.frames import Values, chunk_frames, full_windows, own_rows

WIDTH, HEAVY = 9, 3


def kernel_places(count: int) -> list[tuple[int, ...]]:
    """``count`` of the choices of ``HEAVY`` heavy places out of ``WIDTH``, evenly spread over all of them."""
    every = list(combinations(range(WIDTH), HEAVY))
    return [every[i * len(every) // count] for i in range(count)]


def dilations(n: int) -> list[int]:
    return list(range(1, (n - 1) // (WIDTH - 1) + 1))


def kernel_columns(sensors: Sequence[str], n: int, kernels: int, levels: Mapping[str, Sequence[float]]) -> list[str]:
    conv = [f"{s}_k{d}_{j}" for s in sensors for d in dilations(n) for j in range(kernels)]
    return conv + [f"{s}_over{i}" for s in sensors for i in range(len(levels.get(s, ())))]


def _sum(columns: Sequence[np.ndarray]) -> np.ndarray:
    return reduce(lambda a, b: a + b, columns)


def kernel_features(
    df: DataFrame,
    sensors: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    kernels: int = 4,
    levels: Mapping[str, Sequence[float]] | None = None,
    keys: str | Iterable[str] = "unit",
    order: str = "cycle",
    chunk_rows: int | None = CHUNK_ROWS,
) -> DataFrame:
    """The rows of W6 (ends of full ``n``-row windows) with ``<sensor>_k<dilation>_<kernel>`` for
    ``kernels`` kernels a dilation, and ``<sensor>_over<i>`` for each of the sensor's ``levels``.

    A missing reading makes no sum positive and is above no level.
    """
    if n < WIDTH:
        raise ValueError(f"a window of {n} rows holds no kernel of {WIDTH}")
    keys, levels = as_list(keys), levels or {}
    names = kernel_columns(sensors, n, kernels, levels)
    places = kernel_places(kernels)
    frame, part = chunk_frames(df, keys, order, n - 1, chunk_rows)
    out = T.StructType([T.StructField(c, T.IntegerType()) for c in names])
    values = {s: F.col(s) for s in sensors}
    given = [[float(v) for v in levels.get(s, ())] for s in sensors]
    return own_rows(full_windows(frame, part, order, n, values, out, _counts(n, places, given)))


def _counts(n: int, places: Sequence[tuple[int, ...]], levels: Sequence[Sequence[float]]):
    """``compute`` of :func:`full_windows`: how often each flag is set within a window."""
    spans = dilations(n)

    def counted(flags: np.ndarray, there: list[np.ndarray], starts: np.ndarray, span: int) -> pa.Array:
        # a kernel fits where its first place lies in the window
        so_far = np.zeros(len(flags) + 1, np.int32)
        np.cumsum(reduce(np.logical_and, there, flags), out=so_far[1:])
        return pa.array(so_far[starts + n - span] - so_far[starts])

    def compute(values: list[Values], starts: np.ndarray) -> list[pa.Array]:
        out, over = [], []
        with np.errstate(all="ignore"):
            for (x, there), bars in zip(values, levels, strict=True):
                for d in spans:
                    span = d * (WIDTH - 1)
                    shifted = lambda a, d=d, span=span: [a[d * i : len(a) - span + d * i] for i in range(WIDTH)]
                    at, has = shifted(x), [] if there is None else shifted(there)
                    total = _sum(at)
                    out += [counted(_greater(HEAVY * _sum([at[i] for i in p]), total), has, starts, span) for p in places]
                over += [counted(_greater(x, np.full(len(x), v)), [] if there is None else [there], starts, 0) for v in bars]
        return out + over

    return compute


def _greater(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """As Spark compares doubles: NaN is above all others."""
    return (a > b) | (np.isnan(a) & ~np.isnan(b))
