"""Statistical column helpers: seeded uniforms, Poisson(1) weights, p-values.

Uniforms for the bootstrap come from integer hashing written with plain column arithmetic,
so they are identical on every executor, under any partitioning, and in DuckDB. A row is
hashed once (``md5`` of ``seed:key...``, 32 bits); each replicate then mixes the row hash
with the replicate number using the 32-bit integer mixer ``x ^= x >> 16; x *= 0x45d9f3b``
(twice) ``x ^= x >> 16``. Every product stays below 2**63, so ANSI overflow checks never fire.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK32 = 0xFFFFFFFF
MIX_MULT = 0x45D9F3B
REP_MULT = 0x9E3779B1


def row_hash32(keys: Iterable[str], seed: int) -> Column:
    """32-bit hash of a row key: the first 8 hex digits of ``md5("seed:key...")``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def mix32(x: Column) -> Column:
    x = (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(MIX_MULT)).bitwiseAND(F.lit(MASK32))
    x = (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(MIX_MULT)).bitwiseAND(F.lit(MASK32))
    return x.bitwiseXOR(F.shiftright(x, 16))


def replicate_uniform(row_hash: Column, rep: Column) -> Column:
    """Uniform in [0, 1) for (row, replicate)."""
    salt = (rep.cast("bigint") * F.lit(REP_MULT)).bitwiseAND(F.lit(MASK32))
    return mix32(row_hash.bitwiseXOR(salt)).cast("double") / F.lit(4294967296.0)


def poisson1_cdf() -> list[float]:
    """P(X <= k) for X ~ Poisson(1), k = 0, 1, ... up to the first value that is 1.0 in double."""
    out, term, acc, k = [], math.exp(-1.0), 0.0, 0
    while True:
        acc += term
        out.append(acc)
        if acc >= 1.0 or k > 40:
            return out
        k += 1
        term /= k


def poisson1_weight(u: Column) -> Column:
    """Inverse CDF of Poisson(1): the smallest ``k`` with ``u < P(X <= k)``.

    A ``CASE`` ladder in CDF order stops at the first match, about two comparisons on average.
    """
    steps = [c for c in poisson1_cdf() if c < 1.0]
    w = F.when(u < F.lit(steps[0]), F.lit(0))
    for k, c in enumerate(steps[1:], start=1):
        w = w.when(u < F.lit(c), F.lit(k))
    return w.otherwise(F.lit(len(steps)))


_TORN = 255


class ReplicateWeights:
    """The weights of ``poisson1_weight(replicate_uniform(...))`` for many rows at once, in numpy.

    A weight depends on the upper 16 bits of the mixed hash alone, but for the few values of
    those bits that hold a step of the distribution; there the whole hash decides.
    """

    def __init__(self, resamples: int) -> None:
        self.salt = (np.arange(resamples, dtype=np.uint64) * np.uint64(REP_MULT)).astype(np.uint32)
        self.steps = np.array([c for c in poisson1_cdf() if c < 1.0])
        low = np.arange(65536) * 65536.0
        of = lambda z: np.searchsorted(self.steps, z / 4294967296.0, "right")
        self.table = np.where(of(low) == of(low + 65535.0), of(low), _TORN).astype(np.uint8)

    def of(self, row_hash: np.ndarray) -> np.ndarray:
        """Rows x replicates."""
        out = np.empty((len(row_hash), len(self.salt)))
        # a few rows at once stay in the processor's cache
        for at in range(0, len(row_hash), 8):
            # 32-bit products wrap, which is the mixer's mask
            x = row_hash[at : at + 8].astype(np.uint32)[:, None] ^ self.salt[None]
            for _ in range(2):
                x ^= x >> np.uint32(16)
                x *= np.uint32(MIX_MULT)
            x ^= x >> np.uint32(16)
            weight = self.table.take(x >> np.uint32(16))
            row, rep = np.nonzero(weight == _TORN)
            weight[row, rep] = np.searchsorted(self.steps, x[row, rep].astype(np.float64) / 4294967296.0, "right")
            out[at : at + 8] = weight
        return out


# ---- p-values (evaluated on one aggregated row) ----

def normal_two_sided(z: float | None) -> float | None:
    if z is None or math.isnan(z):
        return None
    return math.erfc(abs(z) / math.sqrt(2.0))


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = tiny if abs(d) < tiny else d
    d = 1.0 / d
    h = d
    for m in range(1, 100_000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = tiny if abs(d) < tiny else d
        c = 1.0 + aa / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            return h
    return math.nan  # not converged: no p-value rather than a rough one


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_two_sided(t: float | None, dof: float | None) -> float | None:
    """Two-sided p of Student's t: I_{dof/(dof+t^2)}(dof/2, 1/2)."""
    if t is None or dof is None or dof <= 0 or math.isnan(t):
        return None
    if math.isinf(t):
        return 0.0
    if dof > 1e7:
        # the continued fraction loses digits here; this normal form errs by less than 1e-12
        return normal_two_sided(t * (1 - 1 / (4 * dof)) / math.sqrt(1 + t * t / (2 * dof)))
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


@F.pandas_udf(T.DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(None if pd.isna(a) else float(a), None if pd.isna(b) else float(b)) for a, b in zip(t, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_pvalue(z: pd.Series) -> pd.Series:
    return pd.Series([normal_two_sided(None if pd.isna(a) else float(a)) for a in z], dtype="float64")
