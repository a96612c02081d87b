"""Tail probabilities: Arrow UDFs applied to one row per test, after Spark has counted."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# The functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CHUNK = 4096


def _per_row(fn, *series: pd.Series) -> pd.Series:
    def one(*args):
        if any(x is None or x != x for x in args):
            return None
        return fn(*args)

    return pd.Series([one(*row) for row in zip(*series)], dtype="float64")


# --- normal and chi-squared tails -------------------------------------------------------


def chi2_tail(x: float) -> float:
    """Upper tail of chi-squared with one degree of freedom."""
    return math.erfc(math.sqrt(max(x, 0.0) / 2))


def normal_tail(z: float) -> float:
    """Upper tail of the standard normal."""
    return 0.5 * math.erfc(z / math.sqrt(2))


# --- point probabilities by saddle point, accurate for counts far beyond lgamma's reach ---


def _stirling_rest(n: float) -> float:
    if n < 16:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi) if n > 0 else 0.0
    n2 = n * n
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / n2) / n2) / n2) / n


def _deviance(x: float, mean: float) -> float:
    """x·ln(x/mean) + mean − x without cancellation near x = mean."""
    if abs(x - mean) < 0.1 * (x + mean):
        v = (x - mean) / (x + mean)
        total, term, j = (x - mean) * v, 2 * x * v, 1
        while True:
            term *= v * v
            step = term / (2 * j + 1)
            if total + step == total:
                return total
            total += step
            j += 1
    return x * math.log(x / mean) + mean - x


def log_binomial(k: float, n: float, p: float) -> float:
    """Log probability of k hits in n draws."""
    q = 1 - p
    if k == 0:
        return n * math.log1p(-p) if q > 0 else (0.0 if n == 0 else -math.inf)
    if k == n:
        return n * math.log(p)
    rest = _stirling_rest(n) - _stirling_rest(k) - _stirling_rest(n - k)
    rest -= _deviance(k, n * p) + _deviance(n - k, n * q)
    return rest - 0.5 * math.log(2 * math.pi * k * ((n - k) / n))


def log_hypergeometric(k: int, row: int, other: int, col: int) -> float:
    """Log probability that k of the ``col`` drawn come from the ``row`` items."""
    n = row + other
    if col == 0 or col == n or row == 0 or other == 0:
        return 0.0
    p = col / n
    return log_binomial(k, row, p) + log_binomial(col - k, other, p) - log_binomial(col, n, p)


# --- exact tests ------------------------------------------------------------------------


def _run(ratio, k: int, step: int, last: int) -> float:
    """Sum of the probabilities from k towards ``last``, relative to the one at k.

    ``ratio(ks)`` is p(ks + step) / p(ks); the sum stops once terms no longer count.
    """
    total, log_here = 1.0, 0.0
    while k != last:
        size = min(_CHUNK, abs(last - k))
        ks = k + step * np.arange(size, dtype=np.float64)
        with np.errstate(divide="ignore"):
            logs = log_here + np.cumsum(np.log(ratio(ks)))
        total += float(np.exp(logs).sum())
        log_here = float(logs[-1])
        if log_here < math.log(total) - 45 and logs[-1] <= logs[0]:
            break
        k += step * size
    return total


def _as_likely(log_p, mode: int, edge: int, limit: float) -> int | None:
    """The value nearest the mode, on the side of ``edge``, whose log probability is within ``limit``."""
    if log_p(edge) > limit:
        return None
    near, far = mode, edge
    while abs(far - near) > 1:
        mid = (near + far) // 2
        if log_p(mid) <= limit:
            far = mid
        else:
            near = mid
    return far


def _two_sided(k: int, lo: int, hi: int, mode: int, log_p, up) -> float:
    """Probability of all values no likelier than k (up to 1e-7)."""
    limit = log_p(k) + math.log1p(1e-7)
    if log_p(mode) <= limit:
        return 1.0

    def down(ks):
        return 1 / up(ks - 1)

    if k < mode:
        p = math.exp(log_p(k)) * _run(down, k, -1, lo)
        other = _as_likely(log_p, mode, hi, limit)
        if other is not None:
            p += math.exp(log_p(other)) * _run(up, other, 1, hi)
    else:
        p = math.exp(log_p(k)) * _run(up, k, 1, hi)
        other = _as_likely(log_p, mode, lo, limit)
        if other is not None:
            p += math.exp(log_p(other)) * _run(down, other, -1, lo)
    return min(1.0, p)


def fisher_exact(a: int, b: int, c: int, d: int, alternative: str = "two-sided") -> float:
    """Fisher's exact test of [[a, b], [c, d]]; ``greater`` looks for a large ``a``."""
    a, b, c, d = int(a), int(b), int(c), int(d)
    row, other, col = a + b, c + d, a + c
    lo, hi = max(0, col - other), min(row, col)
    if lo == hi:
        return 1.0

    def log_p(k):
        return log_hypergeometric(k, row, other, col)

    def up(ks):
        return (row - ks) / (ks + 1) * ((col - ks) / (other - col + ks + 1))

    if alternative == "greater":
        mean = row * (col / (row + other))
        if a > mean:
            return min(1.0, math.exp(log_p(a)) * _run(up, a, 1, hi))
        if a == lo:
            return 1.0
        below = math.exp(log_p(a - 1)) * _run(lambda ks: 1 / up(ks - 1), a - 1, -1, lo)
        return min(1.0, max(0.0, 1.0 - below))
    mode = min(hi, max(lo, (row + 1) * (col + 1) // (row + other + 2)))
    return _two_sided(a, lo, hi, mode, log_p, up)


def binomial_test(k: int, n: int, p: float = 0.5) -> float | None:
    """Exact two-sided binomial test."""
    k, n = int(k), int(n)
    if n <= 0:
        return None
    mode = min(n, int((n + 1) * p))
    return _two_sided(
        k, 0, n, mode, lambda x: log_binomial(x, n, p), lambda ks: (n - ks) / (ks + 1) * (p / (1 - p))
    )


# --- columns ----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def p_chi2(statistic) -> Column:
    @F.pandas_udf("double")
    def udf(x: pd.Series) -> pd.Series:
        return _per_row(chi2_tail, x)

    return udf(_col(statistic).cast("double"))


def p_normal(z) -> Column:
    """Upper tail of the standard normal."""

    @F.pandas_udf("double")
    def udf(x: pd.Series) -> pd.Series:
        return _per_row(normal_tail, x)

    return udf(_col(z).cast("double"))


def p_fisher(a, b, c, d, alternative: str = "two-sided") -> Column:
    if alternative not in ("two-sided", "greater"):
        raise ValueError(f"unknown alternative {alternative!r}")

    @F.pandas_udf("double")
    def udf(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return _per_row(lambda *cells: fisher_exact(*cells, alternative), a, b, c, d)

    return udf(*(_col(x).cast("bigint") for x in (a, b, c, d)))


def p_binomial(k, n, p: float = 0.5) -> Column:
    @F.pandas_udf("double")
    def udf(k: pd.Series, n: pd.Series) -> pd.Series:
        return _per_row(lambda x, m: binomial_test(x, m, p), k, n)

    return udf(_col(k).cast("bigint"), _col(n).cast("bigint"))
