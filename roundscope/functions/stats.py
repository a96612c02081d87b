"""Closed statistics of counts as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.96


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def wilson(k, n, z: float = Z95) -> dict[str, Column]:
    """Rate and Wilson interval of k hits in n; NULL when n is not positive."""
    k, n = _d(k), _d(n)
    n = F.when(n > 0, n)
    p = k / n
    denom = 1 + z * z / n
    center = (p + z * z / (2 * n)) / denom
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / denom
    return {"rate": p, "ci_lo": center - half, "ci_hi": center + half}


def odds_ratio(a, b, c, d, zero: str = "haldane", z: float = Z95) -> dict[str, Column]:
    """Odds ratio (a·d)/(b·c) with Woolf interval.

    ``haldane`` adds one half to every cell when one is empty; ``floor1`` keeps the cells
    and reads empty denominators as one.
    """
    a, b, c, d = (_d(x) for x in (a, b, c, d))
    if zero == "haldane":
        bump = F.when(F.least(a, b, c, d) == 0, 0.5).otherwise(0.0)
        a, b, c, d = a + bump, b + bump, c + bump, d + bump
        ratio = F.try_divide(a * d, b * c)
        inverse = [F.try_divide(F.lit(1.0), x) for x in (a, b, c, d)]
    elif zero == "floor1":
        one = F.lit(1.0)
        ratio = a * d / F.greatest(one, b * c)
        inverse = [1 / F.greatest(one, x) for x in (a, b, c, d)]
    else:
        raise ValueError(f"unknown zero rule {zero!r}")
    se = F.sqrt(inverse[0] + inverse[1] + inverse[2] + inverse[3])
    log_ratio = F.when(ratio > 0, F.ln(ratio))
    return {
        "odds_ratio": ratio,
        "or_lo": F.exp(log_ratio - z * se),
        "or_hi": F.exp(log_ratio + z * se),
    }


def expected_cells(a, b, c, d) -> list[Column]:
    """Expected counts under independence; NULL when a margin is empty."""
    a, b, c, d = (_d(x) for x in (a, b, c, d))
    margins = [a + b, c + d, a + c, b + d]
    n = F.when(F.least(*margins) > 0, a + b + c + d)
    r0, r1, c0, c1 = margins
    return [r0 * c0 / n, r0 * c1 / n, r1 * c0 / n, r1 * c1 / n]


def chi2_yates(a, b, c, d, floor: float | None = None) -> Column:
    """Chi-squared statistic of a 2×2 table with continuity correction (one degree of freedom).

    NULL when a margin is empty. ``floor`` raises small cells to that value first.
    """
    cells = [_d(x) for x in (a, b, c, d)]
    if floor is not None:
        cells = [F.greatest(x, F.lit(float(floor))) for x in cells]
    total = None
    for observed, expected in zip(cells, expected_cells(*cells)):
        gap = F.abs(observed - expected)
        term = F.pow(gap - F.least(F.lit(0.5), gap), 2.0) / expected
        total = term if total is None else total + term
    return total


def stars(p) -> Column:
    """Mark of significance."""
    p = _d(p)
    return F.when(p < 1e-3, "***").when(p < 1e-2, "**").when(p < 0.05, "*").otherwise("")


def rejects(p, alpha: float = 0.05) -> Column:
    """Whether the null hypothesis is rejected at ``alpha``."""
    return _d(p) < alpha


def independence(a, b, c, d, floor: float | None = None) -> list[Column]:
    """chi2, its degrees of freedom and the expected counts of a 2×2 table; the last five are NULL where a margin is
    empty, as such a table cannot be tested. ``floor`` raises small cells for the statistic alone."""
    expected = expected_cells(a, b, c, d)
    dof = F.when(expected[0].isNotNull(), F.lit(1)).alias("dof")
    named = [e.alias(f"expected_{k}") for k, e in zip("abcd", expected)]
    return [chi2_yates(a, b, c, d, floor).alias("chi2"), dof, *named]
