"""The normal distribution's tails as column expressions (Spark SQL has no erf).

With a = |z| / sqrt(2): for a < 2 the series of erf, whose terms are all positive; beyond it the
continued fraction of erfc, whose logarithm needs no small number."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS, FRACTION_TERMS, TURN = 42, 60, 2.0


def _log_far_tail(z: Column) -> Column:
    """log P(Z > |z|)."""
    a = F.abs(z) / math.sqrt(2.0)
    near, far = F.least(a, F.lit(TURN)), F.greatest(a, F.lit(TURN))
    t = 2.0 * near * near
    coefficients = [1.0]
    for k in range(1, SERIES_TERMS):
        coefficients.append(coefficients[-1] / (2 * k + 1))
    series = F.aggregate(F.array(*[F.lit(c) for c in reversed(coefficients)]), F.lit(0.0), lambda s, c: s * t + c)
    by_series = F.log(0.5 - near * series * F.exp(-near * near) / math.sqrt(math.pi))
    fraction = F.aggregate(F.array(*[F.lit(k / 2.0) for k in range(FRACTION_TERMS, 0, -1)]), far, lambda f, c: far + c / f)
    by_fraction = -far * far - math.log(2.0 * math.sqrt(math.pi)) - F.log(fraction)
    return F.when(z.isNull(), None).when(a < TURN, by_series).otherwise(by_fraction)


def log_normal_tails(z: Column) -> tuple[Column, Column]:
    """(log P(Z < z), log P(Z > z)) of the standard normal; NULL for NULL, NaN for NaN."""
    far = _log_far_tail(z)
    rest = F.log1p(-F.exp(far))
    up = z >= 0
    return F.when(up, rest).when(~up, far), F.when(up, far).when(~up, rest)


def chi2_1_sf(x: Column) -> Column:
    """Upper tail of chi-squared with one degree of freedom, P(|Z| > sqrt(x)); NULL below 0."""
    return F.when(x >= 0, 2.0 * F.exp(_log_far_tail(F.sqrt(x))))


def log_far_tail_sql(z: str) -> str:
    """The same logarithm as SQL for the oracles, sums and fractions written out; ``z`` names a column."""
    near, far = f"least(abs({z}) / sqrt(2.0), {TURN})", f"greatest(abs({z}) / sqrt(2.0), {TURN})"
    series, fraction = "0.0", far
    for k in range(SERIES_TERMS - 1, 0, -1):
        series = f"2.0 * {near} * {near} / {2 * k + 1} * (1.0 + {series})"
    for k in range(FRACTION_TERMS, 0, -1):
        fraction = f"({far} + {k / 2.0} / {fraction})"
    return (f"(CASE WHEN abs({z}) < {TURN} * sqrt(2.0) THEN ln(0.5 - {near} * exp(-{near} * {near}) / sqrt(pi()) * (1.0 + {series})) "
            f"ELSE -{far} * {far} - ln(2 * sqrt(pi())) - ln({fraction}) END)")
