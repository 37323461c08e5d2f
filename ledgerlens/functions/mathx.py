"""Scalar math, guarded division, binning and infinity handling (MTH1-2, MTH9-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category labels of the business indicators (must equal the original labels).
MARGIN_LABELS = ("Pérdida", "Bajo", "Medio", "Alto")   # (-inf,0], (0,10], (10,20], (20,inf)
MONTH_TIER_LABELS = ("Q1", "Q2", "Q3", "Q4")            # (0,3], (3,6], (6,9], (9,12]
WEEKEND_LABELS = ("Weekend", "Weekday")

POS_INF = float("inf")
NEG_INF = float("-inf")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def log_abs(c) -> Column:
    """MTH1: log1p(|x|)."""
    return F.log1p(F.abs(_c(c)))


def sqrt_abs(c) -> Column:
    """MTH2: sqrt(|x|)."""
    return F.sqrt(F.abs(_c(c)))


def ieee_divide(num, den) -> Column:
    """num / den with IEEE results on a zero divisor (±Infinity, NaN for 0/0), as numpy does.
    Spark's ANSI ``/`` would raise; ``try_divide`` would give NULL."""
    num, den = _c(num).cast("double"), _c(den).cast("double")
    return (F.when(den.isNull() | num.isNull(), F.lit(None).cast("double"))
            .when(den != 0, num / den)
            .when(num > 0, F.lit(POS_INF))
            .when(num < 0, F.lit(NEG_INF))
            .otherwise(F.lit(float("nan"))))


def is_finite(c) -> Column:
    c = _c(c)
    return ~(F.isnan(c) | (c == POS_INF) | (c == NEG_INF))


def profit_margin(profit="profit", sales="sales") -> Column:
    """MTH9: profit / sales * 100."""
    return ieee_divide(profit, sales) * 100.0


def margin_category(m) -> Column:
    """MTH10: right-closed bins (-inf,0], (0,10], (10,20], (20,inf]; -inf and NaN -> NULL."""
    m = _c(m)
    ok = m.isNotNull() & ~F.isnan(m) & (m > NEG_INF)
    return (F.when(~ok, F.lit(None).cast("string"))
            .when(m <= 0, MARGIN_LABELS[0])
            .when(m <= 10, MARGIN_LABELS[1])
            .when(m <= 20, MARGIN_LABELS[2])
            .otherwise(MARGIN_LABELS[3]))


def weekend_label(is_weekend) -> Column:
    """MTH12."""
    return F.when(_c(is_weekend) == 1, WEEKEND_LABELS[0]).otherwise(WEEKEND_LABELS[1])


def month_tier(month) -> Column:
    """MTH13: (0,3] -> Q1 ... (9,12] -> Q4, others NULL."""
    m = _c(month)
    return (F.when((m > 0) & (m <= 3), MONTH_TIER_LABELS[0])
            .when((m > 3) & (m <= 6), MONTH_TIER_LABELS[1])
            .when((m > 6) & (m <= 9), MONTH_TIER_LABELS[2])
            .when((m > 9) & (m <= 12), MONTH_TIER_LABELS[3]))


def inf_to(c, value=0.0) -> Column:
    """MTH14: ±Infinity -> value (NaN untouched)."""
    c = _c(c)
    return F.when((c == POS_INF) | (c == NEG_INF), F.lit(value)).otherwise(c)


def non_finite_to(c, value=0.0) -> Column:
    """MTH14 + IMP4: ±Infinity, NaN and NULL -> value."""
    c = _c(c)
    return F.when(c.isNull() | ~is_finite(c), F.lit(value)).otherwise(c)


def round_half_even(c, places: int = 2) -> Column:
    """MTH15: numpy-style rounding (half to even)."""
    return F.bround(_c(c), places)
