"""Shapiro-Wilk normality test (MET15) per group, for groups under 5000 rows.

The test needs every residual of a group sorted together, which is why it is only defined
for n < 5000: each segment (model, split, region, ...) is one ``applyInPandas`` group, so the
work spreads over segments and no group exceeds 5000 rows. Groups at or above the limit get
NULL, as the original skips the test there. The W statistic and its p-value follow Royston's
1995 approximation (algorithm AS R94)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stored

MAX_N = 5000

# Polynomial coefficients of the AS R94 approximation.
C1 = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
C2 = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
C3 = (0.544, -0.39978, 0.025054, -6.714e-4)
C4 = (1.3822, -0.77857, 0.062767, -0.0020322)
C5 = (-1.5861, -0.31082, -0.083751, 0.0038915)
C6 = (-0.4803, -0.082676, 0.0030302)
G = (-2.273, 0.459)

# Coefficients of Acklam's rational approximation of the normal quantile.
QA = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
      -3.066479806614716e+01, 2.506628277459239e+00)
QB = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
      -1.328068155288572e+01)
QC = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
      4.374664141464968e+00, 2.938163982698783e+00)
QD = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00)


def _poly(c, x):
    return sum(ci * x ** i for i, ci in enumerate(c))


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    """Normal quantile: rational approximation refined by one Halley step."""
    lo = 0.02425
    if p < lo:
        q = math.sqrt(-2 * math.log(p))
        x = (((((QC[0] * q + QC[1]) * q + QC[2]) * q + QC[3]) * q + QC[4]) * q + QC[5]) / \
            ((((QD[0] * q + QD[1]) * q + QD[2]) * q + QD[3]) * q + 1)
    elif p <= 1 - lo:
        q = p - 0.5
        r = q * q
        x = (((((QA[0] * r + QA[1]) * r + QA[2]) * r + QA[3]) * r + QA[4]) * r + QA[5]) * q / \
            (((((QB[0] * r + QB[1]) * r + QB[2]) * r + QB[3]) * r + QB[4]) * r + 1)
    else:
        q = math.sqrt(-2 * math.log(1 - p))
        x = -(((((QC[0] * q + QC[1]) * q + QC[2]) * q + QC[3]) * q + QC[4]) * q + QC[5]) / \
            ((((QD[0] * q + QD[1]) * q + QD[2]) * q + QD[3]) * q + 1)
    e = norm_cdf(x) - p
    u = e * math.sqrt(2 * math.pi) * math.exp(x * x / 2)
    return x - u / (1 + x * u / 2)


def shapiro_wilk(x: np.ndarray) -> tuple[float, float]:
    """(W, p-value) of one sample, 3 ≤ n < 5000."""
    x = np.sort(np.asarray(x, dtype=float))
    n = len(x)
    if n < 3:
        return float("nan"), float("nan")
    half = n // 2
    if n == 3:
        a = np.array([math.sqrt(0.5)])
    else:
        m = np.array([-norm_ppf((i - 0.375) / (n + 0.25)) for i in range(1, half + 1)])   # positive, descending
        summ2 = 2.0 * float(np.sum(m ** 2)) + (norm_ppf(0.5) ** 2 if n % 2 else 0.0)
        ssumm2 = math.sqrt(summ2)
        rsn = 1.0 / math.sqrt(n)
        a1 = _poly(C1, rsn) + m[0] / ssumm2
        if n > 5:
            a2 = _poly(C2, rsn) + m[1] / ssumm2
            fac = math.sqrt((summ2 - 2 * m[0] ** 2 - 2 * m[1] ** 2) / (1 - 2 * a1 ** 2 - 2 * a2 ** 2))
            a = m / fac
            a[0], a[1] = a1, a2
        else:
            fac = math.sqrt((summ2 - 2 * m[0] ** 2) / (1 - 2 * a1 ** 2))
            a = m / fac
            a[0] = a1
    full = np.zeros(n)
    full[:half] = -a
    full[n - half:] = a[::-1]
    xc = x - x.mean()
    ac = full - full.mean()
    ssx = float(np.sum(xc ** 2))
    if ssx == 0:
        return float("nan"), float("nan")
    w = float(np.sum(ac * xc) ** 2 / (np.sum(ac ** 2) * ssx))
    w = min(w, 1.0)
    if n == 3:
        p = max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
        return w, min(p, 1.0)
    y = math.log(1 - w) if w < 1 else -math.inf
    an = float(n)
    if n <= 11:
        gamma = _poly(G, an)
        if y >= gamma:
            return w, 1e-99
        y = -math.log(gamma - y)
        mu, sd = _poly(C3, an), math.exp(_poly(C4, an))
    else:
        xx = math.log(an)
        mu, sd = _poly(C5, xx), math.exp(_poly(C6, xx))
    return w, 0.5 * math.erfc((y - mu) / sd / math.sqrt(2.0))


def shapiro_by_group(df: DataFrame, y: str, pred: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """(group..., n, statistic, p_value, is_normal) per group; NULL statistic when n ≥ 5000."""
    g = list(group_cols) or ["_all"]
    src = df if group_cols else df.withColumn("_all", F.lit(0))
    d = src.select(*g, (F.col(y).cast("double") - F.col(pred).cast("double")).alias("_e")).where(F.col("_e").isNotNull())
    # stored, so the planner knows its size: rows of large groups are dropped where they are read, not after an exchange
    sizes = stored(d.groupBy(*g).agg(F.count(F.lit(1)).alias("n")))
    small = d.join(sizes.where(F.col("n") < MAX_N).select(*g), g)
    types = dict(src.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in g] + ["statistic double", "p_value double"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        w, p = shapiro_wilk(pdf["_e"].to_numpy())
        row = {c: pdf[c].iloc[0] for c in g}
        row.update(statistic=w, p_value=p)
        return pd.DataFrame([row])

    tested = small.groupBy(*g).applyInPandas(run, schema)
    out = sizes.join(tested, g, "left").withColumn("is_normal", (F.col("p_value") > 0.05).cast("int"))
    return out.drop("_all") if not group_cols else out
