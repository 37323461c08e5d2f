"""Scalers fitted on one frame and applied to any other (SCL1-SCL3, SCL5).

Semantics follow the usual array scalers: standard uses the POPULATION std, a zero scale is
replaced by 1, min-max maps a constant column to 0, robust uses the exact median and IQR.
Spark ML's StandardScaler (sample std) and MinMaxScaler (0.5 for constants) differ, so the
fitted state here is a small table of (center, scale) per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.profile import missing_expr
from ledgerlens.operators.quantile import column_quantiles


def fit_scaler(df: DataFrame, cols: Sequence[str], method: str = "standard", with_mean: bool = True,
               quantile_method: str = "exact") -> dict[str, tuple[float, float]]:
    cols = list(cols)
    if method not in ("standard", "minmax", "robust"):
        method = "standard"      # unknown names fall back to standard scaling
    if method == "robust":
        qs = column_quantiles(df, cols, [0.25, 0.5, 0.75], method=quantile_method)
        out = {}
        for c in cols:
            q1, med, q3 = qs[c]
            iqr = (q3 - q1) if q1 is not None else None
            out[c] = (med or 0.0, iqr if iqr else 1.0)
        return out
    exprs = []
    for i, c in enumerate(cols):
        v = F.when(~missing_expr(df, c), F.col(c).cast("double"))
        if method == "standard":
            exprs += [F.avg(v).alias(f"a{i}"), F.stddev_pop(v).alias(f"b{i}")]
        else:
            exprs += [F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}")]
    row = df.agg(*exprs).first()
    out = {}
    for i, c in enumerate(cols):
        a, b = row[f"a{i}"], row[f"b{i}"]
        if method == "standard":
            out[c] = ((a or 0.0) if with_mean else 0.0, b if b else 1.0)
        else:
            rng = (b - a) if a is not None else None
            out[c] = (a or 0.0, rng if rng else 1.0)
    return out


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    cols = {f"{c}{suffix}": (F.col(c).cast("double") - F.lit(center)) / F.lit(scale) for c, (center, scale) in params.items()}
    return df.withColumns(cols)


def scale_features(train: DataFrame, test: DataFrame, cols: Sequence[str], method: str = "standard"):
    """Fit on ``train``, transform both."""
    params = fit_scaler(train, cols, method)
    return apply_scaler(train, params), apply_scaler(test, params), params
