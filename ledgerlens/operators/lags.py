"""Lag, rolling, trend and rank features (WIN1-WIN13, SRT1, MTH5-6, MTH11).

All row-sequence features use the range partitions of the fixed total order (``ORDER_COLS``) and edge
rows (``edges``), so a key holding a third of all rows is split across tasks and nothing is numbered
or cut twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.mathx import ieee_divide
from ledgerlens.operators.edges import edge_window, fill_forward, sequenced
from ledgerlens.operators.quantile import column_quantiles
from ledgerlens.operators.sequence import ordered_positions
from ledgerlens.session import stored
from ledgerlens.sources.tables import ORDER_COLS

TARGETS = ("quantity", "profit")
EPS = 1e-8
GIDX = "_gidx"
SMALL_TABLE = 100_000  # distinct values up to which their ranks are sent to all executors


def with_global_index(df: DataFrame, order: Sequence[str] = ORDER_COLS, out: str = GIDX) -> DataFrame:
    """SRT1: a number that ascends in the total order; rows stay on the range partitions of the order."""
    return sequenced(df, order, out)


def product_lags(df: DataFrame, key: str = "product_id", targets: Sequence[str] = TARGETS, pos: str = GIDX) -> DataFrame:
    """WIN1-WIN3: lag 1/3/7, rolling mean and sample std over 3 and 7 rows, per key."""
    present = [t for t in targets if t in df.columns]

    def cols(w):
        out = {}
        for t in present:
            out[f"{t}_lag1"] = F.lag(t, 1).over(w)
            out[f"{t}_lag3"] = F.lag(t, 3).over(w)
            out[f"{t}_lag7"] = F.lag(t, 7).over(w)
            out[f"{t}_rolling_mean_3"] = F.avg(t).over(w.rowsBetween(-2, 0))
            out[f"{t}_rolling_mean_7"] = F.avg(t).over(w.rowsBetween(-6, 0))
            out[f"{t}_rolling_std_3"] = F.stddev_samp(t).over(w.rowsBetween(-2, 0))
            out[f"{t}_rolling_std_7"] = F.stddev_samp(t).over(w.rowsBetween(-6, 0))
        return out

    return edge_window(df, pos, 7, present, cols, key, df)


def rolling_by(df: DataFrame, key: str, targets: Sequence[str] = TARGETS, window: int = 7,
               pos: str = GIDX, name: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """WIN4/WIN5: rolling mean over ``window`` rows per ``key`` (e.g. category, region). ``source``: the rows
    before other steps widened them."""
    present = [t for t in targets if t in df.columns]
    label = name or key
    return edge_window(df, pos, window - 1, present,
                       lambda w: {f"{t}_{label}_rolling_mean_{window}": F.avg(t).over(w.rowsBetween(-(window - 1), 0)) for t in present},
                       key, df if source is None else source)


def lag_features(df: DataFrame, targets: Sequence[str] = TARGETS, pos: str = GIDX, fill: str = "ffill") -> DataFrame:
    """PIP1 step 4: product lags/rolling, category and region rolling means, then the fill
    of WIN6: global forward fill in date order then 0 (``fill='zero'`` skips the carry)."""
    d = product_lags(df, "product_id", targets, pos)
    for key in ("category", "region"):
        if key in df.columns:
            d = rolling_by(d, key, targets, 7, pos, source=df)
    return _fill(d, [c for c in d.columns if c not in df.columns and ("lag" in c or "rolling" in c)], pos, fill)


def _fill(d: DataFrame, cols: list[str], pos: str, fill: str) -> DataFrame:
    return fill_forward(stored(d), pos, cols, fill=0.0) if fill == "ffill" else d.fillna(0.0, subset=cols)


def trend_features(df: DataFrame, targets: Sequence[str] = TARGETS, pos: str = GIDX, fill: str = "ffill") -> DataFrame:
    """WIN7-WIN11: differences, ratios, momentum and volatility in the global order, then
    forward fill and 0."""
    present = [t for t in targets if t in df.columns]

    def cols(w):
        out = {}
        for t in present:
            c = F.col(t)
            out[f"{t}_diff1"] = c - F.lag(t, 1).over(w)
            out[f"{t}_diff7"] = c - F.lag(t, 7).over(w)
            out[f"{t}_diff30"] = c - F.lag(t, 30).over(w)
            out[f"{t}_ratio1"] = ieee_divide(c, F.lag(t, 1).over(w) + EPS)
            out[f"{t}_ratio7"] = ieee_divide(c, F.lag(t, 7).over(w) + EPS)
            out[f"{t}_momentum_3"] = ieee_divide(c, F.lag(t, 3).over(w) + EPS)
            out[f"{t}_momentum_7"] = ieee_divide(c, F.lag(t, 7).over(w) + EPS)
            out[f"{t}_volatility"] = ieee_divide(F.stddev_samp(t).over(w.rowsBetween(-6, 0)),
                                                 F.avg(t).over(w.rowsBetween(-6, 0)) + EPS)
        return out

    d = edge_window(df, pos, 30, present, cols)
    return _fill(d, [c for c in d.columns if c not in df.columns], pos, fill)


def percentile_rank(df: DataFrame, col: str, out: str | None = None, source: DataFrame | None = None) -> DataFrame:
    """WIN12/WIN13: pandas ``rank(pct=True)`` (average ties). Values are first counted per
    distinct value, the counts are accumulated range-partition-wise, and the rank is joined
    back on the value (AQE splits a hot value's join partition). ``source``: the same rows before other steps
    widened them. The counts are made once, the number of rows is taken from the numbered ones."""
    out = out or f"{col}_percentile_rank"
    read = df if source is None else source
    valid = read.where(F.col(col).isNotNull() & ~F.isnan(col))
    vc = valid.groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = ordered_positions(vc, [col], weight="_cnt", out="_before")
    n, values = ranked.agg(F.max(F.col("_before") + F.col("_cnt")), F.count(F.lit(1))).first()
    table = ranked.select(col, ((F.col("_before") + (F.col("_cnt") + 1) / 2.0) / F.lit(float(n) if n else None)).alias(out))
    return df.join(F.broadcast(table) if values <= SMALL_TABLE else table, col, "left")


def statistical_features(df: DataFrame, targets: Sequence[str] = TARGETS, quantile_method: str = "exact") -> DataFrame:
    """PIP1 step 5: z-score (sample std), IQR outlier flag, percentile rank, log1p|x|, sqrt|x|."""
    from ledgerlens.functions.mathx import log_abs, sqrt_abs

    present = [t for t in targets if t in df.columns]
    if not present:
        return df
    prof = df.agg(*[F.avg(t).alias(f"m_{t}") for t in present], *[F.stddev_samp(t).alias(f"s_{t}") for t in present]).first()
    out = df
    cols = []
    quart = column_quantiles(df, present, [0.25, 0.75], method=quantile_method)   # all targets in one computation
    for t in present:
        q1, q3 = quart[t]
        iqr = (q3 - q1) if q1 is not None else None
        c = F.col(t)
        cols.append(ieee_divide(c - F.lit(prof[f"m_{t}"]), F.lit(prof[f"s_{t}"])).alias(f"{t}_zscore"))
        if iqr is None:
            cols.append(F.lit(0).alias(f"{t}_is_outlier"))
        else:
            cols.append(F.coalesce(((c < q1 - 1.5 * iqr) | (c > q3 + 1.5 * iqr)).cast("int"), F.lit(0)).alias(f"{t}_is_outlier"))
        cols.append(log_abs(c).alias(f"{t}_log"))
        cols.append(sqrt_abs(c).alias(f"{t}_sqrt"))
    out = out.select("*", *cols)
    for t in present:
        out = percentile_rank(out, t, f"{t}_percentile_rank", source=df)
    return out
