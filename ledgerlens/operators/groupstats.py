"""Group statistics broadcast back to rows (AGG1-AGG9), seasonal averages (AGG10-AGG14) and
customer statistics (AGG15, JN1).

Instead of one window (or pandas transform) per statistic, each key gets ONE aggregation with
every statistic of every target, and one left join back to the rows. NULL keys form no group,
so their rows get NULL features (pandas drops NaN keys in ``groupby``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.quantile import group_quantiles
from ledgerlens.session import stored

DEFAULT_KEYS = ("region", "category", "sub_category", "product_id", "year", "month", "quarter", "day_of_week")
TARGETS = ("quantity", "profit")
# keys whose number of distinct values is fixed by the calendar: safe to broadcast
MONEY = "decimal(18,4)"
BOUNDED_KEYS = {"month": 12, "quarter": 4, "day_of_week": 7, "day": 31, "is_weekend": 2}


def attach(df: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Lookup join (JN3). A table keyed by a calendar field is broadcast (its size is bounded
    by the calendar); any other is left to AQE, which broadcasts it only after measuring it."""
    if key in BOUNDED_KEYS:
        table = F.broadcast(table)
    return df.join(table, key, how)


def group_stats(df: DataFrame, key: str, targets: Sequence[str] = TARGETS, quantile_method: str = "exact", cheap: bool = False) -> DataFrame:
    """One row per key value with mean/std/median/min/max/q25/q75 per target and ``{key}_count``
    (non-NULL count of the last target). ``cheap``: ``df`` can be read again cheaply."""
    present = [t for t in targets if t in df.columns]
    keyed = df.where(F.col(key).isNotNull()).select(key, *present)
    if present and not cheap:
        keyed = stored(keyed)
    aggs = []
    for t in present:
        aggs += [F.avg(t).alias(f"{t}_{key}_mean"), F.stddev_samp(t).alias(f"{t}_{key}_std"),
                 F.min(t).alias(f"{t}_{key}_min"), F.max(t).alias(f"{t}_{key}_max")]
    if present:
        aggs.append(F.count(present[-1]).alias(f"{key}_count"))
    moments = keyed.groupBy(key).agg(*aggs)
    if not present:
        return moments
    # all targets in one quantile computation: stack (target, value) and group by (key, target)
    stacked = keyed.select(key, F.explode(F.array(*[F.struct(F.lit(t).alias("_tname"), F.col(t).cast("double").alias("_tv"))
                                                      for t in present])).alias("_s"))
    stacked = stacked.select(key, "_s._tname", "_s._tv")
    qs = group_quantiles(stacked, "_tv", [0.5, 0.25, 0.75], by=[key, "_tname"], names=["_med", "_q25", "_q75"],
                         method=quantile_method, stored=True)
    qcols = []
    for t in present:
        for src, stat in (("_med", "median"), ("_q25", "q25"), ("_q75", "q75")):
            qcols.append(F.max(F.when(F.col("_tname") == t, F.col(src))).alias(f"{t}_{key}_{stat}"))
    qwide = qs.groupBy(key).agg(*qcols)
    out = moments.join(qwide, key, "left")
    order = [key]
    for t in present:
        order += [f"{t}_{key}_{s}" for s in ("mean", "std", "median", "min", "max", "q25", "q75")]
    order.append(f"{key}_count")
    return out.select(*order)


def add_group_stats(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, targets: Sequence[str] = TARGETS,
                    quantile_method: str = "exact") -> DataFrame:
    """AGG9: statistics of every present key joined back to the rows (left joins); the rows are computed
    once."""
    df = stored(df)
    out = df
    for key in keys:
        if key in df.columns:
            out = attach(out, stored(group_stats(df, key, targets, quantile_method, cheap=True)), key)
    return out


def seasonal_features(df: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """AGG10-AGG14: historical averages by month / day of week / quarter, deviations and
    seasonal indices (group average over the overall average; a zero overall average gives
    ±Infinity/NaN as in numpy)."""
    from ledgerlens.functions.mathx import ieee_divide

    present = [t for t in targets if t in df.columns]
    labels = {"month": "monthly", "day_of_week": "dow", "quarter": "quarter"}
    # the rows are read once: sums per calendar cell (bounded by the calendar), averages from those
    cells = stored(df.groupBy(*labels).agg(*[f(F.col(t).cast("double")).alias(f"_{f.__name__}_{t}") for t in present for f in (F.sum, F.count)]))
    mean = {t: F.try_divide(F.sum(f"_sum_{t}"), F.sum(f"_count_{t}")) for t in present}
    overall = cells.agg(*[mean[t].alias(t) for t in present]).first()
    out = df
    for key, label in labels.items():
        tab = cells.where(F.col(key).isNotNull()).groupBy(key).agg(*[mean[t].alias(f"{t}_{label}_historical_avg") for t in present])
        out = attach(out, tab, key)
    cols = []
    for t in present:
        cols += [
            (F.col(t) - F.col(f"{t}_monthly_historical_avg")).alias(f"{t}_seasonal_deviation_month"),
            (F.col(t) - F.col(f"{t}_quarter_historical_avg")).alias(f"{t}_seasonal_deviation_quarter"),
            ieee_divide(F.col(f"{t}_monthly_historical_avg"), F.lit(overall[t])).alias(f"{t}_seasonal_index_month"),
            ieee_divide(F.col(f"{t}_quarter_historical_avg"), F.lit(overall[t])).alias(f"{t}_seasonal_index_quarter"),
        ]
    return out.select("*", *cols)


def customer_stats(df: DataFrame, customer: str = "customer_id", sales: str = "sales", profit: str = "profit") -> DataFrame:
    """AGG15 + MTH15: order count, total sales, average order value, total profit per
    customer, rounded half-to-even to 2 places. Totals are summed as decimals (money has at
    most 4 places here), so they do not depend on the summation order across tasks."""
    return (df.where(F.col(customer).isNotNull()).groupBy(customer).agg(
        F.count(sales).alias("order_count"),
        F.bround(F.sum(F.col(sales).cast(MONEY)), 2).cast("double").alias("total_sales"),
        F.bround(F.avg(sales), 2).alias("avg_order_value"),
        F.bround(F.sum(F.col(profit).cast(MONEY)), 2).cast("double").alias("total_profit")))


def add_customer_stats(df: DataFrame, customer: str = "customer_id", sales: str = "sales", profit: str = "profit",
                       source: DataFrame | None = None) -> DataFrame:
    """JN1: left join of the customer statistics (strategy chosen by AQE from the measured size). ``source``: the
    same rows before other steps widened them."""
    return df.join(customer_stats(df if source is None else source, customer, sales, profit), customer, "left")
