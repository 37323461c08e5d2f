"""Feature pipelines: PRJ1 (essential columns), PIP1 (7-step feature builder), PIP2 (business
indicators). Each step widens the frame with ONE select; long plans are cut with a reliable
checkpoint between the steps that need a global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import mathx, temporal
from ledgerlens.functions.interactions import interaction_columns
from ledgerlens.operators import groupstats, lags
from ledgerlens.operators.quantile import quantiles
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources.tables import ORDER_COLS

TARGETS = ("quantity", "profit")
ESSENTIAL = ["region", "product_id", "category", "sub_category", "product_name",
             "year", "month", "day", "order_date", "quantity", "profit"]
REQUIRED = ["region", "product_id", "category", "sub_category", "product_name"]


def with_date_parts(df: DataFrame, date: str = "order_date") -> DataFrame:
    """DT2: year, month, day from the order date."""
    return df.withColumns(temporal.date_parts(date))


def essential(df: DataFrame, extra: Sequence[str] = (), date: str = "order_date") -> DataFrame:
    """PRJ1 + FIL1: date parts, the essential projection (plus ``extra`` columns kept for
    ordering or later joins) and rows with all required keys present."""
    if date not in df.columns:
        raise ValueError(f"missing date column {date!r}")
    d = with_date_parts(df, date)
    cols = ESSENTIAL + [c for c in extra if c not in ESSENTIAL]
    return d.select(*cols).dropna(subset=REQUIRED)


def fit_date_range(df: DataFrame, date: str = "order_date"):
    row = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).first()
    return row["lo"], row["hi"]


def temporal_features(df: DataFrame, date: str = "order_date", date_range=None) -> DataFrame:
    """PIP1 step 1 (DT3-DT16). The first/last date are a fitted 1-row profile."""
    lo, hi = date_range or fit_date_range(df, date)
    cols = temporal.calendar_columns(date)
    cols.update(temporal.elapsed_columns(date, lo, hi))
    order = ["quarter", "day_of_week", "week_of_year", "day_of_year", "is_weekend", "is_month_start", "is_month_end",
             "is_quarter_start", "is_quarter_end", "days_from_start", "days_from_end", "month_sin", "month_cos",
             "day_of_week_sin", "day_of_week_cos", "day_of_year_sin", "day_of_year_cos"]
    return df.select("*", *[cols[k].alias(k) for k in order])


def interaction_features(df: DataFrame) -> DataFrame:
    """PIP1 step 3 (STR1-STR10)."""
    cols = interaction_columns()
    return df.select("*", *[c.alias(k) for k, c in cols.items()])


def _cut(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def build_features(df: DataFrame, targets: Sequence[str] = TARGETS, order: Sequence[str] = ORDER_COLS,
                   quantile_method: str = "exact", fill: str = "ffill",
                   checkpoint: bool = True) -> DataFrame:
    """PIP1: temporal → aggregation → interaction → lag → statistical → trend → seasonal."""
    d = temporal_features(df)
    d = groupstats.add_group_stats(d, groupstats.DEFAULT_KEYS, targets, quantile_method)
    d = interaction_features(d)
    d = lags.with_global_index(d, order)
    d = lags.lag_features(d, targets, fill=fill)
    if checkpoint:
        d = _cut(d)
    d = lags.statistical_features(d, targets, quantile_method)
    d = lags.trend_features(d, targets, fill=fill)
    d = groupstats.seasonal_features(d, targets)
    return d.drop(lags.GIDX)


def business_indicators(df: DataFrame, quantile_method: str = "exact") -> DataFrame:
    """PIP2 (needs sales, customer_id, is_weekend, month): margin and its category, quantity
    percentile rank, high-volume flag (> P80), customer statistics, weekend and month tiers."""
    d = df
    if "sales" in d.columns and "profit" in d.columns:
        m = mathx.profit_margin("profit", "sales")
        d = d.select("*", m.alias("profit_margin")).select("*", mathx.margin_category("profit_margin").alias("profit_margin_category"))
    if "quantity" in d.columns:
        d = lags.percentile_rank(d, "quantity", "quantity_percentile", source=df)
        (p80,) = quantiles(df, "quantity", [0.8], method=quantile_method)
        d = d.select("*", F.coalesce((F.col("quantity") > F.lit(p80)).cast("int"), F.lit(0)).alias("high_volume"))
    if "customer_id" in d.columns:
        d = groupstats.add_customer_stats(d, source=df)
    return d.select("*", mathx.weekend_label("is_weekend").alias("weekend_performance"),
                    mathx.month_tier("month").alias("month_performance_tier"))
