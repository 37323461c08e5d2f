"""Column profiles (AGG16, AGG18): one aggregation job returns a small per-column summary
(bounded by the number of columns) that drives data-dependent column plans on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """PRJ3: numeric columns in schema order (booleans are not numeric, like pandas bool)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = (), skip_date_named: bool = False) -> list[str]:
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]
    if skip_date_named:
        cols = [c for c in cols if "date" not in c.lower()]
    return cols


def _is_floating(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (DoubleType, FloatType))


def missing_expr(df: DataFrame, c: str):
    """NULL, or NaN for floating columns (pandas ``isnull``)."""
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if _is_floating(df, c) else col.isNull()


def missing_ratios(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """FIL3/FIL4 input: share of missing values per column over all rows."""
    cols = list(cols) if cols is not None else df.columns
    if not cols:
        return {}
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(missing_expr(df, c).cast("long")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    n = row["_n"] or 0
    return {c: (row[f"m{i}"] / n if n else 0.0) for i, c in enumerate(cols)}


def numeric_profile(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    """AGG18: non-missing count, sample variance, min, max, population skewness per column.
    NaN counts as missing (pandas skips it), so the statistics run over NULL-ed NaNs."""
    cols = list(cols)
    if not cols:
        return {}
    exprs = []
    for i, c in enumerate(cols):
        v = F.when(~missing_expr(df, c), F.col(c).cast("double"))
        exprs += [F.count(v).alias(f"n{i}"), F.var_samp(v).alias(f"v{i}"), F.min(v).alias(f"lo{i}"),
                  F.max(v).alias(f"hi{i}"), F.skewness(v).alias(f"sk{i}"), F.avg(v).alias(f"m{i}"),
                  F.stddev_pop(v).alias(f"sp{i}")]
    row = df.agg(*exprs).first()
    return {c: {"count": row[f"n{i}"], "var": row[f"v{i}"], "min": row[f"lo{i}"], "max": row[f"hi{i}"],
                "skew": row[f"sk{i}"], "mean": row[f"m{i}"], "std_pop": row[f"sp{i}"]} for i, c in enumerate(cols)}


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict[str, int]:
    """AGG16: distinct non-NULL values per column, all columns in one job."""
    cols = list(cols)
    if not cols:
        return {}
    fn = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.countDistinct(c))
    row = df.agg(*[fn(c).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    return {c: row[f"d{i}"] for i, c in enumerate(cols)}


def distinct_counts_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG16 as a DataFrame (column, n_distinct) without collecting: distinct (column, value)
    pairs are counted by one shuffle on the pair."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                            for c in cols])).alias("_s")).select("_s.*")
    return stacked.where(F.col("value").isNotNull()).distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def _stack(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x"),
                                                  missing_expr(df, c).alias("_miss")) for c in cols])).alias("_s")).select("_s.*")


def missing_ratio_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FIL3/FIL4/FIL7 profile as a DataFrame (column, missing_ratio)."""
    stacked = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), missing_expr(df, c).alias("_miss"))
                                            for c in cols])).alias("_s")).select("_s.*")
    return stacked.groupBy("column").agg(F.avg(F.col("_miss").cast("double")).alias("missing_ratio"))


def variance_frame(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG18 as a DataFrame (column, variance) with the sample variance of non-missing values."""
    st = _stack(df, cols)
    return st.groupBy("column").agg(F.var_samp(F.when(~F.col("_miss"), F.col("_x"))).alias("variance"))
