"""Regression metrics and residual analysis (MET1-MET19, MET21-MET22) as aggregations over
(y, pred) with optional group columns, so many models or segments are scored in one job.
Quantiles of |residual| use the exact distributed quantile; moments are partial aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.normal import chi2_1_sf, log_normal_tails
from ledgerlens.operators.quantile import _join_small, group_quantiles
from ledgerlens.operators.sequence import shuffle_partitions

INF = float("inf")
# Normal-distribution critical values of the Anderson-Darling statistic at
# significance levels 15, 10, 5, 2.5 and 1 percent (before the small-sample correction).
AD_CRITICAL = (0.576, 0.656, 0.787, 0.918, 1.092)
AD_SIGNIFICANCE = (15.0, 10.0, 5.0, 2.5, 1.0)


def _res(y: str, pred: str) -> Column:
    return F.col(y).cast("double") - F.col(pred).cast("double")


def basic_metrics(df: DataFrame, y: str = "y", pred: str = "pred", group_cols: Sequence[str] = ()) -> DataFrame:
    """MET1-MET5: r2, mae, mse, rmse, explained_variance, mape."""
    g = list(group_cols)
    e = _res(y, pred)
    yc = F.col(y).cast("double")
    m = df.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(e * e).alias("_sse"), F.var_pop(yc).alias("_vy"),
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(e).alias("_ve"),
        F.sum((yc == 0).cast("int")).alias("_zeros"),
        F.avg(F.try_divide(F.abs(e), F.abs(yc))).alias("_mape_frac"),
        F.avg(F.when(yc != 0, F.abs(F.try_divide(e, yc)))).alias("_mape_nz"))
    sst = F.col("_vy") * F.col("_n")
    r2 = (F.when(sst == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(1 - F.col("_sse") / sst))
    ev = (F.when(F.col("_vy") == 0, F.when(F.col("_ve") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(1 - F.col("_ve") / F.col("_vy")))
    mape = (F.when(F.col("_zeros") == 0, F.col("_mape_frac"))
            .when(F.col("_zeros") < F.col("_n"), F.col("_mape_nz") * 100).otherwise(F.lit(INF)))
    return m.select(*g, r2.alias("r2"), "mae", F.sqrt("mse").alias("rmse"), "mse", ev.alias("explained_variance"),
                    mape.alias("mape"))


def advanced_metrics(df: DataFrame, y: str = "y", pred: str = "pred", group_cols: Sequence[str] = (),
                     quantile_method: str = "exact") -> DataFrame:
    """MET6-MET13: median/max abs error, residual mean and population std, abs-error
    percentiles, residual skewness and excess kurtosis (population), corr(pred, residual),
    normalised and CV rmse (only when std(y) > 0)."""
    g = list(group_cols)
    d = df.select(*g, F.col(y).cast("double").alias("_y"), F.col(pred).cast("double").alias("_p")).withColumn("_e", F.col("_y") - F.col("_p"))
    mom = d.groupBy(*g).agg(
        F.max(F.abs("_e")).alias("max_error"), F.avg("_e").alias("mean_residual"), F.stddev_pop("_e").alias("std_residual"),
        F.skewness("_e").alias("residual_skewness"), F.kurtosis("_e").alias("residual_kurtosis"),
        F.corr("_p", "_e").alias("_corr"), F.when(F.min("_p") < F.max("_p"), 2).otherwise(1).alias("_np"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("_rmse"), F.stddev_pop("_y").alias("_sy"), F.avg("_y").alias("_my"))
    qs = group_quantiles(d.withColumn("_ae", F.abs("_e")), "_ae", [0.5, 0.25, 0.75, 0.9, 0.95], by=g,
                         names=["median_ae", "mae_p25", "mae_p75", "mae_p90", "mae_p95"], method=quantile_method)
    j = _join_small(mom, qs, g)
    corr = F.when(F.col("_np") > 1, F.col("_corr")).otherwise(F.lit(0.0))
    nrmse = F.when(F.col("_sy") > 0, F.col("_rmse") / F.col("_sy"))
    cv = F.when(F.col("_sy") > 0, F.when(F.col("_my") != 0, F.col("_rmse") / F.col("_my")).otherwise(F.lit(INF)))
    return j.select(*g, "median_ae", "max_error", "mean_residual", "std_residual", "mae_p25", "mae_p75", "mae_p90", "mae_p95",
                    "residual_skewness", "residual_kurtosis", corr.alias("pred_residual_corr"),
                    nrmse.alias("normalized_rmse"), cv.alias("cv_rmse"))


def residual_stats(df: DataFrame, y: str = "y", pred: str = "pred", group_cols: Sequence[str] = ()) -> DataFrame:
    """MET14 + MET16 + MET18 statistic: residual mean/std(pop)/min/max/range, Jarque-Bera
    statistic and p-value (χ²₂ tail = exp(-JB/2)), Breusch-Pagan LM = n·corr(e², pred)²."""
    g = list(group_cols)
    e = _res(y, pred)
    p = F.col(pred).cast("double")
    m = df.groupBy(*g).agg(F.count(e).alias("n"), F.avg(e).alias("residual_mean"), F.stddev_pop(e).alias("residual_std"),
                           F.min(e).alias("residual_min"), F.max(e).alias("residual_max"),
                           F.skewness(e).alias("_s"), F.kurtosis(e).alias("_k"), F.corr(e * e, p).alias("_bpc"))
    jb = F.col("n") / 6.0 * (F.col("_s") * F.col("_s") + F.col("_k") * F.col("_k") / 4.0)
    lm = F.col("n") * F.col("_bpc") * F.col("_bpc")
    return m.select(*g, "n", "residual_mean", "residual_std", "residual_min", "residual_max",
                    (F.col("residual_max") - F.col("residual_min")).alias("residual_range"),
                    jb.alias("jarque_bera"), F.exp(-jb / 2.0).alias("jarque_bera_p"),
                    (F.exp(-jb / 2.0) > 0.05).cast("int").alias("jb_is_normal"), lm.alias("breusch_pagan_lm"))


def breusch_pagan(df: DataFrame, y: str = "y", pred: str = "pred", group_cols: Sequence[str] = ()) -> DataFrame:
    """MET18 with p-value: the upper tail of χ² with one degree of freedom."""
    rs = residual_stats(df, y, pred, group_cols)
    return rs.select(*group_cols, F.col("breusch_pagan_lm").alias("statistic"),
                     chi2_1_sf(F.col("breusch_pagan_lm")).alias("p_value")).withColumn(
        "is_homoscedastic", (F.col("p_value") > 0.05).cast("int"))


def _ad_pieces(n: int):
    """Per range partition of ascending rows (log lower tail, log upper tail): its number, its rows, the sum of
    its terms as if it were the first one, and the sum that each row before it adds twice."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, terms, shift = 0, 0.0, 0.0
        for batch in batches:
            low, high = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            i = np.arange(count, count + len(low), dtype=np.float64)
            terms += float(((2 * i + 1) * low + (2 * (n - i) - 1) * high).sum())
            shift += float((low - high).sum())
            count += len(low)
        yield pa.RecordBatch.from_pydict({"_p": [TaskContext.get().partitionId()], "_c": [count], "_t": [terms], "_d": [shift]}, PIECES)

    return sums


PIECES = pa.schema([("_p", pa.int32()), ("_c", pa.int64()), ("_t", pa.float64()), ("_d", pa.float64())])


def anderson_darling(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """MET17: A² of the standardised residuals (sample std) against the normal, with the
    corrected critical values. The residuals are range-partitioned once; each range partition sums its
    terms by place in it, and the numbers of rows before it shift the sums. The logarithms of both
    tails are column expressions, finite however far a residual lies. NULL and NaN residuals are
    left out; without spread (or with fewer than two rows) the statistic is NULL."""
    e = df.select(F.nanvl(_res(y, pred), F.lit(None).cast("double")).alias("_e")).where(F.col("_e").isNotNull())
    st = e.agg(F.count("_e").alias("n"), F.avg("_e").alias("m"), F.stddev_samp("_e").alias("s")).first()
    n, mu, sd = st["n"], st["m"], st["s"]
    z = F.when(F.lit(bool(sd)), (F.col("_e") - F.lit(mu or 0.0)) * F.lit(1.0 / sd if sd else 0.0))
    low, high = log_normal_tails(F.col("_z"))
    ranged = e.repartitionByRange(shuffle_partitions(e), "_e").sortWithinPartitions("_e").select(z.alias("_z"))
    pieces = ranged.select(low.alias("low"), high.alias("high")).mapInArrow(_ad_pieces(n), "_p int, _c long, _t double, _d double")
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per range partition
    terms = pieces.select((F.col("_t") + 2 * before * F.col("_d")).alias("_t"))
    a2 = terms.agg(F.when(F.lit(bool(sd)), F.lit(-float(n)) - F.sum("_t") / F.lit(float(max(n, 1)))).alias("statistic"))
    corr = 1.0 + 4.0 / n - 25.0 / (n * n) if n else 1.0
    crit = [round(c / corr, 3) for c in AD_CRITICAL]
    return a2.select("statistic", *[F.lit(c).alias(f"critical_{str(s).replace('.', '_')}") for c, s in zip(crit, AD_SIGNIFICANCE)])


def residual_outliers(df: DataFrame, y: str = "y", pred: str = "pred", row_key: Sequence[str] = (),
                      quantile_method: str = "exact") -> tuple[DataFrame, DataFrame]:
    """MET19: residuals standardised with the population std, flagged outside 1.5·IQR.
    Returns (summary: count and percentage, rows: key + standardised value)."""
    d = df.select(*row_key, _res(y, pred).alias("_e"))
    st = d.agg(F.avg("_e").alias("m"), F.stddev_pop("_e").alias("s"), F.count("_e").alias("n")).first()
    d = d.withColumn("std_residual", (F.col("_e") - F.lit(st["m"])) / F.lit(st["s"]))
    q1, q3 = group_quantiles(d, "std_residual", [0.25, 0.75], (), names=["a", "b"], method=quantile_method).first()
    iqr = q3 - q1
    flag = (F.col("std_residual") < q1 - 1.5 * iqr) | (F.col("std_residual") > q3 + 1.5 * iqr)
    rows = d.where(flag).select(*row_key, "std_residual")
    summary = d.agg(F.sum(flag.cast("int")).alias("count"), (F.avg(flag.cast("double")) * 100).alias("percentage"))
    return summary, rows


def accuracy(df: DataFrame, y: str = "y", pred: str = "pred", group_cols: Sequence[str] = ()) -> DataFrame:
    """MET21."""
    return df.groupBy(*group_cols).agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"))


def diagnosis(train_r2: Column, test_r2: Column, cv_r2_mean: Column, cv_r2_std: Column) -> dict[str, Column]:
    """MET22 as expressions over metric columns."""
    return {
        "train_test_gap": train_r2 - test_r2,
        "cv_test_gap": cv_r2_mean - test_r2,
        "is_overfitting": ((train_r2 - test_r2) > 0.1).cast("int"),
        "is_underfitting": (cv_r2_mean < 0.7).cast("int"),
        "generalization_score": F.least(test_r2, cv_r2_mean),
        "stability_score": 1 - cv_r2_std,
    }
