"""Registered queries for metrics, residual tests and ensemble combiners, scored on
deterministic predictors (group means and a least-squares line) so both engines agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions.normal import log_far_tail_sql
from ledgerlens.modeling import ensemble, metrics
from ledgerlens.plans import registry
from ledgerlens.plans.checks import wrap_sql
from ledgerlens.plans.registry import ROW_ID, _sf, _sf_stored, register
from ledgerlens.plans.registry_prep import SPLIT_SQL_EXPR, _split
from ledgerlens.session import stored

RID = [c for c, _ in ROW_ID]
RID_SQL = ", ".join(RID)

PREDS_SQL = (f"SELECT {RID_SQL}, 'group_mean' AS model, quantity AS y, avg(quantity) OVER (PARTITION BY category) AS pred FROM sf "
             f"UNION ALL SELECT {RID_SQL}, 'line' AS model, sales AS y, (SELECT regr_intercept(sales, quantity) FROM sf) + "
             f"(SELECT regr_slope(sales, quantity) FROM sf) * quantity AS pred FROM sf")
MEMBERS_SQL = (f"SELECT {RID_SQL}, quantity AS y, avg(quantity) OVER (PARTITION BY category) AS p_random_forest, "
               f"avg(quantity) OVER (PARTITION BY sub_category) AS p_xgboost, avg(quantity) OVER (PARTITION BY region) AS p_lightgbm FROM sf")


def reg(name, spec, inner):
    def deco(fn):
        register(name, spec, None)(fn)
        if inner is not None:
            registry.SQL[name] = wrap_sql(inner, spec, registry.CTES + f", preds AS ({PREDS_SQL}), members AS ({MEMBERS_SQL})")
        return fn
    return deco


def line_fit(d, y="sales", x="quantity"):
    row = d.agg(F.regr_intercept(y, x).alias("a"), F.regr_slope(y, x).alias("b")).first()
    return row["a"], row["b"]


def _line(d, keep=()):
    a, b = line_fit(d)
    return d.select(*keep, F.lit("line").alias("model"), F.col("sales").alias("y"), (F.lit(a) + F.lit(b) * F.col("quantity")).alias("pred"))


def _preds(spark, sf_dir):
    """Both predictors, without the rows' ids: the metrics of a model read none."""
    d = _sf_stored(spark, sf_dir, "category", "quantity", "sales")
    cat = stored(d.groupBy("category").agg(F.avg("quantity").alias("_cm")))
    gm = d.join(cat, "category").select(F.lit("group_mean").alias("model"), F.col("quantity").alias("y"), F.col("_cm").alias("pred"))
    return gm.unionByName(_line(d))


def _members(spark, sf_dir):
    d = _sf_stored(spark, sf_dir, *RID, "category", "sub_category", "region", "quantity")
    means = {}
    for key, m in (("category", "random_forest"), ("sub_category", "xgboost"), ("region", "lightgbm")):
        means[key] = stored(d.groupBy(key).agg(F.avg("quantity").alias(f"p_{m}")))
    for key, table in means.items():
        d = d.join(table, key)
    return d.select(*RID, F.col("quantity").alias("y"), "p_random_forest", "p_xgboost", "p_lightgbm")


E = "(y - pred)"
BASIC_SPEC = [("model", "s"), ("r2", "d6"), ("mae", "d6"), ("rmse", "d6"), ("mse", "d4"), ("explained_variance", "d6"), ("mape", "d6")]


@reg("basic_metrics", BASIC_SPEC,
     f"SELECT model, CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum({E}*{E}) = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sum({E}*{E}) / "
     f"(var_pop(y) * count(*)) END AS r2, avg(abs{E}) AS mae, sqrt(avg({E}*{E})) AS rmse, avg({E}*{E}) AS mse, "
     f"1 - var_pop{E} / var_pop(y) AS explained_variance, CASE WHEN count_if(y = 0) = 0 THEN avg(abs{E} / abs(y)) "
     f"WHEN count_if(y = 0) < count(*) THEN avg(CASE WHEN y <> 0 THEN abs({E} / y) END) * 100 ELSE 'inf'::DOUBLE END AS mape "
     f"FROM preds GROUP BY model")
def q_basic(spark, sf_dir):
    return metrics.basic_metrics(_preds(spark, sf_dir), group_cols=["model"])


ADV_SPEC = [("model", "s"), ("median_ae", "d6"), ("max_error", "d6"), ("mean_residual", "d6"), ("std_residual", "d6"),
            ("mae_p25", "d6"), ("mae_p75", "d6"), ("mae_p90", "d6"), ("mae_p95", "d6"), ("residual_skewness", "d6"),
            ("residual_kurtosis", "d6"), ("pred_residual_corr", "d6"), ("normalized_rmse", "d6"), ("cv_rmse", "d6")]
ADV_SQL = ("SELECT model, quantile_cont(abs(e), 0.5) AS median_ae, max(abs(e)) AS max_error, avg(e) AS mean_residual, "
           "stddev_pop(e) AS std_residual, quantile_cont(abs(e), 0.25) AS mae_p25, quantile_cont(abs(e), 0.75) AS mae_p75, "
           "quantile_cont(abs(e), 0.9) AS mae_p90, quantile_cont(abs(e), 0.95) AS mae_p95, "
           "avg(power(e - me, 3)) / power(avg(power(e - me, 2)), 1.5) AS residual_skewness, "
           "avg(power(e - me, 4)) / power(avg(power(e - me, 2)), 2) - 3 AS residual_kurtosis, "
           "CASE WHEN count(DISTINCT pred) > 1 THEN corr(pred, e) ELSE 0 END AS pred_residual_corr, "
           "CASE WHEN stddev_pop(y) > 0 THEN sqrt(avg(e * e)) / stddev_pop(y) END AS normalized_rmse, "
           "CASE WHEN stddev_pop(y) > 0 THEN CASE WHEN avg(y) <> 0 THEN sqrt(avg(e * e)) / avg(y) ELSE 'inf'::DOUBLE END END AS cv_rmse "
           "FROM (SELECT *, y - pred AS e, avg(y - pred) OVER (PARTITION BY model) AS me FROM preds) GROUP BY model")


@reg("advanced_metrics", ADV_SPEC, ADV_SQL)
def q_advanced(spark, sf_dir):
    return metrics.advanced_metrics(_preds(spark, sf_dir), group_cols=["model"])


RS_SPEC = [("model", "s"), ("n", "i"), ("residual_mean", "d6"), ("residual_std", "d6"), ("residual_min", "d6"), ("residual_max", "d6"),
           ("residual_range", "d6"), ("jarque_bera", "d4"), ("jarque_bera_p", "d6"), ("jb_is_normal", "i"), ("breusch_pagan_lm", "d4")]
RS_SQL = ("SELECT model, count(e) AS n, avg(e) AS residual_mean, stddev_pop(e) AS residual_std, min(e) AS residual_min, "
          "max(e) AS residual_max, max(e) - min(e) AS residual_range, jb AS jarque_bera, exp(-jb / 2) AS jarque_bera_p, "
          "CASE WHEN exp(-jb / 2) > 0.05 THEN 1 ELSE 0 END AS jb_is_normal, count(e) * corr(e * e, pred) * corr(e * e, pred) AS breusch_pagan_lm "
          "FROM (SELECT *, count(e) OVER w / 6.0 * (power(avg(power(e - me, 3)) OVER w / power(avg(power(e - me, 2)) OVER w, 1.5), 2) + "
          "power(avg(power(e - me, 4)) OVER w / power(avg(power(e - me, 2)) OVER w, 2) - 3, 2) / 4.0) AS jb "
          "FROM (SELECT *, y - pred AS e, avg(y - pred) OVER (PARTITION BY model) AS me FROM preds) WINDOW w AS (PARTITION BY model)) "
          "GROUP BY model, jb")


@reg("residual_stats", RS_SPEC, RS_SQL)
def q_residual_stats(spark, sf_dir):
    return metrics.residual_stats(_preds(spark, sf_dir), group_cols=["model"])


OUT_PREDS_SQL = (f"SELECT {RID_SQL}, exp(quantity / 10.0) AS y, avg(exp(quantity / 10.0)) OVER (PARTITION BY category) AS pred "
                 f"FROM sf")


@reg("residual_outliers", ROW_ID + [("std_residual", "d6")],
     f"SELECT {RID_SQL}, z AS std_residual FROM (SELECT *, (e - avg(e) OVER ()) / stddev_pop(e) OVER () AS z FROM "
     f"(SELECT *, y - pred AS e FROM ({OUT_PREDS_SQL}))) q, (SELECT quantile_cont(z, 0.25) AS q1, quantile_cont(z, 0.75) AS q3 "
     f"FROM (SELECT (e - avg(e) OVER ()) / stddev_pop(e) OVER () AS z FROM (SELECT y - pred AS e FROM ({OUT_PREDS_SQL})))) b "
     f"WHERE z < b.q1 - 1.5 * (b.q3 - b.q1) OR z > b.q3 + 1.5 * (b.q3 - b.q1)")
def q_residual_outliers(spark, sf_dir):
    d = _sf_stored(spark, sf_dir, *RID, "category", "quantity").withColumn("y", F.exp(F.col("quantity") / 10.0))   # a right-skewed target
    p = d.join(stored(d.groupBy("category").agg(F.avg("y").alias("pred"))), "category").select(*RID, "y", "pred")
    _, rows = metrics.residual_outliers(p, row_key=RID)
    return rows


VOTE_W = ensemble.diversity_weights(["random_forest", "xgboost", "lightgbm"])
COMBINE_SPEC = ROW_ID + [("vote", "d6"), ("combine_median", "d6"), ("combine_max", "d6"), ("combine_mean", "d6"), ("combine_wavg", "d6")]
P3 = ["p_random_forest", "p_xgboost", "p_lightgbm"]


def _vote_sql():
    tot = sum(VOTE_W.values())
    return " + ".join(f"p_{m} * {VOTE_W[m] / tot!r}" for m in ("random_forest", "xgboost", "lightgbm"))


@reg("vote", COMBINE_SPEC,
     f"SELECT *, {_vote_sql()} AS vote, list_sort([p_random_forest, p_xgboost, p_lightgbm])[2] AS combine_median, "
     f"greatest(p_random_forest, p_xgboost, p_lightgbm) AS combine_max, (p_random_forest + p_xgboost + p_lightgbm) / 3.0 AS combine_mean, "
     f"(p_random_forest * 1.0 + p_xgboost * 2.0 + p_lightgbm * 3.0) / 6.0 AS combine_wavg FROM members")
def q_vote(spark, sf_dir):
    d = _members(spark, sf_dir)
    return d.select("*", ensemble.weighted_vote({m: f"p_{m}" for m in VOTE_W}, VOTE_W).alias("vote"),
                    ensemble.combine(P3, "median").alias("combine_median"), ensemble.combine(P3, "max").alias("combine_max"),
                    ensemble.combine(P3, "mean").alias("combine_mean"),
                    ensemble.combine(P3, "weighted_avg", [1.0, 2.0, 3.0]).alias("combine_wavg"))


@reg("model_table", [("model", "s"), ("mse", "d6"), ("rmse", "d6"), ("r2", "d6")],
     "SELECT model, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse, 1 - sum((y - p) * (y - p)) / "
     "(var_pop(y) * count(*)) AS r2 FROM (SELECT y, 'ensemble' AS model, " + _vote_sql() + " AS p FROM members UNION ALL "
     "SELECT y, 'random_forest', p_random_forest FROM members UNION ALL SELECT y, 'xgboost', p_xgboost FROM members UNION ALL "
     "SELECT y, 'lightgbm', p_lightgbm FROM members) GROUP BY model")
def q_model_table(spark, sf_dir):
    d = _members(spark, sf_dir)
    d = d.withColumn("p_ensemble", ensemble.weighted_vote({m: f"p_{m}" for m in VOTE_W}, VOTE_W))
    return ensemble.model_table(d, "y", {"ensemble": "p_ensemble", "random_forest": "p_random_forest",
                                         "xgboost": "p_xgboost", "lightgbm": "p_lightgbm"})


DIAG_SPEC = [("train_r2", "d6"), ("test_r2", "d6"), ("cv_r2_mean", "d6"), ("cv_r2_std", "d6"), ("train_test_gap", "d6"),
             ("cv_test_gap", "d6"), ("is_overfitting", "i"), ("is_underfitting", "i"), ("generalization_score", "d6"),
             ("stability_score", "d6")]
FOLD_SQL = "(l_orderkey * 13 + l_linenumber) % 5"


def _r2_sql(where):
    return f"(SELECT 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) FROM p WHERE {where})"


DIAG_SQL = (f"WITH p AS (SELECT *, {SPLIT_SQL_EXPR} AS is_test, {FOLD_SQL} AS fold FROM preds WHERE model = 'line'), "
            f"cv AS (SELECT fold, 1 - sum((y - pred) * (y - pred)) / (var_pop(y) * count(*)) AS r2 FROM p WHERE is_test = 0 GROUP BY fold), "
            f"m AS (SELECT {_r2_sql('is_test = 0')} AS train_r2, {_r2_sql('is_test = 1')} AS test_r2, (SELECT avg(r2) FROM cv) AS cv_r2_mean, "
            f"(SELECT stddev_pop(r2) FROM cv) AS cv_r2_std) "
            f"SELECT *, train_r2 - test_r2 AS train_test_gap, cv_r2_mean - test_r2 AS cv_test_gap, CASE WHEN train_r2 - test_r2 > 0.1 "
            f"THEN 1 ELSE 0 END AS is_overfitting, CASE WHEN cv_r2_mean < 0.7 THEN 1 ELSE 0 END AS is_underfitting, "
            f"least(test_r2, cv_r2_mean) AS generalization_score, 1 - cv_r2_std AS stability_score FROM m")


@reg("diagnosis", DIAG_SPEC, DIAG_SQL)
def q_diagnosis(spark, sf_dir):
    p = _split(_line(_sf_stored(spark, sf_dir, *RID, "quantity", "sales"), RID))
    p = p.withColumn("fold", F.pmod(F.col("l_orderkey") * 13 + F.col("l_linenumber"), F.lit(5)))
    split_r2 = metrics.basic_metrics(p, group_cols=["is_test"]).select("is_test", "r2")
    fold_r2 = metrics.basic_metrics(p.where(F.col("is_test") == 0), group_cols=["fold"]).agg(
        F.avg("r2").alias("cv_r2_mean"), F.stddev_pop("r2").alias("cv_r2_std"))
    wide = split_r2.agg(F.max(F.when(F.col("is_test") == 0, F.col("r2"))).alias("train_r2"),
                        F.max(F.when(F.col("is_test") == 1, F.col("r2"))).alias("test_r2"))
    j = wide.withColumn("_k", F.lit(1)).join(fold_r2.withColumn("_k", F.lit(1)), "_k")  # two 1-row tables
    cols = metrics.diagnosis(F.col("train_r2"), F.col("test_r2"), F.col("cv_r2_mean"), F.col("cv_r2_std"))
    return j.select("train_r2", "test_r2", "cv_r2_mean", "cv_r2_std", *[c.alias(k) for k, c in cols.items()])


_CRIT_SQL = ", ".join(f"round({c} / (1 + 4.0 / n - 25.0 / (n * n)), 3) AS critical_{str(s).replace('.', '_')}"
                      for c, s in zip(metrics.AD_CRITICAL, metrics.AD_SIGNIFICANCE, strict=True))


@reg("anderson", [("statistic", "d4"), ("critical_15_0", "d3"), ("critical_10_0", "d3"), ("critical_5_0", "d3"),
                  ("critical_2_5", "d3"), ("critical_1_0", "d3")],
     f"SELECT statistic, {_CRIT_SQL} FROM (SELECT n, -n - sum((2 * i - 1) * CASE WHEN z >= 0 THEN ln(1 - exp(far)) ELSE far END + "
     f"(2 * (n - i) + 1) * CASE WHEN z >= 0 THEN far ELSE ln(1 - exp(far)) END) / n AS statistic FROM "
     f"(SELECT *, {log_far_tail_sql('z')} AS far FROM (SELECT (e - avg(e) OVER ()) / stddev_samp(e) OVER () AS z, count(*) OVER () AS n, "
     f"row_number() OVER (ORDER BY e) AS i FROM (SELECT y - pred AS e FROM preds WHERE model = 'line'))) GROUP BY n)")
def q_anderson(spark, sf_dir):
    return metrics.anderson_darling(_line(_sf_stored(spark, sf_dir, "quantity", "sales")))


@reg("breusch_pagan", [("model", "s"), ("statistic", "d4"), ("p_value", "d6"), ("is_homoscedastic", "i")],
     f"SELECT model, lm AS statistic, 2 * exp(far) AS p_value, CASE WHEN 2 * exp(far) > 0.05 THEN 1 ELSE 0 END AS is_homoscedastic FROM "
     f"(SELECT *, {log_far_tail_sql('z')} AS far FROM (SELECT *, sqrt(lm) AS z FROM "
     f"(SELECT model, count(*) * power(corr((y - pred) * (y - pred), pred), 2) AS lm FROM preds GROUP BY model)))")
def q_bp(spark, sf_dir):
    return metrics.breusch_pagan(_preds(spark, sf_dir), group_cols=["model"])


@reg("residual_outlier_summary", [("count", "i"), ("percentage", "d6")],
     f"SELECT count(*) FILTER (f) AS count, 100.0 * count(*) FILTER (f) / count(*) AS percentage FROM (SELECT z < b.q1 - 1.5 * (b.q3 - b.q1) OR "
     f"z > b.q3 + 1.5 * (b.q3 - b.q1) AS f FROM (SELECT (e - avg(e) OVER ()) / stddev_pop(e) OVER () AS z FROM (SELECT y - pred AS e FROM "
     f"({OUT_PREDS_SQL}))), (SELECT quantile_cont(z, 0.25) AS q1, quantile_cont(z, 0.75) AS q3 FROM (SELECT (e - avg(e) OVER ()) / "
     f"stddev_pop(e) OVER () AS z FROM (SELECT y - pred AS e FROM ({OUT_PREDS_SQL})))) b)")
def q_residual_outlier_summary(spark, sf_dir):
    """MET19's count and percentage."""
    d = _sf_stored(spark, sf_dir, "category", "quantity").withColumn("y", F.exp(F.col("quantity") / 10.0))
    d = d.join(stored(d.groupBy("category").agg(F.avg("y").alias("pred"))), "category")
    return metrics.residual_outliers(d)[0]


@reg("accuracy_by_region", [("region", "s"), ("accuracy", "d6")],
     "SELECT region, avg(CASE WHEN (quantity > cm) = (sales > sm) THEN 1.0 ELSE 0.0 END) AS accuracy FROM (SELECT *, avg(quantity) OVER "
     "(PARTITION BY category) AS cm, avg(sales) OVER (PARTITION BY category) AS sm FROM sf) GROUP BY region")
def q_accuracy(spark, sf_dir):
    """MET21: sales above the category's mean as a predictor of quantities above it, per region."""
    d = _sf(spark, sf_dir)
    d = d.join(d.groupBy("category").agg(F.avg("quantity").alias("_cm"), F.avg("sales").alias("_sm")), "category")
    d = d.select("region", (F.col("quantity") > F.col("_cm")).alias("y"), (F.col("sales") > F.col("_sm")).alias("pred"))
    return metrics.accuracy(d, group_cols=["region"])
