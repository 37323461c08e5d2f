import math

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.functions.normal import chi2_1_sf, log_far_tail_sql, log_normal_tails
from ledgerlens.modeling import ensemble, metrics, models


def test_basic_metrics_and_mape_branches(spark):
    y = np.array([1.0, 2.0, 4.0, 0.0])
    p = np.array([1.5, 2.0, 3.0, 0.5])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "pred": p}))
    m = metrics.basic_metrics(df).first()
    e = y - p
    assert math.isclose(m["r2"], 1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert math.isclose(m["mape"], np.mean(np.abs(e[:3] / y[:3])) * 100)     # zeros present → percent over y≠0
    df2 = spark.createDataFrame(pd.DataFrame({"y": y[:3], "pred": p[:3]}))
    assert math.isclose(metrics.basic_metrics(df2).first()["mape"], np.mean(np.abs(e[:3] / y[:3])))


def test_advanced_metrics_against_numpy(spark):
    rng = np.random.default_rng(1)
    y, p = rng.normal(size=200), rng.normal(size=200)
    a = metrics.advanced_metrics(spark.createDataFrame(pd.DataFrame({"y": y, "pred": p}))).first()
    e = y - p
    assert math.isclose(a["median_ae"], np.median(np.abs(e)))
    assert math.isclose(a["mae_p90"], np.percentile(np.abs(e), 90))
    m2, m3, m4 = [np.mean((e - e.mean()) ** k) for k in (2, 3, 4)]
    assert math.isclose(a["residual_skewness"], m3 / m2 ** 1.5, rel_tol=1e-9)
    assert math.isclose(a["residual_kurtosis"], m4 / m2 ** 2 - 3, rel_tol=1e-9)


def test_anderson_darling_statistic(spark):
    rng = np.random.default_rng(2)
    e = rng.normal(size=300)
    got = metrics.anderson_darling(spark.createDataFrame(pd.DataFrame({"y": e, "pred": np.zeros(300)}))).first()
    z = np.sort((e - e.mean()) / e.std(ddof=1))
    n = len(z)
    cdf = np.array([0.5 * math.erfc(-v / math.sqrt(2)) for v in z])
    i = np.arange(1, n + 1)
    a2 = -n - np.sum((2 * i - 1) * (np.log(cdf) + np.log(1 - cdf[::-1]))) / n
    assert math.isclose(got["statistic"], a2, rel_tol=1e-9)


def test_normal_tails_against_erfc(spark):
    z = [0.0, 1e-9, 0.3, 1.0, 2.0, 2.82, 2.83, 3.5, 5.0, 9.0, 30.0]
    z = z + [-v for v in z[1:]]
    low, high = log_normal_tails(F.col("z"))
    d = spark.createDataFrame([(v,) for v in [*z, 1e5, None, float("nan")]], "z double")
    got = {r["z"]: r for r in d.select("z", low.alias("low"), high.alias("high"), chi2_1_sf(F.col("z") * F.col("z")).alias("p")).collect()}

    def log_upper(v):
        far = 0.5 * math.erfc(abs(v) / math.sqrt(2))
        return math.log(far) if v >= 0 else math.log1p(-far)

    for v in z:
        assert math.isclose(got[v]["high"], log_upper(v), rel_tol=1e-11, abs_tol=1e-300)
        assert math.isclose(got[v]["low"], log_upper(-v), rel_tol=1e-11, abs_tol=1e-300)
        assert math.isclose(got[v]["p"], math.erfc(abs(v) / math.sqrt(2)), rel_tol=1e-11)
    assert got[None]["low"] is None and got[None]["high"] is None
    assert math.isclose(got[1e5]["high"], -0.5e10, rel_tol=1e-6) and got[1e5]["low"] == 0.0
    con = duckdb.connect()
    for v in (0.0, 1.0, 2.82, 2.83, 30.0):
        far = con.execute(f"SELECT {log_far_tail_sql('z')} FROM (SELECT CAST({v} AS DOUBLE) AS z)").fetchall()[0][0]
        assert math.isclose(far, math.log(0.5 * math.erfc(v / math.sqrt(2))), rel_tol=1e-11)


def test_anderson_darling_far_residual_and_degenerate_tables(spark):
    rng = np.random.default_rng(3)
    e = [*rng.normal(size=5000).tolist(), 1e9]
    got = metrics.anderson_darling(spark.createDataFrame([(v, 0.0) for v in e], "y double, pred double")).first()["statistic"]
    assert math.isfinite(got) and got > 1000
    for rows in ([], [(1.0, 0.0)], [(1.0, 0.0)] * 4, [(None, 0.0), (float("nan"), 1.0)]):
        assert metrics.anderson_darling(spark.createDataFrame(rows, "y double, pred double")).first()["statistic"] is None


def test_weights_and_combiners(spark):
    w = ensemble.diversity_weights(["random_forest", "xgboost", "lightgbm"])
    assert round(w["random_forest"], 4) == 0.2903 and round(w["xgboost"], 4) == 0.3548
    assert math.isclose(sum(w.values()), 1.0)
    df = spark.createDataFrame([(1.0, 4.0, 2.0, 10.0)], "a double, b double, c double, d double")
    r = df.select(ensemble.combine(["a", "b", "c", "d"], "median").alias("m"), ensemble.combine(["a", "b"], "max").alias("x"),
                  ensemble.combine(["a", "b"], "weighted_avg", [1, 3]).alias("w")).first()
    assert r["m"] == 3.0 and r["x"] == 4.0 and r["w"] == 3.25


def test_forest_beats_mean_and_save_load(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 10, 400)
    pdf = pd.DataFrame({"x": x, "label": 3 * x + rng.normal(size=400)})
    df = models.assemble(spark.createDataFrame(pdf), ["x"])
    m = models.make_model("rf", "regression", {"n_estimators": 10}, "features", "label").fit(df)
    r2 = metrics.basic_metrics(m.transform(df), "label", "prediction").first()["r2"]
    assert r2 > 0.9
    rows = spark.createDataFrame([("2020-01-05", "EU", "p1", 1.0, 2.0), ("2020-02-05", "US", "p2", 3.0, 4.0),
                                  ("2020-03-05", "EU", "p2", 2.0, 1.0)], "date string, region string, product string, quantity double, profit double")
    rows = rows.withColumn("date", F.to_date("date"))
    fitted = models.train_compact(rows, {"n_estimators": 3, "max_depth": 2})
    models.save_models(fitted, str(tmp_path / "m"), {"features": ["date", "region", "product"]})
    loaded, meta = models.load_models(str(tmp_path / "m"))
    a = models.score(fitted, rows.select("date", "region", "product")).collect()
    b = models.score(loaded, rows.select("date", "region", "product")).collect()
    assert a == b and meta["features"] == ["date", "region", "product"]


def test_param_mapping_reports_ignored():
    sp, ignored = models.map_params({"n_estimators": 5, "max_depth": None, "reg_alpha": 1, "num_leaves": 31}, "gbt")
    assert sp == {"maxIter": 5, "maxDepth": 30} and set(ignored) == {"reg_alpha", "num_leaves"}


def test_align_features(spark):
    df = spark.createDataFrame([(1.0, 2.0, "x")], "b double, extra double, s string")
    out = models.align_features(df, ["a", "b"])
    assert out.columns[:2] == ["a", "b"] and out.first()["a"] == 0.0
