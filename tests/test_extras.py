import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ledgerlens.modeling import ensemble
from ledgerlens.modeling.normality import norm_ppf, shapiro_by_group, shapiro_wilk
from ledgerlens.sources.csv import read_sales_csv


def test_norm_ppf_round_trip():
    for p in (1e-6, 0.01, 0.3, 0.5, 0.9, 0.999):
        x = norm_ppf(p)
        assert math.isclose(0.5 * math.erfc(-x / math.sqrt(2)), p, rel_tol=1e-12)


def test_shapiro_wilk_behaviour():
    rng = np.random.default_rng(0)
    w_norm, p_norm = shapiro_wilk(rng.normal(size=400))
    w_exp, p_exp = shapiro_wilk(rng.exponential(size=400))
    assert 0.98 < w_norm <= 1.0 and p_norm > 0.01
    assert w_exp < 0.95 and p_exp < 1e-6
    # the approximated first coefficient for n = 10 is close to the tabulated 0.5739
    x = np.arange(10, dtype=float)
    w, _ = shapiro_wilk(x)
    assert 0.95 < w < 0.99


def test_shapiro_by_group_skips_large_groups(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": ["a"] * 50 + ["b"] * 30, "y": rng.normal(size=80), "pred": 0.0})
    out = {r["g"]: r for r in shapiro_by_group(spark.createDataFrame(pdf), "y", "pred", ["g"]).collect()}
    assert out["a"]["n"] == 50 and out["a"]["statistic"] is not None
    assert math.isclose(out["b"]["statistic"], shapiro_wilk(pdf[pdf.g == "b"].y.to_numpy())[0])


def test_soft_and_hard_vote(spark):
    df = spark.createDataFrame([(Vectors.dense([0.6, 0.4]), Vectors.dense([0.2, 0.8]), 0.0, 1.0)], ["pa", "pb", "la", "lb"])
    r = df.select(ensemble.soft_vote({"a": "pa", "b": "pb"}, {"a": 1.0, "b": 1.0}).alias("s"),
                  ensemble.hard_vote({"a": "la", "b": "lb"}, {"a": 1.0, "b": 2.0}).alias("h"),
                  ensemble.hard_vote({"a": "la", "b": "lb"}).alias("tie")).first()
    assert r["s"] == 1.0 and r["h"] == 1.0 and r["tie"] == 0.0


def test_csv_source_latin1_and_bad_dates(spark, tmp_path):
    p = tmp_path / "sales.csv"
    p.write_bytes("Order Date,Region,Quantity\n2020-01-05,Espa\xf1a,3\nnot-a-date,Norte,4\n".encode("latin-1"))
    df = read_sales_csv(spark, str(p), schema="`Order Date` string, Region string, Quantity double", date_format="yyyy-MM-dd")
    rows = df.orderBy("Quantity").collect()
    assert rows[0]["Region"] == "España" and rows[0]["Order Date"] is not None and rows[1]["Order Date"] is None
    with pytest.raises(FileNotFoundError):
        read_sales_csv(spark, str(tmp_path / "missing.csv"))


def test_stream_scoring(spark, tmp_path):
    from ledgerlens.modeling import models
    from ledgerlens.streaming.scoring import score_stream

    rows = spark.createDataFrame([("2020-01-05", "EU", "p1", 1.0, 2.0), ("2020-02-05", "US", "p2", 3.0, 4.0)],
                                 "date string, region string, product string, quantity double, profit double")
    fitted = models.train_compact(rows.withColumn("date", F.to_date("date")), {"n_estimators": 2, "max_depth": 2})
    src = tmp_path / "in"
    rows.select("date", "region", "product").write.parquet(str(src))
    stream = spark.readStream.schema("date string, region string, product string").parquet(str(src))
    q = score_stream(fitted, stream).writeStream.format("memory").queryName("scored").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM scored").collect()
    assert len(got) == 2 and {"quantity_pred", "profit_pred"} <= set(got[0].asDict())


def test_rename_standard_ignores_missing(spark):
    from ledgerlens.sources.csv import rename_standard

    df = spark.createDataFrame([(1, 2.0)], "Region int, Quantity double")
    assert rename_standard(df).columns == ["region", "quantity"]


def test_normalize_columns_and_values(spark):
    from ledgerlens.functions.fuzzy import normalize_columns, normalize_values

    df = spark.createDataFrame([("x", 1.0, "  LARGE ")], "Region string, quantity double, cat string")
    syn = spark.createDataFrame([("region", "region")], "term string, synonym string")
    assert normalize_columns(df, synonyms=syn).columns[:2] == ["region", "quantity"]
    out = normalize_values(df, "cat", "std", ["LARGE", "SMALL"]).first()
    assert out["std"] == "LARGE"


def test_values_map_to_best_term_without_duplicates(spark):
    from ledgerlens.functions.fuzzy import normalize_values

    df = spark.createDataFrame([("ECONOMI",), ("ECONOMYY",), ("ECONOMY",), (None,), ("zzz",)], "v string")
    got = {r["v"]: r["t"] for r in normalize_values(df, "v", "t", ["ECONOMY", "ECONOMICS"], 80.0).collect()}
    assert got["ECONOMY"] == got["ECONOMYY"] == "ECONOMY" and got["ECONOMI"] is not None and got["zzz"] is None
    assert normalize_values(df, "v", "t", ["ECONOMY", "ECONOMICS"], 80.0).count() == 5
