import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import mathx, temporal
from ledgerlens.functions.fuzzy import token_sort_ratio
from ledgerlens.operators import encode, impute, outliers, scale
from ledgerlens.operators.knn import impute_knn
from ledgerlens.plans.features import temporal_features


def test_calendar_semantics(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2020, 3, 31),), (None,)], "d date")
    out = df.select(*[c.alias(k) for k, c in temporal.calendar_columns("d").items()]).collect()
    assert out[0]["week_of_year"] == 53 and out[0]["day_of_week"] == 6 and out[0]["is_weekend"] == 1
    assert out[1]["is_quarter_end"] == 1 and out[1]["is_month_end"] == 1
    assert out[2]["is_weekend"] == 0 and out[2]["quarter"] is None


def test_margin_bins_and_division(spark):
    df = spark.createDataFrame([(5.0, 0.0), (-5.0, 0.0), (0.0, 0.0), (1.0, 10.0), (30.0, 100.0)], "p double, s double")
    rows = df.select(mathx.profit_margin("p", "s").alias("m")).select("m", mathx.margin_category("m").alias("c")).collect()
    assert rows[0]["m"] == math.inf and rows[0]["c"] == "Alto"
    assert rows[1]["m"] == -math.inf and rows[1]["c"] is None
    assert math.isnan(rows[2]["m"]) and rows[2]["c"] is None
    assert rows[3]["c"] == "Bajo" and rows[4]["c"] == "Alto"


def test_label_codes_null_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    got = [r["c_label"] for r in encode.label_encode(df, "c").orderBy("c").collect()]
    assert sorted(got) == [0, 1, 1, 2]          # a=0, b=1, nan=2
    vocab = encode.fit_vocabulary(spark.createDataFrame([("a",)], "c string"), "c")
    unseen = encode.label_encode(df, "c", "code", vocab=vocab).where(F.col("c") == "b").first()["code"]
    assert unseen == -1


def test_onehot_drop_first(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "c string")
    out = encode.onehot_drop_first(df, "c")
    assert out.columns == ["c", "c_y", "c_z"]
    assert out.where(F.col("c").isNull()).first()["c_y"] == 0


def test_scalers_follow_population_std_and_constants(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, 4.0], "k": [2.0] * 4})
    df = spark.createDataFrame(pdf)
    p = scale.fit_scaler(df, ["a", "k"], "standard")
    assert math.isclose(p["a"][1], pdf.a.std(ddof=0)) and p["k"][1] == 1.0
    mm = scale.apply_scaler(df, scale.fit_scaler(df, ["k"], "minmax")).select("k").collect()
    assert all(r["k"] == 0.0 for r in mm)


def test_outliers_bounds_after_target_use_filtered_rows(spark):
    pdf = pd.DataFrame({"t": [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 1000], "x": [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 100]})
    out, b = outliers.handle_outliers(spark.createDataFrame(pdf), "t", ["t", "x"])
    assert out.count() == 9                     # 1000 is beyond 3·IQR of t
    kept = pdf[pdf.t < 1000]
    q1, q3 = kept.x.quantile([0.25, 0.75])
    assert np.allclose(b.bounds["x"], (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))


def test_mode_fill_and_unknown(spark):
    df = spark.createDataFrame([("A",), ("A",), ("A",), (None,), ("B",)], "c string")
    assert [r["c"] for r in impute.impute_categorical(df, ["c"]).collect()].count("A") == 4
    df2 = spark.createDataFrame([("A",), ("B",), (None,), (None,)], "c string")
    assert "Unknown" in [r["c"] for r in impute.impute_categorical(df2, ["c"]).collect()]


def _knn_brute(pdf, target, coord, k):
    donors = pdf[pdf[target].notna() & pdf[coord].notna()].copy()
    out = {}
    for i, r in pdf[pdf[target].isna() & pdf[coord].notna()].iterrows():
        d = donors.assign(_d=(donors[coord] - r[coord]).abs()).sort_values(["_d", coord, "rid"])
        out[r["rid"]] = d[target].head(k).mean()
    return out


def test_knn_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 300
    pdf = pd.DataFrame({"rid": np.arange(n), "a": np.round(rng.normal(size=n), 2), "b": rng.integers(0, 20, n).astype(float)})
    pdf.loc[rng.choice(n, 40, replace=False), "a"] = np.nan
    pdf.loc[rng.choice(n, 40, replace=False), "b"] = np.nan
    got = impute_knn(spark.createDataFrame(pdf), ["a", "b"], k=5, row_id=["rid"], tie=["rid"]).toPandas().set_index("rid")
    for target, coord in (("a", "b"), ("b", "a")):
        for rid, v in _knn_brute(pdf, target, coord, 5).items():
            assert math.isclose(got.loc[rid, target], v, rel_tol=1e-9, abs_tol=1e-12)
    both = pdf[pdf.a.isna() & pdf.b.isna()].rid
    for rid in both:
        assert math.isclose(got.loc[rid, "a"], pdf.a.mean())


def _knn_brute_patterns(x, k):
    """NaN-Euclidean KNN by all pairs: ties go to the earlier row."""
    out = x.copy()
    for i, t in zip(*np.nonzero(np.isnan(x)), strict=True):
        both = ~np.isnan(x) & ~np.isnan(x[i])
        d = np.where(both, x - x[i], 0.0)
        n = both.sum(axis=1)
        can = ~np.isnan(x[:, t]) & (n > 0)
        near = sorted(((d[j] ** 2).sum() * (x.shape[1] / n[j]), j) for j in np.flatnonzero(can))[:k]
        out[i, t] = np.mean([x[j, t] for _, j in near]) if near else np.nanmean(x[:, t])
    return out


@pytest.mark.parametrize(("columns", "leaf"), [(3, 8), (2, 4)])
def test_knn_of_patterns_matches_brute_force(spark, columns, leaf):
    rng = np.random.default_rng(columns)
    n = 160
    x = np.stack([rng.integers(0, 12, n), rng.exponential(50, n).round(1), rng.normal(size=n).round(2) * 8][:columns], axis=1).astype(float)
    x[rng.random((n, columns)) < 0.15] = np.nan
    x[::9] = x[0]  # repeated rows
    names = ["a", "b", "c"][:columns]
    pdf = pd.DataFrame(x, columns=names).assign(rid=np.arange(n), note=[None if i % 4 else "x" for i in range(n)])
    got = impute_knn(spark.createDataFrame(pdf), names, k=5, tie=["rid"], leaf=leaf).toPandas().sort_values("rid")
    assert len(got) == n
    np.testing.assert_allclose(got[names].to_numpy(dtype=float), _knn_brute_patterns(x, 5), rtol=1e-9)


def test_token_sort_ratio():
    assert round(token_sort_ratio("product", "product_id"), 2) == 82.35
    assert token_sort_ratio("region", "region") == 100.0


def test_days_from_start_uses_fitted_range(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 11),)], "order_date date")
    out = temporal_features(df).orderBy("order_date").collect()
    assert [r["days_from_start"] for r in out] == [0, 10] and [r["days_from_end"] for r in out] == [10, 0]


def test_impute_missing_of_three_columns_matches_all_pairs(spark):
    rng = np.random.default_rng(12)
    x = rng.integers(0, 9, (60, 3)).astype(float)
    for j in range(3):
        x[rng.choice(60, 12, replace=False), j] = np.nan
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(k=np.arange(60))
    out = impute.impute_missing(spark.createDataFrame(pdf), knn_threshold=0.3, k=4).orderBy("k").toPandas()
    for j, name in enumerate(["a", "b", "c"]):
        for i in range(60):
            if not np.isnan(x[i, j]):
                assert out[name][i] == x[i, j]
                continue
            near = []
            for d in range(60):
                both = ~np.isnan(x[i]) & ~np.isnan(x[d])
                if not np.isnan(x[d, j]) and both.any():
                    near.append((((x[i] - x[d])[both] ** 2).sum() * 3 / both.sum(), d))
            # the k nearest; any choice among equally far ones lies between the extremes
            near.sort()
            if not near:
                assert out[name][i] == pytest.approx(np.nanmean(x[:, j]))
                continue
            edge = near[min(4, len(near)) - 1][0]
            sure = [x[d, j] for q, d in near if q < edge - 1e-9]
            tied = sorted(x[d, j] for q, d in near if abs(q - edge) <= 1e-9)
            size = min(4, len(near))
            rest = size - len(sure)
            assert (sum(sure) + sum(tied[:rest])) / size - 1e-9 <= out[name][i] <= (sum(sure) + sum(tied[-rest:])) / size + 1e-9
