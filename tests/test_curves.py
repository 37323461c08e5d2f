"""Curves over rounds, parameters and training sizes equal separate fits."""

import numpy as np
import pandas as pd
import pytest

from ledgerlens.modeling import boosting as b
from ledgerlens.modeling import curves


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    n = 150
    x = rng.integers(0, 9, n).astype(float)
    return pd.DataFrame({"x": x, "z": rng.integers(0, 4, n).astype(float), "y": x * x + rng.normal(size=n), "fold": np.arange(n) // 50, "pos": np.arange(n)})


@pytest.fixture(scope="module")
def table(spark, rows):
    return b.bin_table(spark.createDataFrame(rows), ["x", "z"], ["y"], "fold", "pos", parts=2)


SMALL = {"n_estimators": 3, "max_depth": 2, "subsample": 1.0, "colsample_bytree": 1.0}


def alone(spark, rows, table, fold, params, size=None, part="test", family="xgb"):
    """r2 of a model fitted on nothing but its training rows."""
    train = rows[rows.fold != fold].sort_values("pos")
    train = train if size is None else train.head(size)
    own = b.bin_table(spark.createDataFrame(train), ["x", "z"], ["y"], cuts=table.cuts, parts=1)
    model = b.fit_many(own, [b.Spec(family, params, "y")])[0]
    held = rows[rows.fold == fold] if part == "test" else train
    p = model.predict(spark.createDataFrame(held)).toPandas()
    return 1 - ((p.y - p.prediction) ** 2).sum() / ((p.y - p.y.mean()) ** 2).sum()


def test_cross_validation(spark, rows, table):
    got = {r.metric: r for r in curves.cross_validation(table, "y", "xgb", SMALL).collect()}
    scores = [alone(spark, rows, table, f, SMALL) for f in range(3)]
    r = got["r2"]
    assert r.scores == pytest.approx(scores) and r["mean"] == pytest.approx(np.mean(scores)) and r["std"] == pytest.approx(np.std(scores))
    assert (r.ci_low, r.ci_high) == pytest.approx(tuple(np.percentile(scores, [2.5, 97.5])))
    assert set(got) == {"r2", "mae", "rmse"}


def test_curve_over_rounds_takes_one_fit_per_fold(spark, rows, table, monkeypatch):
    fits = []
    monkeypatch.setattr(curves, "fit_many", lambda t, s: fits.append(len(s)) or b.fit_many(t, s))
    got = {r.value: r for r in curves.validation_curve(table, "y", "n_estimators", [1, 3], "xgb", SMALL).collect()}
    assert fits == [3]
    for rounds in (1, 3):
        params = {**SMALL, "n_estimators": rounds}
        assert got[rounds].validation_mean == pytest.approx(np.mean([alone(spark, rows, table, f, params) for f in range(3)]))
        assert got[rounds].train_std == pytest.approx(np.std([alone(spark, rows, table, f, params, part="train") for f in range(3)]))
    assert [v for v, r in got.items() if r.is_best] == [max(got, key=lambda v: got[v].validation_mean)]


def test_curve_over_a_parameter_and_forest_rounds(spark, rows, table):
    got = {r.value: r for r in curves.validation_curve(table, "y", "max_depth", [1, 2], "xgb", SMALL).collect()}
    for depth in (1, 2):
        assert got[depth].validation_mean == pytest.approx(np.mean([alone(spark, rows, table, f, {**SMALL, "max_depth": depth}) for f in range(3)]))
    forest = {r.value: r for r in curves.validation_curve(table, "y", "n_estimators", [1, 20], "rf", {"max_depth": 4}).collect()}
    assert forest[20].validation_mean > 0.8 and forest[20].train_mean > forest[1].train_mean - 0.05


def test_learning_curve_takes_first_rows(spark, rows, table):
    got = {r.train_size: r for r in curves.learning_curve(table, "y", "xgb", SMALL, (0.3, 1.0)).collect()}
    assert sorted(got) == [30, 100]
    for size in got:
        assert got[size].validation_mean == pytest.approx(np.mean([alone(spark, rows, table, f, SMALL, size) for f in range(3)]))
        assert got[size].train_mean == pytest.approx(np.mean([alone(spark, rows, table, f, SMALL, size, "train") for f in range(3)]))
    gap = got[100].train_mean - got[100].validation_mean
    assert got[30].final_gap == pytest.approx(gap) and got[30].is_overfitting == (gap > 0.1)


@pytest.mark.parametrize("params", [{"n_estimators": 6, "max_depth": 5}, {"n_estimators": 3, "max_features": 0.5, "min_samples_leaf": 4}])
def test_forests_made_in_one_task_or_in_many_agree(spark, rows, params, monkeypatch):
    df = spark.createDataFrame(rows.assign(v=[f"v{i % 7}" for i in rows.pos]))
    for categories in ([], ["v"]):
        own = b.bin_table(df, ["x", "z"], ["y"], "fold", "pos", parts=3, categories=categories)
        spec = b.Spec("rf", params, "y", 1)
        monkeypatch.setattr(b, "LOCAL_ROWS", 1 << 16)
        whole = b.fit_many(own, [spec])[0]
        monkeypatch.setattr(b, "LOCAL_ROWS", 0)
        steps = b.fit_many(own, [spec])[0]
        for one, other in zip(whole.trees, steps.trees, strict=True):
            # nodes are made in the same order, level by level
            for k in ("feature", "threshold", "category", "depth", "left", "right"):
                assert one[k] == other[k]
            assert one["value"] == pytest.approx(other["value"]) and one["gain"] == pytest.approx(other["gain"])


def test_forest_separates_what_features_separate(spark, rows, table):
    model = b.fit_many(table, [b.Spec("rf", {"n_estimators": 25, "max_depth": 6, "max_features": None}, "y")])[0]
    p = model.predict(spark.createDataFrame(rows)).toPandas()
    assert 1 - ((p.y - p.prediction) ** 2).sum() / ((p.y - p.y.mean()) ** 2).sum() > 0.97
    assert model.importances()["x"] > 0.9 and sum(model.importances().values()) == pytest.approx(1)
    again = b.fit_many(table, [b.Spec("rf", {"n_estimators": 25, "max_depth": 6, "max_features": None}, "y")])[0]
    assert again.trees == model.trees
    # every leaf holds the mean of its drawn rows, so no prediction leaves the range of the labels
    assert p.prediction.between(rows.y.min(), rows.y.max()).all()
    stump = b.fit_many(table, [b.Spec("rf", {"n_estimators": 1, "max_depth": 1, "max_features": None}, "y")])[0].trees[0]
    assert len(stump["feature"]) == 3 and stump["feature"][0] == 0
