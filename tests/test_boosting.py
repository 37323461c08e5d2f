"""Histogram boosting against a plain tree grower on the same rows."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.modeling import boosting as b


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    n = 400
    x = np.stack([rng.integers(0, 12, n), rng.integers(0, 5, n), np.round(rng.normal(size=n), 1)]).astype(float)
    x[2, rng.random(n) < 0.15] = np.nan
    y = x[0] * 2 + np.where(np.isnan(x[2]), 3.0, x[2]) * x[1] + rng.normal(size=n)
    return pd.DataFrame({"a": x[0], "b": x[1], "c": x[2], "y": np.round(y, 3), "z": (y > y.mean()).astype(float), "fold": np.arange(n) % 4, "pos": np.arange(n)})


def frame(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("c", F.nanvl("c", F.lit(None).cast("double")))


def soft(g, a):
    return math.copysign(max(abs(g) - a, 0.0), g)


def gain_of(g, h, p):
    return soft(g, p["reg_alpha"]) ** 2 / (h + p["reg_lambda"])


def best_by_hand(x, g, h, rows, p):
    """(gain, feature, threshold, missing left) over every cut between values, one row at a time."""
    best = (1e-9, None, None, None)
    total_g, total_h = sum(g[i] for i in rows), sum(h[i] for i in rows)
    for f in range(len(x)):
        values = sorted({x[f][i] for i in rows if not math.isnan(x[f][i])})
        for missing_left in (False, True):
            for t in values:
                left = [i for i in rows if (missing_left if math.isnan(x[f][i]) else x[f][i] <= t)]
                right = len(rows) - len(left)
                hl = sum(h[i] for i in left)
                if not left or not right or min(len(left), right) < p["min_child_samples"] or min(hl, total_h - hl) < p["min_child_weight"]:
                    continue
                gl = sum(g[i] for i in left)
                gain = gain_of(gl, hl, p) + gain_of(total_g - gl, total_h - hl, p) - gain_of(total_g, total_h, p)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, f, t, missing_left)
    return best


def boost_by_hand(x, y, p, binary=False):
    """Margins after all rounds; one leaf is split at a time, the one of largest gain."""
    base = np.mean(y) if not binary else math.log(np.mean(y) / (1 - np.mean(y)))
    margin = np.full(len(y), base)
    gains = []
    for _ in range(p["n_estimators"]):
        chance = 1 / (1 + np.exp(-margin))
        g, h = (chance - y, chance * (1 - chance)) if binary else (margin - y, np.ones(len(y)))
        leaves = [(list(range(len(y))), 0)]
        while p["num_leaves"] is None or len(leaves) < p["num_leaves"]:
            found = [(best_by_hand(x, g, h, r, p) if d < p["max_depth"] else (0, None, None, None), r, d) for r, d in leaves]
            (gain, f, t, side), r, d = max(found, key=lambda q: q[0][0])
            if f is None:
                break
            gains.append(gain)
            left = [i for i in r if (side if math.isnan(x[f][i]) else x[f][i] <= t)]
            rest = set(left)
            leaves = [q for q in leaves if q[0] is not r] + [(left, d + 1), ([i for i in r if i not in rest], d + 1)]
        for r, _ in leaves:
            margin[r] += -p["learning_rate"] * soft(sum(g[i] for i in r), p["reg_alpha"]) / (sum(h[i] for i in r) + p["reg_lambda"])
    return margin, sorted(gains)


CASES = [("xgb", {"n_estimators": 4, "max_depth": 3, "reg_alpha": 2.0, "reg_lambda": 1.5}),
         ("lgbm", {"n_estimators": 3, "max_depth": 6, "num_leaves": 7, "reg_lambda": 0.5}),
         ("lgbm", {"n_estimators": 12, "max_depth": -1, "num_leaves": 4, "min_child_samples": 30}),
         ("boosted", {"n_estimators": 2, "max_depth": 2})]


@pytest.mark.parametrize(("family", "params", "local"), [(*CASES[0], 0), (*CASES[0], 150), (*CASES[0], 1 << 16), (*CASES[1], 0), (*CASES[1], 1 << 16),
                                                        (*CASES[2], 150), (*CASES[3], 1 << 16)])
def test_trees_match_one_split_at_a_time(spark, rows, family, params, local, monkeypatch):
    monkeypatch.setattr(b, "LOCAL_ROWS", local)  # leaves that one task finishes
    params = params | {"subsample": 1.0, "colsample_bytree": 1.0}
    table = b.bin_table(frame(spark, rows), ["a", "b", "c"], ["y"], parts=3)
    model = b.fit_many(table, [b.Spec(family, params, "y")], refresh=2)[0]
    want, gains = boost_by_hand(rows[["a", "b", "c"]].to_numpy().T, rows.y.to_numpy(), b.resolve(family, params))
    assert sorted(g for t in model.trees for g in t["gain"] if g) == pytest.approx(gains)
    got = model.predict(frame(spark, rows)).orderBy("pos").toPandas()
    assert got.prediction.to_numpy() == pytest.approx(want)
    assert sum(model.importances().values()) == pytest.approx(1)


def test_binary_objective(spark, rows):
    params = {"n_estimators": 3, "max_depth": 2, "subsample": 1.0, "colsample_bytree": 1.0}
    table = b.bin_table(frame(spark, rows), ["a", "b", "c"], ["z"], parts=2)
    model = b.fit_many(table, [b.Spec("xgb", params, "z", objective="binary")])[0]
    want, _ = boost_by_hand(rows[["a", "b", "c"]].to_numpy().T, rows.z.to_numpy(), b.resolve("xgb", params), binary=True)
    got = model.predict(frame(spark, rows)).orderBy("pos").toPandas()
    assert got.prediction.to_numpy() == pytest.approx(1 / (1 + np.exp(-want)))


def test_models_fitted_together_are_those_fitted_alone(spark, rows):
    df = frame(spark, rows)
    table = b.bin_table(df, ["a", "b", "c"], ["y", "z"], "fold", "pos", parts=3)
    short = {"n_estimators": 3, "max_depth": 3}
    specs = [b.Spec("xgb", short, "y", fold) for fold in (0, 2)] + [b.Spec("lgbm", {"n_estimators": 5}, "y"), b.Spec("xgb", short, "z", None, 100)]
    together = b.fit_many(table, specs)
    assert [len(m.trees) for m in together] == [3, 3, 5, 3]
    for spec, model in zip(specs, together, strict=True):
        assert b.fit_many(table, [spec])[0].trees == model.trees
    # the model of the first 100 rows equals one that sees nothing else
    alone = b.bin_table(df.where("pos < 100"), ["a", "b", "c"], ["z"], cuts=table.cuts, parts=1)
    first = b.fit_many(alone, [b.Spec("xgb", short | {"subsample": 1.0}, "z")])[0]
    same = b.fit_many(table, [b.Spec("xgb", short | {"subsample": 1.0}, "z", None, 100)])[0]
    assert [t["feature"] for t in first.trees] == [t["feature"] for t in same.trees]


def test_staged_scores_are_those_of_shorter_models(spark, rows):
    table = b.bin_table(frame(spark, rows), ["a", "b", "c"], ["y"], "fold", "pos", parts=2)
    spec = b.Spec("xgb", {"n_estimators": 6, "max_depth": 3}, "y", 1)
    got = {(r.stage, r.part): r for r in b.staged_scores(table, [spec], b.fit_many(table, [spec]), [2, 6]).collect()}
    short = b.fit_many(table, [b.Spec("xgb", {"n_estimators": 2, "max_depth": 3}, "y", 1)])[0]
    pred = short.predict(frame(spark, rows)).toPandas()
    for part, held in (("test", pred[pred.fold == 1]), ("train", pred[pred.fold != 1])):
        e = held.y - held.prediction
        r = got[2, part]
        assert (r.n, r.mae, r.rmse) == (len(held), pytest.approx(e.abs().mean()), pytest.approx(math.sqrt((e * e).mean())))
        assert r.r2 == pytest.approx(1 - (e * e).sum() / ((held.y - held.y.mean()) ** 2).sum())
    assert got[6, "train"].r2 > got[2, "train"].r2


def test_saved_models_score_alike_and_bad_parameters_are_told(spark, rows, tmp_path):
    df = frame(spark, rows)
    table = b.bin_table(df, ["a", "b", "c"], ["y"], parts=1)
    model = b.fit_many(table, [b.Spec("lgbm", {"n_estimators": 3}, "y")])[0]
    model.save(spark, str(tmp_path / "m"))
    again = b.Booster.load(spark, str(tmp_path / "m"))
    assert again == model
    assert again.predict(df).agg(F.sum("prediction")).first() == model.predict(df).agg(F.sum("prediction")).first()
    for bad in ({"learning_rate": 0}, {"subsample": 1.5}, {"depth": 3}, {"num_leaves": 1}):
        with pytest.raises(b.BadParameters):
            b.fit_many(table, [b.Spec("xgb", bad, "y")])
    with pytest.raises(b.BadParameters):
        b.fit_many(table, [b.Spec("xgb", {}, "other")])


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (1.0, None, 5.0), (1.0, None, None)], "a double, e double, y double")
    table = b.bin_table(df, ["a", "e"], ["y"], parts=1)
    model = b.fit_many(table, [b.Spec("xgb", {"n_estimators": 2}, "y")])[0]
    assert [r.prediction for r in model.predict(df).collect()] == [5.0] * 3
    assert model.importances() == {"a": 0.0, "e": 0.0}


# ------------------------------------------------------------------ categories
@pytest.fixture(scope="module")
def strings(rows):
    rng = np.random.default_rng(2)
    n = len(rows)
    pdf = rows[["a", "pos", "fold"]].assign(shop=rng.choice(["north", "south", "east", "west", None], n), item=[f"i{v:02d}" for v in rng.integers(0, 30, n)])
    effect = pdf.shop.map({"north": 5.0, "south": -2.0, "east": 1.0, "west": 0.0}).fillna(9.0) + pdf.item.str[1:].astype(int) % 4
    return pdf.assign(y=np.round(pdf.a + effect + rng.normal(size=n) / 10, 3))


def as_columns(pdf, drop_first):
    """The categories as 0/1 columns, one per value."""
    out, names = [pdf.a.to_numpy(float)], ["a"]
    for c in ("shop", "item"):
        for v in sorted(pdf[c].dropna().unique())[int(drop_first):]:
            out.append((pdf[c] == v).to_numpy(float))
            names.append(f"{c}={v}")
    return np.stack(out), names


@pytest.mark.parametrize(("drop_first", "local"), [(False, 0), (True, 0), (True, 90), (False, 1 << 16)])
def test_categories_split_like_columns_of_their_values(spark, strings, drop_first, local, monkeypatch):
    monkeypatch.setattr(b, "LOCAL_ROWS", local)
    monkeypatch.setattr(b, "CODES", 8)  # several ranges of codes
    df = spark.createDataFrame(strings)
    table = b.bin_table(df, ["a"], ["y"], categories=["shop", "item"], drop_first=drop_first, parts=3)
    params = {"n_estimators": 4, "max_depth": 3, "subsample": 1.0, "colsample_bytree": 1.0}
    model = b.fit_many(table, [b.Spec("xgb", params, "y")], refresh=2)[0]
    x, names = as_columns(strings, drop_first)
    assert table.columns == len(names)
    want, gains = boost_by_hand(x, strings.y.to_numpy(), b.resolve("xgb", params))
    assert sorted(g for t in model.trees for g in t["gain"] if g) == pytest.approx(gains)
    got = model.predict(df).orderBy("pos").toPandas()
    assert got.prediction.to_numpy() == pytest.approx(want)
    # values that no tree names, and missing ones, go the way of all others
    odd = spark.createDataFrame([(1.0, "nowhere", "i99"), (1.0, None, None)], "a double, shop string, item string")
    unseen = model.predict(odd).collect()
    assert unseen[0].prediction == unseen[1].prediction


def test_alphabetically_first_value_has_no_column(spark):
    df = spark.createDataFrame([(v, float(y)) for v, y in (("A", 5), ("B", 1), ("C", 1)) for _ in range(5)], "v string, y double")
    table = b.bin_table(df, [], ["y"], categories=["v"], drop_first=True, parts=1)
    assert table.columns == 2
    model = b.fit_many(table, [b.Spec("xgb", {"n_estimators": 1, "max_depth": 1, "subsample": 1.0, "colsample_bytree": 1.0}, "y")])[0]
    assert [v for t in model.trees for v in t["category"] if v] in (["B"], ["C"])


def test_saved_categories_and_staged_scores(spark, strings, tmp_path):
    df = spark.createDataFrame(strings)
    table = b.bin_table(df, ["a"], ["y"], "fold", categories=["shop", "item"], parts=2)
    specs = [b.Spec("lgbm", {"n_estimators": 20, "min_child_samples": 2}, "y", 1), b.Spec("rf", {"n_estimators": 30, "max_features": 0.5}, "y", 1)]
    models = b.fit_many(table, specs)
    scores = {(r.model, r.part): r.r2 for r in b.staged_scores(table, specs, models).collect()}
    for k, m in enumerate(models):
        m.save(spark, str(tmp_path / f"m{k}"))
        assert b.Booster.load(spark, str(tmp_path / f"m{k}")) == m
        p = m.predict(df.where("fold = 1")).toPandas()
        assert scores[k, "test"] == pytest.approx(1 - ((p.y - p.prediction) ** 2).sum() / ((p.y - p.y.mean()) ** 2).sum())
        assert scores[k, "test"] > 0.7 and m.importances()["shop"] > 0.1
    assert b.fit_many(table, specs[1:])[0].trees == models[1].trees
