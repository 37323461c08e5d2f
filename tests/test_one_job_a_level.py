"""Trees of many rows: levels routed at once, one job a level, every round of models of few rows in a large table."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.modeling import boosting
from ledgerlens.modeling.boosting import Booster, Nodes, Spec, Tree, bin_table, find_cuts, fit_many, route, step_down
from ledgerlens.modeling import forest, importance


def random_tree(rng, levels, numeric, codes):
    tree, open_ = Tree(), [0]
    for _ in range(levels):
        for node in [n for n in open_ if rng.random() < 0.9]:
            f = int(rng.integers(numeric + 1))
            b = int(rng.integers(0, 250)) if f < numeric else -1 - int(rng.integers(codes))
            tree.split[node] = {"feature": f, "bin": b, "missing_left": bool(rng.random() < 0.5), "gain": 1.0, **dict.fromkeys(("gl", "hl", "cl", "g", "h", "c"), 0.0)}
            tree.grow(node)
        open_ = [n for n, f in enumerate(tree.feature) if f < 0]
    return tree


@pytest.mark.parametrize("levels", [0, 1, 6, 9])
def test_route_follows_every_split(levels):
    rng = np.random.default_rng(levels)
    for _ in range(5):
        tree = random_tree(rng, levels, 4, 30).arrays()
        x = np.concatenate([rng.integers(0, 256, (4, 3000)), rng.integers(-1, 40, (1, 3000))]).astype(np.int32)
        node = np.zeros(3000, dtype=np.int64)
        for _ in range(levels):
            node = step_down(x, tree, node)
        assert np.array_equal(route(x, tree, levels), node)
        assert np.array_equal(route(x, tuple(tree), levels), node) and isinstance(tree, Nodes)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(3000).select(F.col("id").alias("pos"), (F.col("id") % 5).cast("int").alias("fold"), F.rand(1).alias("a"), F.rand(2).alias("b"),
                                    F.rand(3).alias("c")).withColumn("y", F.col("a") * 3 + F.sin(F.col("b") * 9) + F.col("c") * F.col("a")).checkpoint()


def test_a_level_is_one_job_though_some_leaves_are_small(rows, monkeypatch):
    table = bin_table(rows, ["a", "b", "c"], ["y"], "fold", "pos", parts=4)
    specs = [Spec("xgb", {"n_estimators": 3, "max_depth": 4}, "y", 0), Spec("lgbm", {"n_estimators": 3, "max_depth": 4, "num_leaves": 9}, "y", 1)]
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 0)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    whole = fit_many(table, specs)
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 600)  # of 2400
    jobs, frame = [], type(rows)
    monkeypatch.setattr(frame, "toArrow", lambda self, run=frame.toArrow: jobs.append(1) or run(self))
    some = fit_many(table, specs)
    assert len(jobs) <= 3 * 4  # rounds x levels
    for a, b in zip(whole, some, strict=True):
        for s, t in zip(a.trees, b.trees, strict=True):
            assert (s["feature"], s["left"], s["threshold"]) == (t["feature"], t["left"], t["threshold"])
            assert np.allclose(s["value"], t["value"])


def test_models_of_few_rows_of_a_large_table_learn_in_every_round(rows, monkeypatch):
    table = bin_table(rows, ["a", "b", "c"], ["y"], "fold", "pos", parts=4)
    specs = [Spec("lgbm", {"n_estimators": 4}, "y", f, 300) for f in (0, 1)]
    expected = fit_many(table, specs)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 0)  # the table is too large to go whole to a task
    found = fit_many(table, specs)
    assert [len(m.trees) for m in found] == [4, 4]
    for a, b in zip(expected, found, strict=True):
        for s, t in zip(a.trees, b.trees, strict=True):
            assert s["feature"] == t["feature"] and np.allclose(s["value"], t["value"])


def test_cuts_are_merged_per_feature(spark, monkeypatch):
    rng = np.random.default_rng(3)
    values = [(float(v) if i % 7 else None, float(i % 4), float("nan") if i % 5 else 2.5) for i, v in enumerate(rng.normal(size=2000))]
    df = spark.createDataFrame(values, "a double, b double, c double")
    keys, frame = [], type(df)
    monkeypatch.setattr(frame, "groupBy", lambda self, *by, run=frame.groupBy: keys.append(by) or run(self, *by))
    a, b, c = find_cuts(df, ["a", "b", "c"], 64)
    assert keys[-1] == ("i",)  # a task a feature, not one for all of them
    known = np.sort([v[0] for v in values if v[0] is not None])
    assert np.array_equal(a, known[np.ceil(np.arange(1, 63) / 63 * len(known)).astype(int) - 1])
    assert b.tolist() == [0.0, 1.0, 2.0] and c.tolist() == []
    assert find_cuts(df.where("a > 1e9"), ["a"], 64)[0].tolist() == []


def test_forest_cells_are_counted_once(monkeypatch):
    rng = np.random.default_rng(4)
    shape = {"nf": 5, "width": 9, "values": [6], "first_code": 0, "total": 11}
    for leaves in (1, 8):
        slot = forest._draw(shape, 1, 2, range(leaves), 4)
        x = np.concatenate([rng.integers(0, 9, (5, 700)), rng.integers(-1, 6, (1, 700))])
        rows = np.sort(rng.choice(700, 500, replace=False))
        leaf, w = rng.integers(0, leaves, 500), rng.integers(1, 4, 500).astype(float)
        key, which = forest._keys(shape, slot, leaf, x, x[:5], rows)
        expected = np.zeros(forest._size(shape, slot, leaves))
        for i, r in enumerate(rows):
            for s, (f, of) in enumerate(zip(slot.feature, slot.leaf, strict=True)):
                if of == leaf[i]:
                    expected[s * 9 + x[f, r]] += w[i]
            for s, k in enumerate(slot.keys[0]):
                if k == leaf[i] * 6 + x[5, r] and x[5, r] >= 0:
                    expected[len(slot.feature) * 9 + s] += w[i]
            expected[len(expected) - leaves + leaf[i]] += w[i]
        assert np.array_equal(np.bincount(key, w[which], len(expected)), expected)


def raw_margin(m, row):
    total = m.base
    for t in m.trees:
        node = 0
        while t["feature"][node] >= 0:
            v = row[t["feature"][node]]
            named = t["category"][node]
            left = v != named if named is not None else t["missing_left"][node] if v is None else v <= t["threshold"][node]
            node = t["left"][node] if left else t["right"][node]
        total += t["value"][node]
    return total


def test_scores_and_permutations_use_each_value_coded_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = [(None if i % 9 == 0 else float(v), float(i % 13), "xyz"[i % 3], float(v) * (i % 3) + i % 13) for i, v in enumerate(rng.normal(size=600))]
    df = spark.createDataFrame(data, "a double, b double, s string, y double").coalesce(1)
    m = fit_many(bin_table(df, ["a", "b"], ["y"], categories=["s"], parts=2), [Spec("xgb", {"n_estimators": 6, "max_depth": 8}, "y")])[0]
    found = [r["prediction"] for r in m.predict(df).collect()]
    assert np.allclose(found, [raw_margin(m, r) for r in data])
    coded, frame = [], Booster.coded

    class Grouped:
        def groupBy(self, *by):
            return self

        def applyInArrow(self, score, schema):
            monkeypatch.setattr(Booster, "coded", lambda self, x: coded.append(1) or frame(self, x))
            t = pa.table({"x0": pa.array([r[0] for r in data]), "x1": pa.array([r[1] for r in data]), "x2": pa.array([r[2] for r in data]),
                          "y": pa.array([r[3] for r in data]), "pos": pa.array(range(600)), "part": pa.array([0] * 600)})
            self.out = score(t).to_pylist()
            raise StopIteration

    dealt = Grouped()
    monkeypatch.setattr(importance, "ordered_positions", lambda *a, **b: type("W", (), {"withColumn": lambda self, *c: dealt})())
    with pytest.raises(StopIteration):
        importance.permutation_scores(df, {"m": m}, {"m": 1.0}, "y", repeats=2)
    assert len(coded) == 1  # not once a feature and repeat
    to = np.random.default_rng([42, 2, 1, 0]).permutation(600)
    expected = sum((r[3] - raw_margin(m, (r[0], r[1], data[to[i]][2]))) ** 2 for i, r in enumerate(data))
    assert np.isclose(next(r["sse"] for r in dealt.out if (r["f"], r["r"]) == (2, 1)), expected)
