import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.edges import edge_window, fill_forward, range_partition, sequenced
from ledgerlens.operators.quantile import column_quantiles, group_quantiles
from ledgerlens.operators.sequence import ordered_positions


def test_group_quantiles_exact_with_refinement(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", "c"], n, p=[0.8, 0.15, 0.05]), "v": np.round(rng.normal(size=n) * 5, 1)})
    pdf.loc[::9, "v"] = np.nan
    df = spark.createDataFrame(pdf)
    probs = [0.25, 0.5, 0.75, 0.9]
    exp = pdf.groupby("g")["v"].quantile(probs).unstack().sort_index()
    # group_rows 0: all groups by boundaries, 500: the larger ones; rows_per_task 20: refinement rounds
    for rpt, rows in ((10**9, 10**9), (10**9, 0), (10**9, 500), (20, 0)):
        got = group_quantiles(df, "v", probs, ["g"], rows_per_task=rpt, fanout=8, group_rows=rows).toPandas().set_index("g").sort_index()
        assert np.allclose(got.values, exp.values)


def test_quantiles_where_the_sketch_errs(spark, monkeypatch):
    """A sketch that misses the ranks makes all values count; many rows share few values, and one group is empty."""
    from ledgerlens.operators import quantile

    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 4000, p=[0.9, 0.1]), "v": np.round(rng.exponential(size=4000), 2)})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([("c", None)], "g string, v double"))
    exp = pdf.groupby("g")["v"].quantile([0.1, 0.5, 0.99]).unstack()
    got = group_quantiles(df, "v", [0.1, 0.5, 0.99], ["g"], group_rows=0).toPandas().set_index("g")
    assert np.allclose(got.loc[["a", "b"]].values, exp.values) and "c" not in got.index
    real = F.percentile_approx
    monkeypatch.setattr(quantile.F, "percentile_approx", lambda c, p, accuracy: F.transform(real(c, p, accuracy), lambda x: x * 0))
    again = group_quantiles(df, "v", [0.1, 0.5, 0.99], ["g"], group_rows=0).toPandas().set_index("g")
    assert np.allclose(again.loc[["a", "b"]].values, exp.values)


def test_column_quantiles_and_global(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 2.0, 3.0, 10.0], "b": [5.0, None, 1.0, 1.0, 1.0]})
    q = column_quantiles(spark.createDataFrame(pdf), ["a", "b"], [0.25, 0.5, 0.75])
    assert np.allclose(q["a"], pdf.a.quantile([0.25, 0.5, 0.75]).values)
    assert np.allclose(q["b"], pdf.b.quantile([0.25, 0.5, 0.75]).values)


def test_ordered_positions_dense(spark):
    df = spark.range(0, 500).withColumn("k", (F.col("id") * 7919) % 500)
    got = ordered_positions(df, ["k"], out="p", partitions=7).select("k", "p").toPandas()
    assert (got.sort_values("k").p.values == np.arange(500)).all()


@pytest.mark.parametrize("partitions", [1, 5, 60])
def test_edge_rows_equal_single_windows(spark, partitions):
    rng = np.random.default_rng(0)
    n = 300
    pdf = pd.DataFrame({"at": rng.permutation(n), "key": rng.choice(["x", "y", "z"], n, p=[0.6, 0.3, 0.1]), "many": rng.integers(0, 90, n), "v": rng.normal(size=n)})
    pdf.loc[pdf["at"] < 30, "key"] = "x"  # partitions that hold one key alone
    df = spark.createDataFrame(pdf)
    d = sequenced(df, ["at"], "pos", partitions)
    assert d.select(range_partition("pos")).distinct().count() == min(partitions, d.rdd.getNumPartitions())

    def cols(w):
        return {"lag1": F.lag("v", 1).over(w), "lag7": F.lag("v", 7).over(w), "rm7": F.avg("v").over(w.rowsBetween(-6, 0)),
                "rs3": F.stddev_samp("v").over(w.rowsBetween(-2, 0))}

    for key in ("key", "many", None):
        got = edge_window(d, "pos", 7, ["v"], cols, key).toPandas().sort_values("at")
        assert list(got.columns) == ["at", "key", "many", "v", "pos", "lag1", "lag7", "rm7", "rs3"] and len(got) == n
        w = Window.partitionBy(*([key] if key else [F.lit(0)])).orderBy("at")
        exp = df.select("at", *[c.alias(k) for k, c in cols(w).items()]).toPandas().sort_values("at")
        for c in ("lag1", "lag7", "rm7", "rs3"):
            assert np.allclose(got[c].values, exp[c].values, equal_nan=True)


@pytest.mark.parametrize("partitions", [1, 4, 10])
def test_fill_forward_matches_ffill(spark, partitions):
    vals = [None, 1.0, None, None, 4.0, None, None, None, float("nan"), 2.0, None]
    pdf = pd.DataFrame({"at": range(len(vals)), "x": vals, "s": [None, "a", None, None, None, None, None, "b", None, None, None]})
    d = sequenced(spark.createDataFrame(pdf.astype({"s": object}), "at long, x double, s string"), ["at"], "pos", partitions)
    got = fill_forward(d, "pos", ["x"]).toPandas().sort_values("at")
    assert list(got.x) == list(pdf.x.ffill().fillna(0)) and list(got["at"]) == list(range(len(vals)))


def test_windows_of_an_empty_table(spark):
    d = sequenced(spark.createDataFrame([], "at long, key string, v double"), ["at"], "pos")
    assert edge_window(d, "pos", 3, ["v"], lambda w: {"l": F.lag("v").over(w)}, "key").count() == 0
    assert fill_forward(d, "pos", ["v"]).count() == 0


def test_approx_quantiles_within_rank_error(spark):
    rng = np.random.default_rng(9)
    v = rng.normal(size=5000)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    got = group_quantiles(df, "v", [0.1, 0.5, 0.9], method="approx", accuracy=1000).first()
    for p, name in ((0.1, "q0_1"), (0.5, "q0_5"), (0.9, "q0_9")):
        rank = (v < got[name]).mean()
        assert abs(rank - p) <= 1.0 / 1000 + 1.0 / 5000


def test_exact_quantiles_end_on_frequent_values(spark):
    """One value far above the limit of a task, a constant column and 0/1 flags."""
    import numpy as np

    from ledgerlens.operators.quantile import group_quantiles

    rows = [(float(i % 4 if i % 10 else 3), 5.0, float(i % 2)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    for k, name in enumerate("abc"):
        got = group_quantiles(df, name, [0.1, 0.5, 0.9], names=["x", "y", "z"], rows_per_task=2).first()
        want = np.quantile([r[k] for r in rows], [0.1, 0.5, 0.9])
        assert [got["x"], got["y"], got["z"]] == list(want)


def test_rounding_leaves_large_values(spark):
    from ledgerlens.plans.checks import finalize

    got = finalize(spark.createDataFrame([(1e12,), (2.5e10,), (1.23456789,)], "x double"), [("x", "d6")]).collect()
    assert [r["x"] for r in got] == [1e12, 2.5e10, 1.234568]


def _reads(df, column):
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    return sum("LogicalRDD [" in x and f"{column}#" in x for x in plan)


def test_keyed_windows_read_nullable_rows_once(spark):
    from pyspark.sql import functions as F

    from ledgerlens.operators.lags import lag_features

    rows = [(i, None if i % 5 == 0 else i % 3, "a" if i % 4 else None, "r", float(i), float(-i)) for i in range(60)]
    d = sequenced(spark.createDataFrame(rows, "at long, product_id long, category string, region string, quantity double, profit double"), ["at"], "_gidx", 4)
    out = lag_features(d, fill="zero")
    # the rows are read once, and once per key for its edges: not once more for the rows without a key
    assert 0 < _reads(out, "_gidx") <= 1 + 3
    got = {r["at"]: r for r in out.collect()}
    assert len(got) == 60
    assert all(got[i]["quantity_lag1"] == 0 and got[i]["quantity_rolling_mean_3"] == 0 for i in range(0, 60, 5))
    assert all(got[i]["quantity_category_rolling_mean_7"] == 0 for i in range(0, 60, 4))
    assert got[6]["quantity_lag1"] == 3.0 and got[18]["quantity_lag3"] == 6.0
    assert out.where(F.col("quantity_region_rolling_mean_7") > 0).count() == 59
