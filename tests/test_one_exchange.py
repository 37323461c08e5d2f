"""Steps that shuffle, store or compute their rows once."""

import math

import numpy as np
import pytest

from ledgerlens.llm import packing
from ledgerlens.modeling import metrics, normality
from ledgerlens.operators import quantile
from ledgerlens.plans import registry_eval


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("values", [[0.5, -1.0, 2.0, 2.0, 2.0, -3.5, 0.1, 7.25] * 40, list(np.random.default_rng(3).normal(size=500))])
def test_anderson_by_range_partitions(spark, values):
    out = metrics.anderson_darling(spark.createDataFrame([(float(v), 0.0) for v in values] + [(None, 0.0), (float("nan"), 0.0)], "y double, pred double"))
    x = np.sort(values)
    z, n = (x - x.mean()) / x.std(ddof=1), len(x)
    low = [math.log(0.5 * math.erfc(-v / math.sqrt(2))) for v in z]
    high = [math.log(0.5 * math.erfc(v / math.sqrt(2))) for v in z]
    wanted = -n - sum((2 * i + 1) * low[i] + (2 * (n - i) - 1) * high[i] for i in range(n)) / n
    assert out.first()["statistic"] == pytest.approx(wanted, rel=1e-9)


def test_anderson_exchanges_the_residuals_once(spark):
    d = spark.range(100).selectExpr("cast(id as double) as y", "0.0D as pred")
    plan = _plan(metrics.anderson_darling(d))
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan


@pytest.mark.parametrize("values", [[], [1.0], [2.0, 2.0]])
def test_anderson_without_spread(spark, values):
    d = spark.createDataFrame([(v, 0.0) for v in values], "y double, pred double")
    assert metrics.anderson_darling(d).first()["statistic"] is None


def test_shapiro_reads_sizes_that_the_planner_knows(spark):
    rows = [("a", float(i % 97), 0.0) for i in range(normality.MAX_N)] + [("b", float(i * i), 0.0) for i in range(30)] + [(None, 1.0, 0.0)]
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # less than the rows, more than the groups
    try:
        out = normality.shapiro_by_group(spark.createDataFrame(rows, "g string, y double, pred double"), "y", "pred", ["g"])
        assert "BroadcastHashJoin" in _plan(out)  # the rows meet the small groups' keys without an exchange
        found = {r["g"]: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert found["a"]["statistic"] is None and found["b"]["statistic"] is not None and found[None]["statistic"] is None
    assert {k: r["n"] for k, r in found.items()} == {"a": normality.MAX_N, "b": 30, None: 1}


def test_quantile_sketch_is_made_once(spark, monkeypatch):
    seen = []
    real = quantile._join_small
    monkeypatch.setattr(quantile, "_join_small", lambda big, small, on, how="inner": seen.append(small) or real(big, small, on, how))
    d = spark.range(4000).selectExpr("id % 2 as g", "cast(id % 37 as double) as v")
    out = {r["g"]: (r["a"], r["b"]) for r in quantile.group_quantiles(d, "v", [0.25, 0.9], ["g"], names=["a", "b"], group_rows=10).collect()}
    rows = d.toPandas().groupby("g").v.quantile([0.25, 0.9]).unstack()
    assert out == {g: (rows.loc[g, 0.25], rows.loc[g, 0.9]) for g in (0, 1)}
    # the first small table joined holds the sketch's cuts: read from the checkpoint, not computed again
    assert "percentile_approx" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_metrics_store_no_row_ids(spark, monkeypatch):
    read = []
    rows = spark.createDataFrame([("x", 1.0, 2.0), ("x", 2.0, 3.5), ("y", 3.0, 5.0)], "category string, quantity double, sales double")
    monkeypatch.setattr(registry_eval, "_sf_stored", lambda spark, sf_dir, *columns: read.append(columns) or rows.select(*columns))
    registry_eval._preds(spark, "none")
    registry_eval.q_anderson(spark, "none")
    registry_eval.q_residual_outlier_summary(spark, "none")
    assert read == [("category", "quantity", "sales"), ("quantity", "sales"), ("category", "quantity")]


def test_encoder_looks_words_up_and_learns_the_missing(monkeypatch):
    from ledgerlens.llm.queries import tokenizer_path

    coder = packing.WordEncoder(tokenizer_path())
    asked = []
    real = coder.ids
    monkeypatch.setattr(coder, "ids", lambda texts: asked.extend(texts) or real(texts))
    texts = ["one two, two,\nthree", "one two, two,\nthree", "", " one", "\n two", "a \n b", "one <|endoftext|> two", "x́y two"]
    plain = [x.ids for x in coder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [list(np.frombuffer(b, dtype="<u4")) for b in coder.encode(texts)] == plain
    assert asked.count(" two") == 1 and coder.rest.get("") is None
