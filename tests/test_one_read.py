"""Queries that use the fact rows several times join them once."""

import pytest

from ledgerlens.operators import groupstats, lags, quantile
from ledgerlens.plans import registry, registry_eval, registry_models, registry_prep  # noqa: F401
from ledgerlens.sources import tables


@pytest.fixture()
def star(spark, tmp_path):
    """A star of 40 lines."""
    n = 40
    frames = {
        "lineitem": ([(i // 2, i % 4, i % 3, i % 2, float(i % 7 + 1), 10.0 * (i + 1), 0.1, "OF"[i % 2]) for i in range(n)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_linestatus string"),
        "orders": ([(i, i % 5, f"1995-0{i % 9 + 1}-1{i % 9}") for i in range(n // 2)], "o_orderkey long, o_custkey long, o_orderdate string"),
        "customer": ([(i, i % 2) for i in range(5)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, 0), (1, 1)], "n_nationkey int, n_regionkey int"),
        "region": ([(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string"),
        "part": ([(i, f"p{i}", f"b{i % 2}", "PROMO" if i % 2 else "SMALL", 5.0) for i in range(4)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double")}
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["statistical", "pct_rank", "business_kpis", "seasonal", "winsorize", "target_outliers", "impute_median",
                                  "label_encode", "boxcox", "basic_metrics", "advanced_metrics", "breusch_pagan", "residual_outliers",
                                  "diagnosis", "anderson", "mi_binned", "region_stats", "vote", "impute_knn", "shapiro"])
def test_the_result_reads_stored_rows(spark, star, name):
    out = registry.QUERIES[name](spark, star)
    assert "o_custkey" not in _plan(out)  # the joins of the fact are behind the stored rows
    assert out.count() >= 0


def test_lines_meet_customers_on_their_orders(spark, star):
    plan = _plan(tables.sales_view(spark, star))
    # the join with the customers holds no columns of the lines below it
    at = next(i for i, x in enumerate(plan.splitlines()) if "o_custkey" in x and "Join" in x)
    lines = plan.splitlines()
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    below = [x for x in lines[at + 1:]]
    under = []
    for x in below:
        if len(x) - len(x.lstrip(" :+-")) <= depth:
            break
        under.append(x)
    assert under and not any("l_quantity" in x for x in under)


def test_group_joins_of_quantiles_are_broadcast(spark, monkeypatch):
    joined = []
    real = quantile._join_small
    monkeypatch.setattr(quantile, "_join_small", lambda big, small, on, how="inner": joined.append((big, small, on)) or real(big, small, on, how))
    d = spark.range(4000).selectExpr("id % 2 as g", "cast(id as double) as v")
    out = quantile.group_quantiles(d, "v", [0.25], ["g"], group_rows=100, accuracy=100)
    assert sorted(r[1] for r in out.collect()) == [999.5, 1000.5]
    rows = [small for big, small, _ in joined if big.columns == ["g", "_v"]]
    assert rows and all("ResolvedHint" in s._jdf.queryExecution().analyzed().toString() for s in rows)


def test_seasonal_averages_skip_nulls_and_missing_keys(spark):
    rows = [(1, 1, 1, 2.0, None), (1, 2, 1, 4.0, 3.0), (2, 1, None, None, 5.0), (None, 1, 1, 8.0, 7.0)]
    d = spark.createDataFrame(rows, "month int, day_of_week int, quarter int, quantity double, profit double")
    got = {(r["month"], r["day_of_week"]): r for r in groupstats.seasonal_features(d).collect()}
    assert got[(1, 1)]["quantity_monthly_historical_avg"] == 3.0 and got[(1, 1)]["profit_monthly_historical_avg"] == 3.0
    assert got[(2, 1)]["quantity_monthly_historical_avg"] is None and got[(2, 1)]["quantity_dow_historical_avg"] == 5.0
    assert got[(None, 1)]["quantity_monthly_historical_avg"] is None and got[(None, 1)]["profit_quarter_historical_avg"] == 5.0


def test_rank_of_widened_rows_counts_the_source(spark):
    d = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "v double")
    out = lags.percentile_rank(d.withColumn("w", d.v * 2), "v", "r", source=d).collect()
    assert sorted((r["v"], round(r["r"], 6)) for r in out if r["v"]) == [(1.0, round(1 / 3, 6)), (2.0, round(2.5 / 3, 6)), (2.0, round(2.5 / 3, 6))]


def test_few_ranks_are_broadcast(spark):
    d = spark.createDataFrame([(float(i % 3),) for i in range(30)], "v double")
    assert "BroadcastHashJoin" in lags.percentile_rank(d.repartition(3), "v")._jdf.queryExecution().sparkPlan().toString()
