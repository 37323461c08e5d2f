"""Registered queries: each is (spark, sf_dir) -> DataFrame over the whole ``sales`` view,
paired with an equivalent DuckDB statement over the same parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import temporal
from ledgerlens.operators import groupstats, lags
from ledgerlens.plans import features as feat
from ledgerlens.plans.checks import finalize, wrap_sql
from ledgerlens.session import stored
from ledgerlens.sources.tables import ORDER_COLS, sales_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SALES_SQL = """SELECT CAST(o.o_orderdate AS DATE) AS order_date, r.r_name AS region, p.p_type AS category,
 p.p_brand AS sub_category, l.l_partkey AS product_id, p.p_name AS product_name, l.l_quantity AS quantity,
 l.l_extendedprice * (1.0 - l.l_discount) AS sales,
 l.l_extendedprice * (1.0 - l.l_discount) - l.l_quantity * p.p_retailprice AS profit,
 o.o_custkey AS customer_id, l.l_linestatus AS line_status, l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey"""

SF_SQL = """SELECT *, CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
 CAST(day(order_date) AS INTEGER) AS day, CAST(quarter(order_date) AS INTEGER) AS quarter,
 CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week FROM sales"""

CTES = f"sales AS ({SALES_SQL}), sf AS ({SF_SQL})"
ORDER_SQL = ", ".join(ORDER_COLS)
ROW_ID = [("l_orderkey", "i"), ("l_linenumber", "i"), ("product_id", "i"), ("l_suppkey", "i")]
RID = [c for c, _ in ROW_ID]
TARGETS = ("quantity", "profit")


def register(name: str, spec, sql_inner: str | None):
    def deco(fn):
        QUERIES[name] = (lambda spark, sf_dir: finalize(fn(spark, sf_dir), spec)) if spec else fn
        if sql_inner is not None:
            SQL[name] = wrap_sql(sql_inner, spec, CTES)
        return fn
    return deco


def _sales(spark, sf_dir):
    return sales_view(spark, sf_dir)


def _sf(spark, sf_dir):
    d = feat.with_date_parts(_sales(spark, sf_dir))
    return d.withColumns({"quarter": F.quarter("order_date"), "day_of_week": temporal.day_of_week("order_date")})


def _sf_stored(spark, sf_dir, *columns):
    """The columns that a query reads, joined once and stored, for queries that read the rows more than once."""
    return stored(_sf(spark, sf_dir).select(*dict.fromkeys(columns)))


# ---------------------------------------------------------------- step 1: fact + one key
SALES_SPEC = [("order_date", "date"), ("region", "s"), ("product_id", "i"), ("category", "s"), ("sub_category", "s"),
              ("product_name", "s"), ("year", "i"), ("month", "i"), ("day", "i"), ("quantity", "d6"), ("profit", "d6"),
              ("l_orderkey", "i"), ("l_linenumber", "i"), ("l_suppkey", "i")]


@register("sales_fact", SALES_SPEC, "SELECT * FROM sf WHERE region IS NOT NULL AND product_id IS NOT NULL AND category IS NOT NULL "
          "AND sub_category IS NOT NULL AND product_name IS NOT NULL")
def q_sales_fact(spark, sf_dir):
    return feat.essential(_sales(spark, sf_dir), extra=["l_orderkey", "l_linenumber", "l_suppkey"])


def _stat_spec(key, key_kind):
    spec = [(key, key_kind)]
    for t in TARGETS:
        spec += [(f"{t}_{key}_{s}", "d6") for s in ("mean", "std", "median", "min", "max", "q25", "q75")]
    spec.append((f"{key}_count", "i"))
    return spec


def _stat_sql(key):
    cols = []
    for t in TARGETS:
        cols += [f"avg({t}) AS {t}_{key}_mean", f"stddev_samp({t}) AS {t}_{key}_std",
                 f"quantile_cont({t}, 0.5) AS {t}_{key}_median", f"min({t}) AS {t}_{key}_min",
                 f"max({t}) AS {t}_{key}_max", f"quantile_cont({t}, 0.25) AS {t}_{key}_q25",
                 f"quantile_cont({t}, 0.75) AS {t}_{key}_q75"]
    cols.append(f"count({TARGETS[-1]}) AS {key}_count")
    return f"SELECT {key}, {', '.join(cols)} FROM sf WHERE {key} IS NOT NULL GROUP BY {key}"


KEY_KINDS = {"region": "s", "category": "s", "sub_category": "s", "product_id": "i", "year": "i", "month": "i",
             "quarter": "i", "day_of_week": "i"}

for _key, _kind in KEY_KINDS.items():
    def _mk(key):
        def q(spark, sf_dir):
            return groupstats.group_stats(_sf(spark, sf_dir), key)
        return q
    register(f"group_stats_{_key}", _stat_spec(_key, _kind), _stat_sql(_key))(_mk(_key))

REGION_ROW_SPEC = ROW_ID + [("region", "s")] + _stat_spec("region", "s")[1:]


@register("region_stats", REGION_ROW_SPEC,
          f"SELECT s.*, g.* EXCLUDE (region) FROM sf s LEFT JOIN ({_stat_sql('region')}) g ON s.region = g.region")
def q_region_stats(spark, sf_dir):
    return groupstats.add_group_stats(_sf(spark, sf_dir).select(*RID, "region", *TARGETS), ["region"])


# ---------------------------------------------------------------- step 2: row features
TEMPORAL_COLS = [("quarter", "i"), ("day_of_week", "i"), ("week_of_year", "i"), ("day_of_year", "i"), ("is_weekend", "i"),
                 ("is_month_start", "i"), ("is_month_end", "i"), ("is_quarter_start", "i"), ("is_quarter_end", "i"),
                 ("days_from_start", "i"), ("days_from_end", "i"), ("month_sin", "d6"), ("month_cos", "d6"),
                 ("day_of_week_sin", "d6"), ("day_of_week_cos", "d6"), ("day_of_year_sin", "d6"), ("day_of_year_cos", "d6")]

TEMPORAL_SQL = """SELECT *, weekofyear(order_date) AS week_of_year, dayofyear(order_date) AS day_of_year,
 CASE WHEN day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend,
 CASE WHEN day(order_date) = 1 THEN 1 ELSE 0 END AS is_month_start,
 CASE WHEN order_date = last_day(order_date) THEN 1 ELSE 0 END AS is_month_end,
 CASE WHEN order_date = CAST(date_trunc('quarter', order_date) AS DATE) THEN 1 ELSE 0 END AS is_quarter_start,
 CASE WHEN order_date = last_day(CAST(date_trunc('quarter', order_date) AS DATE) + INTERVAL 2 MONTH) THEN 1 ELSE 0 END AS is_quarter_end,
 date_diff('day', (SELECT min(order_date) FROM sales), order_date) AS days_from_start,
 date_diff('day', order_date, (SELECT max(order_date) FROM sales)) AS days_from_end,
 sin(2 * pi() * month / 12.0) AS month_sin, cos(2 * pi() * month / 12.0) AS month_cos,
 sin(2 * pi() * day_of_week / 7.0) AS day_of_week_sin, cos(2 * pi() * day_of_week / 7.0) AS day_of_week_cos,
 sin(2 * pi() * dayofyear(order_date) / 365.0) AS day_of_year_sin, cos(2 * pi() * dayofyear(order_date) / 365.0) AS day_of_year_cos
FROM sf"""


@register("temporal_features", ROW_ID + [("order_date", "date")] + TEMPORAL_COLS, TEMPORAL_SQL)
def q_temporal(spark, sf_dir):
    return feat.temporal_features(feat.with_date_parts(_sales(spark, sf_dir)))


@register("date_parts", ROW_ID + [("year", "i"), ("month", "i"), ("year_month", "s")],
          "SELECT *, CAST(year AS VARCHAR) || '_' || CAST(month AS VARCHAR) AS year_month FROM sf")
def q_date_parts(spark, sf_dir):
    return _sales(spark, sf_dir).select("*", *[c.alias(k) for k, c in temporal.year_month_columns("order_date").items()])


INTER_COLS = ["region_category", "region_sub_category", "category_sub_category", "category_month", "region_month",
              "category_quarter", "region_quarter", "category_day_of_week", "year_month", "year_quarter"]
INTER_SQL = """SELECT *, region || '_' || category AS region_category, region || '_' || sub_category AS region_sub_category,
 category || '_' || sub_category AS category_sub_category, category || '_' || CAST(month AS VARCHAR) AS category_month,
 region || '_' || CAST(month AS VARCHAR) AS region_month, category || '_' || CAST(quarter AS VARCHAR) AS category_quarter,
 region || '_' || CAST(quarter AS VARCHAR) AS region_quarter, category || '_' || CAST(day_of_week AS VARCHAR) AS category_day_of_week,
 CAST(year AS VARCHAR) || '_' || CAST(month AS VARCHAR) AS year_month, CAST(year AS VARCHAR) || '_Q' || CAST(quarter AS VARCHAR) AS year_quarter
FROM sf"""


@register("interactions", ROW_ID + [(c, "s") for c in INTER_COLS], INTER_SQL)
def q_interactions(spark, sf_dir):
    return feat.interaction_features(_sf(spark, sf_dir))


def _pct_rank_sql(t):
    return (f"((rank() OVER (ORDER BY {t}) + (count(*) OVER (PARTITION BY {t}) - 1) / 2.0) / count(*) OVER ())")


STAT_COLS = []
for _t in TARGETS:
    STAT_COLS += [(f"{_t}_zscore", "d6"), (f"{_t}_is_outlier", "i"), (f"{_t}_log", "d6"), (f"{_t}_sqrt", "d6"),
                  (f"{_t}_percentile_rank", "d6")]


def _stat_feature_sql():
    cols = []
    for t in TARGETS:
        cols += [f"({t} - avg({t}) OVER ()) / stddev_samp({t}) OVER () AS {t}_zscore",
                 f"CASE WHEN {t} < b.{t}_q1 - 1.5 * (b.{t}_q3 - b.{t}_q1) OR {t} > b.{t}_q3 + 1.5 * (b.{t}_q3 - b.{t}_q1) "
                 f"THEN 1 ELSE 0 END AS {t}_is_outlier",
                 f"ln(1 + abs({t})) AS {t}_log", f"sqrt(abs({t})) AS {t}_sqrt",
                 f"{_pct_rank_sql(t)} AS {t}_percentile_rank"]
    bounds = ", ".join(f"quantile_cont({t}, 0.25) AS {t}_q1, quantile_cont({t}, 0.75) AS {t}_q3" for t in TARGETS)
    return f"SELECT s.*, {', '.join(cols)} FROM sf s, (SELECT {bounds} FROM sf) b"


@register("statistical", ROW_ID + STAT_COLS, _stat_feature_sql())
def q_statistical(spark, sf_dir):
    return lags.statistical_features(_sf_stored(spark, sf_dir, *RID, *TARGETS))


@register("pct_rank", ROW_ID + [("quantity_percentile_rank", "d6"), ("profit_percentile_rank", "d6")],
          f"SELECT *, {_pct_rank_sql('quantity')} AS quantity_percentile_rank, {_pct_rank_sql('profit')} AS profit_percentile_rank FROM sf")
def q_pct_rank(spark, sf_dir):
    d = _sf_stored(spark, sf_dir, *RID, *TARGETS)
    return lags.percentile_rank(lags.percentile_rank(d, "quantity"), "profit", source=d)


KPI_SPEC = ROW_ID + [("profit_margin", "d6"), ("profit_margin_category", "s"), ("quantity_percentile", "d6"),
                     ("high_volume", "i"), ("order_count", "i"), ("total_sales", "d2"), ("avg_order_value", "d2"),
                     ("total_profit", "d2"), ("weekend_performance", "s"), ("month_performance_tier", "s")]
KPI_SQL = f"""SELECT s.*, s.profit / s.sales * 100 AS profit_margin,
 CASE WHEN s.profit / s.sales * 100 <= 0 THEN 'Pérdida' WHEN s.profit / s.sales * 100 <= 10 THEN 'Bajo'
      WHEN s.profit / s.sales * 100 <= 20 THEN 'Medio' ELSE 'Alto' END AS profit_margin_category,
 {_pct_rank_sql('s.quantity')} AS quantity_percentile,
 CASE WHEN s.quantity > (SELECT quantile_cont(quantity, 0.8) FROM sf) THEN 1 ELSE 0 END AS high_volume,
 c.order_count, c.total_sales, c.avg_order_value, c.total_profit,
 CASE WHEN s.day_of_week >= 5 THEN 'Weekend' ELSE 'Weekday' END AS weekend_performance,
 CASE WHEN s.month <= 3 THEN 'Q1' WHEN s.month <= 6 THEN 'Q2' WHEN s.month <= 9 THEN 'Q3' ELSE 'Q4' END AS month_performance_tier
FROM sf s LEFT JOIN (SELECT customer_id, count(sales) AS order_count, round_even(sum(CAST(sales AS DECIMAL(18,4))), 2) AS total_sales,
 round_even(avg(sales), 2) AS avg_order_value, round_even(sum(CAST(profit AS DECIMAL(18,4))), 2) AS total_profit FROM sf GROUP BY customer_id) c
 ON s.customer_id = c.customer_id"""


@register("business_kpis", KPI_SPEC, KPI_SQL)
def q_business(spark, sf_dir):
    d = _sf_stored(spark, sf_dir, *RID, *TARGETS, "order_date", "sales", "customer_id", "year", "month", "day")
    return feat.business_indicators(feat.temporal_features(d))


@register("customer_kpis", [("customer_id", "i"), ("order_count", "i"), ("total_sales", "d2"), ("avg_order_value", "d2"),
                            ("total_profit", "d2")],
          "SELECT customer_id, count(sales) AS order_count, round_even(sum(CAST(sales AS DECIMAL(18,4))), 2) AS total_sales, "
          "round_even(avg(sales), 2) AS avg_order_value, round_even(sum(CAST(profit AS DECIMAL(18,4))), 2) AS total_profit FROM sf GROUP BY customer_id")
def q_customer(spark, sf_dir):
    return groupstats.customer_stats(_sales(spark, sf_dir))


SEASON_COLS = []
for _t in TARGETS:
    SEASON_COLS += [(f"{_t}_monthly_historical_avg", "d6"), (f"{_t}_dow_historical_avg", "d6"),
                    (f"{_t}_quarter_historical_avg", "d6"), (f"{_t}_seasonal_deviation_month", "d6"),
                    (f"{_t}_seasonal_deviation_quarter", "d6"), (f"{_t}_seasonal_index_month", "d6"),
                    (f"{_t}_seasonal_index_quarter", "d6")]


def _season_sql():
    cols = []
    for t in TARGETS:
        cols += [f"avg({t}) OVER (PARTITION BY month) AS {t}_monthly_historical_avg",
                 f"avg({t}) OVER (PARTITION BY day_of_week) AS {t}_dow_historical_avg",
                 f"avg({t}) OVER (PARTITION BY quarter) AS {t}_quarter_historical_avg",
                 f"{t} - avg({t}) OVER (PARTITION BY month) AS {t}_seasonal_deviation_month",
                 f"{t} - avg({t}) OVER (PARTITION BY quarter) AS {t}_seasonal_deviation_quarter",
                 f"avg({t}) OVER (PARTITION BY month) / avg({t}) OVER () AS {t}_seasonal_index_month",
                 f"avg({t}) OVER (PARTITION BY quarter) / avg({t}) OVER () AS {t}_seasonal_index_quarter"]
    return f"SELECT *, {', '.join(cols)} FROM sf"


@register("seasonal", ROW_ID + SEASON_COLS, _season_sql())
def q_seasonal(spark, sf_dir):
    return groupstats.seasonal_features(_sf_stored(spark, sf_dir, *RID, *TARGETS, "month", "quarter", "day_of_week"))


# ---------------------------------------------------------------- step 4: sequences
def _ordered(spark, sf_dir, *keys):
    """The rows in their total order, with only the columns that the sequence features read: they are stored."""
    rows = _sf(spark, sf_dir).select(*ORDER_COLS, *keys, "profit")
    return lags.with_global_index(rows).drop("order_date", "l_extendedprice")


def _w(part=None, frame=None):
    p = f"PARTITION BY {part} " if part else ""
    f = f" ROWS BETWEEN {frame} PRECEDING AND CURRENT ROW" if frame is not None else ""
    return f"OVER ({p}ORDER BY {ORDER_SQL}{f})"


LAG_NAMES = []
for _t in TARGETS:
    LAG_NAMES += [f"{_t}_lag1", f"{_t}_lag3", f"{_t}_lag7", f"{_t}_rolling_mean_3", f"{_t}_rolling_mean_7",
                  f"{_t}_rolling_std_3", f"{_t}_rolling_std_7"]


def _lag_sql_cols():
    cols = []
    for t in TARGETS:
        w = _w("product_id")
        cols += [f"lag({t}, 1) {w} AS {t}_lag1", f"lag({t}, 3) {w} AS {t}_lag3", f"lag({t}, 7) {w} AS {t}_lag7",
                 f"avg({t}) {_w('product_id', 2)} AS {t}_rolling_mean_3", f"avg({t}) {_w('product_id', 6)} AS {t}_rolling_mean_7",
                 f"stddev_samp({t}) {_w('product_id', 2)} AS {t}_rolling_std_3",
                 f"stddev_samp({t}) {_w('product_id', 6)} AS {t}_rolling_std_7"]
    return cols


@register("product_lags", ROW_ID + [(c, "d6") for c in LAG_NAMES], f"SELECT *, {', '.join(_lag_sql_cols())} FROM sf")
def q_product_lags(spark, sf_dir):
    d = _ordered(spark, sf_dir)
    return lags.product_lags(d)


def _rolling_q(key):
    def q(spark, sf_dir):
        d = _ordered(spark, sf_dir, key)
        return lags.rolling_by(d, key)
    return q


for _key in ("category", "region"):
    _cols = [(f"{t}_{_key}_rolling_mean_7", "d6") for t in TARGETS]
    register(f"rolling_{_key}", ROW_ID + _cols,
             "SELECT *, " + ", ".join(f"avg({t}) {_w(_key, 6)} AS {t}_{_key}_rolling_mean_7" for t in TARGETS) + " FROM sf"
             )(_rolling_q(_key))

FILLED_LAG = LAG_NAMES + [f"{t}_{k}_rolling_mean_7" for k in ("category", "region") for t in TARGETS]


def _ffill_sql(inner_cols, names):
    fill = ", ".join(f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY {ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING "
                     f"AND CURRENT ROW), 0) AS {c}" for c in names)
    return f"SELECT * EXCLUDE ({', '.join(names)}), {fill} FROM (SELECT *, {', '.join(inner_cols)} FROM sf)"


@register("lag_filled", ROW_ID + [(c, "d6") for c in FILLED_LAG],
          _ffill_sql(_lag_sql_cols() + [f"avg({t}) {_w(k, 6)} AS {t}_{k}_rolling_mean_7" for k in ("category", "region")
                                        for t in TARGETS], FILLED_LAG))
def q_lag_filled(spark, sf_dir):
    d = _ordered(spark, sf_dir, "category", "region")
    return lags.lag_features(d)


TREND_NAMES = []
for _t in TARGETS:
    TREND_NAMES += [f"{_t}_diff1", f"{_t}_diff7", f"{_t}_diff30", f"{_t}_ratio1", f"{_t}_ratio7", f"{_t}_momentum_3",
                    f"{_t}_momentum_7", f"{_t}_volatility"]


def _trend_cols():
    cols = []
    w = _w()
    for t in TARGETS:
        cols += [f"{t} - lag({t}, 1) {w} AS {t}_diff1", f"{t} - lag({t}, 7) {w} AS {t}_diff7",
                 f"{t} - lag({t}, 30) {w} AS {t}_diff30", f"{t} / (lag({t}, 1) {w} + 1e-8) AS {t}_ratio1",
                 f"{t} / (lag({t}, 7) {w} + 1e-8) AS {t}_ratio7", f"{t} / (lag({t}, 3) {w} + 1e-8) AS {t}_momentum_3",
                 f"{t} / (lag({t}, 7) {w} + 1e-8) AS {t}_momentum_7",
                 f"stddev_samp({t}) {_w(None, 6)} / (avg({t}) {_w(None, 6)} + 1e-8) AS {t}_volatility"]
    return cols


@register("trend", ROW_ID + [(c, "d6") for c in TREND_NAMES], _ffill_sql(_trend_cols(), TREND_NAMES))
def q_trend(spark, sf_dir):
    d = _ordered(spark, sf_dir)
    return lags.trend_features(d)
