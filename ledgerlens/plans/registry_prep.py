"""Registered queries for cleaning, outliers, imputation, transforms, encoding, selection,
scaling and splitting. Dirty variants are made in the query with the same arithmetic on both
sides (see FIXTURES.md); every query reads the whole ``sales`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import clean, encode, impute, outliers, profile, scale, select, split, transform
from ledgerlens.operators.knn import impute_knn
from ledgerlens.operators.sequence import ordered_positions
from ledgerlens.plans.registry import ORDER_SQL, ROW_ID, _sf, register
from ledgerlens.session import stored
from ledgerlens.sources.csv import rename_standard
from ledgerlens.sources.tables import ORDER_COLS

RID = [c for c, _ in ROW_ID]

DIRTY_SQL = """SELECT *,
 CASE WHEN (l_orderkey * 7 + l_linenumber) % 11 = 0 THEN NULL ELSE quantity END AS q_missing,
 CASE WHEN (l_orderkey + product_id) % 13 = 0 THEN NULL ELSE profit END AS p_missing,
 CASE WHEN l_orderkey % 5 < 2 THEN NULL ELSE quantity END AS q_missing_hi,
 CASE WHEN product_id % 9 = 0 THEN NULL ELSE category END AS cat_missing,
 CASE WHEN product_id % 10 < 7 THEN 'A' WHEN product_id % 10 = 7 THEN 'B' END AS cat_dominant,
 CASE WHEN l_orderkey % 20 = 0 THEN quantity END AS sparse95,
 CASE WHEN l_orderkey % 5 < 2 THEN quantity END AS sparse60,
 CASE WHEN product_id % 17 = 0 THEN 'nan' ELSE '  ' || category || ' ' END AS cat_dirty,
 exp(quantity / 10.0) AS skewed,
 CASE WHEN l_orderkey % 997 = 0 THEN quantity * 100 ELSE quantity END AS q_outlier,
 CASE WHEN l_orderkey % 101 = 0 THEN 0.0 ELSE sales END AS sales_zero
FROM sf"""


def _dirty(spark, sf_dir):
    d = _sf(spark, sf_dir)
    ok, pk, ln = F.col("l_orderkey"), F.col("product_id"), F.col("l_linenumber")
    q = F.col("quantity")
    return d.select("*",
                    F.when((ok * 7 + ln) % 11 == 0, F.lit(None)).otherwise(q).cast("double").alias("q_missing"),
                    F.when((ok + pk) % 13 == 0, F.lit(None)).otherwise(F.col("profit")).cast("double").alias("p_missing"),
                    F.when(ok % 5 < 2, F.lit(None)).otherwise(q).cast("double").alias("q_missing_hi"),
                    F.when(pk % 9 == 0, F.lit(None)).otherwise(F.col("category")).alias("cat_missing"),
                    F.when(pk % 10 < 7, "A").when(pk % 10 == 7, "B").alias("cat_dominant"),
                    F.when(ok % 20 == 0, q).alias("sparse95"),
                    F.when(ok % 5 < 2, q).alias("sparse60"),
                    F.when(pk % 17 == 0, F.lit("nan")).otherwise(F.concat(F.lit("  "), F.col("category"), F.lit(" "))).alias("cat_dirty"),
                    F.exp(q / 10.0).alias("skewed"),
                    F.when(ok % 997 == 0, q * 100).otherwise(q).alias("q_outlier"),
                    F.when(ok % 101 == 0, F.lit(0.0)).otherwise(F.col("sales")).alias("sales_zero"))


def _ctes(extra=""):
    from ledgerlens.plans.registry import CTES
    return CTES + f", d AS ({DIRTY_SQL})" + extra


def reg(name, spec, inner):
    """register with the dirty CTE available as ``d``"""
    from ledgerlens.plans import registry
    from ledgerlens.plans.checks import wrap_sql

    def deco(fn):
        register(name, spec, None)(fn)
        if inner is not None:
            registry.SQL[name] = wrap_sql(inner, spec, _ctes())
        return fn
    return deco


# ------------------------------------------------------------------ cleaning
@reg("clean_strings", ROW_ID + [("cat_dirty", "s")],
     r"SELECT * EXCLUDE (cat_dirty), CASE WHEN regexp_replace(cat_dirty, '^\s+|\s+$', '', 'g') = 'nan' THEN NULL "
     r"ELSE regexp_replace(cat_dirty, '^\s+|\s+$', '', 'g') END AS cat_dirty FROM d")
def q_clean_strings(spark, sf_dir):
    d = _dirty(spark, sf_dir).select(*RID, "cat_dirty")
    return clean.clean_strings(d)


DEDUPE_SPEC = ROW_ID + [("quantity", "d6"), ("profit", "d6")]


@reg("dedupe", DEDUPE_SPEC,
     "SELECT DISTINCT * FROM (SELECT l_orderkey, l_linenumber, product_id, l_suppkey, quantity, profit FROM sf "
     "UNION ALL SELECT l_orderkey, l_linenumber, product_id, l_suppkey, quantity, profit FROM sf WHERE l_orderkey % 10 = 0)")
def q_dedupe(spark, sf_dir):
    d = _sf(spark, sf_dir).select(*RID, "quantity", "profit")
    return clean.dedupe(d.unionByName(d.where(F.col("l_orderkey") % 10 == 0)))


PROFILE_COLS = ["sparse95", "sparse60", "q_missing", "p_missing", "quantity", "cat_missing"]


@reg("missing_profile", [("column", "s"), ("missing_ratio", "d6"), ("drop_gt_90", "i"), ("drop_gt_50", "i"), ("all_missing", "i")],
     "SELECT *, CASE WHEN missing_ratio > 0.9 THEN 1 ELSE 0 END AS drop_gt_90, CASE WHEN missing_ratio > 0.5 THEN 1 ELSE 0 END "
     "AS drop_gt_50, CASE WHEN missing_ratio >= 1 THEN 1 ELSE 0 END AS all_missing FROM (" +
     " UNION ALL ".join(f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS missing_ratio FROM d"
                        for c in PROFILE_COLS) + ")")
def q_missing_profile(spark, sf_dir):
    fr = profile.missing_ratio_frame(_dirty(spark, sf_dir), PROFILE_COLS)
    r = F.col("missing_ratio")
    return fr.select("column", r, (r > 0.9).cast("int").alias("drop_gt_90"), (r > 0.5).cast("int").alias("drop_gt_50"),
                     (r >= 1).cast("int").alias("all_missing"))


# ------------------------------------------------------------------ outliers
def _bounds_sql(src, col, k=1.5):
    return (f"(SELECT quantile_cont({col}, 0.25) - {k} * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS lo, "
            f"quantile_cont({col}, 0.75) + {k} * (quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS hi FROM {src})")


def _wins_sql(col, b):
    return f"CASE WHEN {col} < {b}.lo THEN {b}.lo WHEN {col} > {b}.hi THEN {b}.hi ELSE {col} END AS {col}"


WINS_SPEC = ROW_ID + [("q_outlier", "d6"), ("sales", "d6"), ("profit", "d6")]


@reg("winsorize", WINS_SPEC,
     f"SELECT l_orderkey, l_linenumber, product_id, l_suppkey, {_wins_sql('q_outlier', 'b1')}, {_wins_sql('sales', 'b2')}, "
     f"{_wins_sql('profit', 'b3')} FROM d, {_bounds_sql('d', 'q_outlier')} b1, {_bounds_sql('d', 'sales')} b2, "
     f"{_bounds_sql('d', 'profit')} b3")
def q_winsorize(spark, sf_dir):
    d = stored(_dirty(spark, sf_dir).select(*RID, "q_outlier", "sales", "profit"))
    out, _ = outliers.handle_outliers(d, None, ["q_outlier", "sales", "profit"])
    return out


TOUT_SPEC = ROW_ID + [("sales", "d6"), ("q_outlier", "d6"), ("profit", "d6")]


@reg("target_outliers", TOUT_SPEC,
     f"SELECT l_orderkey, l_linenumber, product_id, l_suppkey, {_wins_sql('sales', 'b1')}, q_outlier, {_wins_sql('profit', 'b3')} "
     f"FROM (SELECT d.* FROM d, {_bounds_sql('d', 'q_outlier', 3.0)} t WHERE NOT (q_outlier < t.lo OR q_outlier > t.hi)) f, "
     f"{_bounds_sql('d', 'sales')} b1, "
     f"{_bounds_sql('(SELECT d.* FROM d, ' + _bounds_sql('d', 'q_outlier', 3.0) + ' t WHERE NOT (q_outlier < t.lo OR q_outlier > t.hi))', 'profit')} b3")
def q_target_outliers(spark, sf_dir):
    d = stored(_dirty(spark, sf_dir).select(*RID, "sales", "q_outlier", "profit"))
    out, _ = outliers.handle_outliers(d, "q_outlier", ["sales", "q_outlier", "profit"])
    return out


# ------------------------------------------------------------------ imputation
@reg("impute_median", ROW_ID + [("q_missing_hi", "d6")],
     "SELECT * EXCLUDE (q_missing_hi), coalesce(q_missing_hi, (SELECT quantile_cont(q_missing_hi, 0.5) FROM d)) AS q_missing_hi FROM d")
def q_impute_median(spark, sf_dir):
    d = stored(_dirty(spark, sf_dir).select(*RID, "q_missing_hi"))
    return impute.impute_median(d, ["q_missing_hi"])


def _mode_fill_sql(c):
    top = f"(SELECT v, n FROM (SELECT {c} AS v, count(*) AS n FROM d WHERE {c} IS NOT NULL GROUP BY {c}) ORDER BY n DESC, v LIMIT 1)"
    return (f"coalesce({c}, CASE WHEN (SELECT n FROM {top}) / (SELECT count(*) FROM d) > 0.5 THEN (SELECT v FROM {top}) "
            f"ELSE 'Unknown' END)")


@reg("impute_mode", ROW_ID + [("cat_dominant", "s"), ("cat_missing", "s")],
     f"SELECT l_orderkey, l_linenumber, product_id, l_suppkey, {_mode_fill_sql('cat_dominant')} AS cat_dominant, "
     f"{_mode_fill_sql('cat_missing')} AS cat_missing FROM d")
def q_impute_mode(spark, sf_dir):
    d = _dirty(spark, sf_dir).select(*RID, "cat_dominant", "cat_missing")
    return impute.impute_categorical(d, ["cat_dominant", "cat_missing"])


KNN_ID = ["l_orderkey", "product_id", "l_suppkey", "l_linenumber", "quantity", "l_extendedprice"]


@reg("impute_knn", [(c, "i") for c in KNN_ID[:4]] + [("quantity", "d6"), ("l_extendedprice", "d6"), ("q_missing", "d6"),
                                                    ("p_missing", "d6")], None)
def q_impute_knn(spark, sf_dir):
    d = stored(_dirty(spark, sf_dir).select(*KNN_ID, "order_date", "q_missing", "p_missing"))
    return impute_knn(d, ["q_missing", "p_missing"], k=5, row_id=KNN_ID, tie=["order_date", *KNN_ID])


# ------------------------------------------------------------------ transforms
SKEW_SPEC = ROW_ID + [("skewed_log", "d6"), ("skewed_sqrt", "d6")]


@reg("skew_transforms", SKEW_SPEC, "SELECT *, ln(1 + skewed) AS skewed_log, sqrt(skewed) AS skewed_sqrt FROM d")
def q_skew(spark, sf_dir):
    d = _dirty(spark, sf_dir).select(*RID, "quantity", "profit", "skewed")
    out, _ = transform.apply_transformations(d, target="profit", cols=["quantity", "skewed"], boxcox=False)
    return out


@reg("boxcox", ROW_ID + [("skewed", "d6"), ("skewed_boxcox", "d4")], None)
def q_boxcox(spark, sf_dir):
    d = stored(_dirty(spark, sf_dir).select(*RID, "skewed"))
    out, _ = transform.apply_transformations(d, target=None, cols=["skewed"], boxcox=True)
    return out.select(*RID, "skewed", "skewed_boxcox") if "skewed_boxcox" in out.columns else \
        out.select(*RID, "skewed", F.lit(None).cast("double").alias("skewed_boxcox"))


# ------------------------------------------------------------------ encoding
def _label_sql(c):
    return f"dense_rank() OVER (ORDER BY coalesce(CAST({c} AS VARCHAR), 'nan')) - 1"


@reg("label_encode", ROW_ID + [("sub_category_label", "i"), ("product_name_label", "i"), ("cat_missing_label", "i")],
     f"SELECT *, {_label_sql('sub_category')} AS sub_category_label, {_label_sql('product_name')} AS product_name_label, "
     f"{_label_sql('cat_missing')} AS cat_missing_label FROM d")
def q_label(spark, sf_dir):
    d = stored(_dirty(spark, sf_dir).select(*RID, "sub_category", "product_name", "cat_missing"))
    out = d
    for c in ("sub_category", "product_name", "cat_missing"):
        out = encode.label_encode(out, c, vocab=stored(encode.fit_vocabulary(d, c)))
    return out


@reg("label_encode_unseen", ROW_ID + [("product_code", "i")],
     "SELECT s.*, coalesce(v.code, -1) AS product_code FROM sf s LEFT JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code "
     "FROM (SELECT DISTINCT CAST(product_id AS VARCHAR) AS v FROM sf WHERE year = 1995)) v ON CAST(s.product_id AS VARCHAR) = v.v")
def q_label_unseen(spark, sf_dir):
    d = _sf(spark, sf_dir).withColumn("product_text", F.col("product_id").cast("string"))
    vocab = encode.fit_vocabulary(d.where(F.col("year") == 1995), "product_text")
    return encode.label_encode(d, "product_text", "product_code", vocab=vocab)


REGIONS = ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]          # AFRICA is the dropped first value
CATEGORIES = ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]   # ECONOMY is the dropped first value
ONEHOT_SPEC = ROW_ID + [(f"region_{v}", "i") for v in REGIONS] + [(f"category_{v}", "i") for v in CATEGORIES]


@reg("onehot", ONEHOT_SPEC,
     "SELECT *, " + ", ".join(f"CASE WHEN region = '{v}' THEN 1 ELSE 0 END AS \"region_{v}\"" for v in REGIONS) + ", " +
     ", ".join(f"CASE WHEN category = '{v}' THEN 1 ELSE 0 END AS \"category_{v}\"" for v in CATEGORIES) + " FROM sf")
def q_onehot(spark, sf_dir):
    d = _sf(spark, sf_dir).select(*RID, "region", "category")
    return encode.onehot_drop_first(encode.onehot_drop_first(d, "region"), "category")


@reg("target_encode", ROW_ID + [("product_name_target_encoded", "d6")],
     "SELECT *, avg(quantity) OVER (PARTITION BY product_name) AS product_name_target_encoded FROM sf")
def q_target_encode(spark, sf_dir):
    return encode.target_encode(_sf(spark, sf_dir), "product_name", by="quantity")


STRING_COLS = ["region", "category", "sub_category", "product_name", "line_status", "cat_missing"]


@reg("distinct_counts", [("column", "s"), ("n_distinct", "i")],
     " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM d" for c in STRING_COLS))
def q_distinct(spark, sf_dir):
    return profile.distinct_counts_frame(_dirty(spark, sf_dir), STRING_COLS)


# ------------------------------------------------------------------ selection
VAR_COLS = ["quantity", "profit", "sales", "l_linenumber", "q_const", "q_tiny"]


@reg("low_variance", [("column", "s"), ("variance", "d4"), ("dropped", "i")],
     "SELECT *, CASE WHEN variance < 0.01 THEN 1 ELSE 0 END AS dropped FROM (" +
     " UNION ALL ".join(f"SELECT '{c}' AS \"column\", var_samp({c}) AS variance FROM (SELECT *, quantity * 0 AS q_const, "
                        f"quantity / 1000.0 AS q_tiny FROM sf)" for c in VAR_COLS) + ")")
def q_low_variance(spark, sf_dir):
    d = _sf(spark, sf_dir).withColumns({"q_const": F.col("quantity") * 0, "q_tiny": F.col("quantity") / 1000.0})
    fr = profile.variance_frame(d, VAR_COLS)
    return fr.withColumn("dropped", F.col("column").isin(select.low_variance(d, VAR_COLS)).cast("int"))


CORR_COLS = ["quantity", "sales", "profit", "l_extendedprice", "l_linenumber", "q_lin"]
CORR_PAIRS = [(CORR_COLS[i], CORR_COLS[j]) for j in range(len(CORR_COLS)) for i in range(j)]


@reg("high_corr", [("column_a", "s"), ("column_b", "s"), ("abs_corr", "d6"), ("above", "i")],
     "SELECT *, CASE WHEN abs_corr > 0.95 THEN 1 ELSE 0 END AS above FROM (" +
     " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, abs(corr({a}, {b})) AS abs_corr FROM "
                        f"(SELECT *, quantity * 2 + 1 AS q_lin FROM sf)" for a, b in CORR_PAIRS) + ")")
def q_high_corr(spark, sf_dir):
    d = _sf(spark, sf_dir).withColumn("q_lin", F.col("quantity") * 2 + 1)
    r = F.abs("corr")
    return select.correlation_frame(d, CORR_COLS).select("column_a", "column_b", r.alias("abs_corr"), (r > 0.95).cast("int").alias("above"))


GAP_COLS = ["quantity", "q_missing", "q_missing_hi", "sparse60", "p_missing", "sales_zero", "skewed", "q_outlier", "q_const"]
GAP_PAIRS = [(GAP_COLS[i], GAP_COLS[j]) for j in range(len(GAP_COLS)) for i in range(j)]
GAP_SQL = " UNION ALL ".join(
    f"SELECT {GAP_COLS.index(a)} AS place_a, '{a}' AS column_a, '{b}' AS column_b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
    + ("NULL" if "q_const" in (a, b) else f"corr({a}, {b})") + " AS corr FROM (SELECT *, 3.7 AS q_const FROM d)" for a, b in GAP_PAIRS)


def _gappy(spark, sf_dir):
    return _dirty(spark, sf_dir).withColumn("q_const", F.lit(3.7))


@reg("corr_gaps", [("column_a", "s"), ("column_b", "s"), ("n", "i"), ("corr", "d6")], f"SELECT column_a, column_b, n, corr FROM ({GAP_SQL})")
def q_corr_gaps(spark, sf_dir):
    """AGG19 over columns with gaps; q_missing_hi and sparse60 are never both present."""
    return select.correlation_frame(_gappy(spark, sf_dir), GAP_COLS)


@reg("drop_correlated", [("column", "s"), ("dropped", "i")],
     "SELECT c.col AS \"column\", CAST(EXISTS (SELECT 1 FROM (" + GAP_SQL + ") p WHERE p.column_b = c.col AND abs(p.corr) > 0.95) AS INT) AS dropped "
     "FROM (VALUES " + ", ".join(f"('{c}')" for c in GAP_COLS) + ") c(col)")
def q_drop_correlated(spark, sf_dir):
    """SEL2: the later column of every pair above 0.95 goes."""
    dropped = set(select.high_correlation(_gappy(spark, sf_dir), GAP_COLS, 0.95))
    return spark.createDataFrame([(c, int(c in dropped)) for c in GAP_COLS], "column string, dropped int")


F_COLS = ["quantity", "sales", "l_extendedprice", "l_linenumber", "day_of_week", "month"]


@reg("f_score_topk", [("feature", "s"), ("f_score", "d4"), ("score_rank", "i"), ("selected", "i")],
     "SELECT *, CASE WHEN score_rank <= 3 THEN 1 ELSE 0 END AS selected FROM (SELECT *, row_number() OVER (ORDER BY f_score DESC) "
     "AS score_rank FROM (" + " UNION ALL ".join(
         f"SELECT '{c}' AS feature, corr(coalesce({c}, 0), profit) * corr(coalesce({c}, 0), profit) / "
         f"(1 - corr(coalesce({c}, 0), profit) * corr(coalesce({c}, 0), profit)) * (count(profit) - 2) AS f_score FROM sf"
         for c in F_COLS) + "))")
def q_f_score(spark, sf_dir):
    scores = select.f_regression_scores(_sf(spark, sf_dir), F_COLS, "profit")
    ranked, best = select.select_k_best(scores, len(F_COLS)), select.select_k_best(scores, 3)
    return spark.createDataFrame([(c, scores[c], i + 1, int(c in best)) for i, c in enumerate(ranked)],
                                 "feature string, f_score double, score_rank int, selected int")


# ------------------------------------------------------------------ split + scaling
SPLIT_SQL_EXPR = "CASE WHEN (42 + l_orderkey * 1000003 + l_linenumber * 7919) % 100 < 20 THEN 1 ELSE 0 END"


def _split(d):
    return split.with_split(d, ["l_orderkey", "l_linenumber"], 0.2, 42, integer_keys=True)


@reg("split", ROW_ID + [("is_test", "i")], f"SELECT *, {SPLIT_SQL_EXPR} AS is_test FROM sf")
def q_split(spark, sf_dir):
    return _split(_sf(spark, sf_dir))


SCALE_COLS = ["quantity", "sales", "profit"]


def _scale_q(method):
    def q(spark, sf_dir):
        d = _split(_sf(spark, sf_dir))
        params = scale.fit_scaler(d.where(F.col("is_test") == 0), SCALE_COLS, method)
        return scale.apply_scaler(d, params)
    return q


def _scale_sql(method):
    t = f"(SELECT * FROM sf WHERE {SPLIT_SQL_EXPR} = 0)"
    if method == "standard":
        stats = ", ".join(f"avg({c}) AS a_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS b_{c}" for c in SCALE_COLS)
    elif method == "minmax":
        stats = ", ".join(f"min({c}) AS a_{c}, CASE WHEN max({c}) = min({c}) THEN 1 ELSE max({c}) - min({c}) END AS b_{c}"
                          for c in SCALE_COLS)
    else:
        stats = ", ".join(f"quantile_cont({c}, 0.5) AS a_{c}, CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1 "
                          f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS b_{c}" for c in SCALE_COLS)
    cols = ", ".join(f"({c} - st.a_{c}) / st.b_{c} AS {c}" for c in SCALE_COLS)
    return f"SELECT l_orderkey, l_linenumber, product_id, l_suppkey, {SPLIT_SQL_EXPR} AS is_test, {cols} FROM sf, (SELECT {stats} FROM {t}) st"


for _m in ("standard", "minmax", "robust"):
    reg(f"scale_{_m}", ROW_ID + [("is_test", "i")] + [(c, "d6") for c in SCALE_COLS], _scale_sql(_m))(_scale_q(_m))


@reg("fold_sizes", [("fold", "i"), ("rows", "i")],
     "SELECT fold, count(*) AS rows FROM (SELECT CASE WHEN p < (SELECT (count(*) % 5) * (count(*) // 5 + 1) FROM sf) "
     "THEN p // ((SELECT count(*) FROM sf) // 5 + 1) ELSE (SELECT count(*) % 5 FROM sf) + (p - (SELECT (count(*) % 5) * "
     "(count(*) // 5 + 1) FROM sf)) // ((SELECT count(*) FROM sf) // 5) END AS fold FROM (SELECT row_number() OVER (ORDER BY "
     + ORDER_SQL + ") - 1 AS p FROM sf)) GROUP BY fold")
def q_fold_sizes(spark, sf_dir):
    d = _sf(spark, sf_dir)
    indexed = ordered_positions(d, ORDER_COLS, out="_pos")
    n = d.count()
    return split.with_contiguous_folds(indexed, "_pos", n, 5).groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


@reg("csv_roundtrip", [("order_date", "date"), ("region", "s"), ("product_id", "i"), ("quantity", "d6"), ("profit", "d6"),
                       ("l_orderkey", "i"), ("l_linenumber", "i")],
     "SELECT * FROM sf")
def q_csv_roundtrip(spark, sf_dir):
    """SRC1/SRC2: the fact rows written as a latin-1 header CSV to the shared folder, read back
    with an explicit schema, and the date text parsed with NULL on failure."""
    from ledgerlens.modeling.boosting import shared_path
    from ledgerlens.sources.csv import read_sales_csv

    path = shared_path(spark, "csv")
    src = _sf(spark, sf_dir).select(F.date_format("order_date", "yyyy-MM-dd").alias("Order Date"), "region", "product_id",
                                    "quantity", "profit", "l_orderkey", "l_linenumber")
    src.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    schema = "`Order Date` string, region string, product_id bigint, quantity double, profit double, l_orderkey bigint, l_linenumber int"
    back = read_sales_csv(spark, path, schema=schema, date_col="Order Date", date_format="yyyy-MM-dd")
    return back.withColumnRenamed("Order Date", "order_date")


@reg("binary_encode", ROW_ID + [("line_status_binary", "i")],
     "SELECT *, dense_rank() OVER (ORDER BY coalesce(line_status, 'nan')) - 1 AS line_status_binary FROM sf")
def q_binary(spark, sf_dir):
    """ENC1 via the dispatcher: a 2-valued column gets a ``_binary`` code."""
    d = _sf(spark, sf_dir).select(*RID, "line_status")
    out, plan = encode.encode_categoricals(d.select(*RID, "line_status"))
    return out


@reg("margin_guarded", ROW_ID + [("profit_margin", "d6")],
     "SELECT *, CASE WHEN sales_zero = 0 THEN 0.0 ELSE profit / sales_zero * 100 END AS profit_margin FROM d")
def q_margin_guarded(spark, sf_dir):
    """MTH9 + MTH14: margin over the zero-sales variant (±Infinity) with infinities replaced by 0."""
    from ledgerlens.functions import mathx

    d = _dirty(spark, sf_dir).select(*RID, "profit", "sales_zero")
    return d.select(*RID, mathx.inf_to(mathx.profit_margin("profit", "sales_zero"), 0.0).alias("profit_margin"))


MARGIN_SQL = "CASE WHEN sales_zero = 0 THEN 0.0 ELSE profit / sales_zero * 100 END"


@reg("validate_features", ROW_ID + [("q_missing", "d6"), ("p_missing", "d6"), ("cat_missing", "s"), ("margin_zero", "d6")],
     f"SELECT * EXCLUDE (q_missing, p_missing, cat_missing), coalesce(q_missing, 0) AS q_missing, coalesce(p_missing, 0) AS p_missing, "
     f"coalesce(cat_missing, 'Unknown') AS cat_missing, {MARGIN_SQL} AS margin_zero FROM d")
def q_validate_features(spark, sf_dir):
    """SEL5 on the dirty frame: columns over 50 % missing dropped, numeric gaps → 0, text gaps →
    'Unknown', zero-variance columns dropped, ±Infinity → 0 (margin over the zero-sales variant)."""
    from ledgerlens.functions import mathx

    d = _dirty(spark, sf_dir).select(*RID, "q_missing", "p_missing", "sparse60", "sparse95", "cat_missing",
                                     mathx.profit_margin("profit", "sales_zero").alias("margin_zero"),
                                     (F.col("quantity") * 0).alias("q_const"))
    out, _ = select.clean_and_validate(d)
    return out


@reg("final_features", ROW_ID + [("q_missing", "d6"), ("cat_missing", "s"), ("margin_zero", "d6")],
     f"SELECT * EXCLUDE (q_missing), coalesce(q_missing, 0) AS q_missing, {MARGIN_SQL} AS margin_zero FROM d")
def q_final_features(spark, sf_dir):
    """SEL6 with SEL4 and FIL7: infinite and missing numbers → 0, then the text column without any value and
    the columns of one value go."""
    from ledgerlens.functions import mathx

    d = _dirty(spark, sf_dir).select(*RID, "q_missing", "cat_missing", mathx.profit_margin("profit", "sales_zero").alias("margin_zero"),
                                     (F.col("quantity") * 0).alias("q_const"), F.lit(None).cast("double").alias("no_number"),
                                     F.lit(None).cast("string").alias("no_text"))
    return select.final_validation(d)[0]


@reg("drop_empty_rows", [("q_missing", "d6"), ("p_missing", "d6"), ("cat_missing", "s")],
     "SELECT * FROM d WHERE q_missing IS NOT NULL OR p_missing IS NOT NULL OR cat_missing IS NOT NULL")
def q_drop_empty_rows(spark, sf_dir):
    """FIL2: rows with a value in no column go."""
    return clean.drop_empty_rows(_dirty(spark, sf_dir).select("q_missing", "p_missing", "cat_missing"))


@reg("renamed", ROW_ID + [("region", "s"), ("product", "s"), ("quantity", "d6"), ("profit", "d6")],
     "SELECT * EXCLUDE (product), product_name AS product FROM (SELECT *, '' AS product FROM sf)")
def q_renamed(spark, sf_dir):
    """PRJ4: the published headers become the standard names; other columns stay."""
    d = _sf(spark, sf_dir).select(*RID, F.col("region").alias("Region"), F.col("product_name").alias("Product Name"),
                                  F.col("quantity").alias("Quantity"), F.col("profit").alias("Profit"))
    return rename_standard(d)
