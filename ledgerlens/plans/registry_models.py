"""Registered model, validation, importance and composite-pipeline queries (tree training has no SQL
equivalent: unit tests compare it with brute force)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.modeling import curves, ensemble, importance, models, tuning, validation
from ledgerlens.modeling.boosting import Spec, bin_table, fit_many, shared_path, staged_scores
from ledgerlens.modeling.mutual_information import mutual_information
from ledgerlens.operators import onehot, profile, split
from ledgerlens.operators.sequence import ordered_positions
from ledgerlens.plans import features as feat
from ledgerlens.plans import pipeline, training
from ledgerlens.plans.registry import ROW_ID, _sales, _sf, _sf_stored, register
from ledgerlens.plans.registry_prep import _split
from ledgerlens.sources.tables import ORDER_COLS

RID = [c for c, _ in ROW_ID]
MODEL_FEATURES = ["month", "day_of_week", "quarter", "year", "sales", "l_extendedprice", "l_linenumber"]
TABLE_SPEC = [("model", "s"), ("mse", "d6"), ("rmse", "d6"), ("r2", "d6")]


FOLDS = 5


def _rows(spark, sf_dir):
    """The sales rows with their calendar fields, split into train and test, and the numeric features."""
    d = _split(_sf(spark, sf_dir))
    names = [c for c in profile.numeric_columns(d) if c not in ("quantity", "profit", "is_test", "l_orderkey")]
    return d, names


def _fold_table(spark, sf_dir, target="quantity"):
    """Training rows in contiguous folds of the row order, coded once."""
    d, names = _rows(spark, sf_dir)
    d = ordered_positions(d.where(F.col("is_test") == 0), ORDER_COLS, out="_pos")
    d = d.checkpoint(eager=True)
    d = split.with_contiguous_folds(d, "_pos", d.count(), FOLDS, "fold")
    return bin_table(d, names, [target], "fold", "_pos")


MEMBERS = [("rf", "random_forest"), ("xgb", "xgboost"), ("lgbm", "lightgbm")]


def _fit_table(spark, sf_dir, families, targets):
    """Test metrics of the families for the targets: all models of one fit, test rows are a fold."""
    d, names = _rows(spark, sf_dir)
    table = bin_table(d, names, targets, "is_test")
    named = [(t, name, Spec(fam, {}, t, 1)) for t in targets for fam, name in MEMBERS if fam in families]
    specs = [x for _, _, x in named]
    scores = staged_scores(table, specs, fit_many(table, specs)).where("part = 'test'")
    what = spark.createDataFrame([(i, t, m) for i, (t, m, _) in enumerate(named)], "model int, target string, name string")
    return scores.join(what, "model").select("target", F.col("name").alias("model"), (F.col("rmse") * F.col("rmse")).alias("mse"), "rmse", "r2")


@register("rf_fit", TABLE_SPEC, None)
def q_rf(spark, sf_dir):
    return _fit_table(spark, sf_dir, ("rf",), ["quantity"]).drop("target")


@register("gbt_fit", TABLE_SPEC, None)
def q_gbt(spark, sf_dir):
    return _fit_table(spark, sf_dir, ("xgb",), ["quantity"]).drop("target")


@register("boost_fit", [("target", "s"), *TABLE_SPEC], None)
def q_boost(spark, sf_dir):
    """MDL3/MDL4: both booster configurations (with their penalties and numbers of leaves) for both targets."""
    return _fit_table(spark, sf_dir, ("xgb", "lgbm"), ["quantity", "profit"])


CV_SPEC = [("metric", "s"), ("mean", "d6"), ("std", "d6"), ("ci_low", "d6"), ("ci_high", "d6")]


@register("cv", CV_SPEC, None)
def q_cv(spark, sf_dir):
    return curves.cross_validation(_fold_table(spark, sf_dir), "quantity", "rf")


CURVE = [("train_mean", "d6"), ("train_std", "d6"), ("validation_mean", "d6"), ("validation_std", "d6")]


@register("learning_curve", [("train_size", "i"), *CURVE, ("final_gap", "d6"), ("is_overfitting", "i")], None)
def q_learning_curve(spark, sf_dir):
    """VAL2: ten sizes, five folds, one fit."""
    return curves.learning_curve(_fold_table(spark, sf_dir, "profit"), "profit", "lgbm").withColumn("is_overfitting", F.col("is_overfitting").cast("int"))


@register("validation_curve", [("param", "s"), ("value", "d6"), *CURVE, ("is_best", "i")], None)
def q_validation_curve(spark, sf_dir):
    """VAL3: the curve over the rounds from one fit per fold."""
    curve = curves.validation_curve(_fold_table(spark, sf_dir, "profit"), "profit", "n_estimators", [10, 25, 50, 75, 100], "xgb")
    return curve.withColumn("is_best", F.col("is_best").cast("int"))


TRIAL_SPEC = [("method", "s"), ("trial", "i"), ("params", "s"), ("status", "s"), ("folds", "i"), ("mean_score", "d6"), ("std_score", "d6"), ("is_best", "i")]
#: a small grid of ``tune_grid``: the published ones are hundreds of fits (``tuning.GRID_SPACE`` is the default of the library)
SMALL_GRID = {"n_estimators": [20, 40], "learning_rate": [0.05, 0.1, 0.3], "max_depth": [3, 6]}


def _trials(search, spark):
    return search.table(spark).drop("seconds").withColumn("is_best", F.col("is_best").cast("int"))


@register("tune_grid", TRIAL_SPEC, None)
def q_tune_grid(spark, sf_dir):
    """TUN1: the whole grid in five folds, the best refitted."""
    return _trials(tuning.grid_search(tuning.BoosterTrials(_fold_table(spark, sf_dir, "profit"), "profit", "xgb"), SMALL_GRID), spark)


@register("tune_random", TRIAL_SPEC, None)
def q_tune_random(spark, sf_dir):
    """TUN2: 50 seeded draws from the published lists."""
    return _trials(tuning.random_search(tuning.BoosterTrials(_fold_table(spark, sf_dir, "profit"), "profit", "lgbm")), spark)


@register("tune_model", TRIAL_SPEC, None)
def q_tune_model(spark, sf_dir):
    """TUN3: 100 Parzen proposals in the published ranges; no time limit, so that reruns agree."""
    work = tuning.BoosterTrials(_fold_table(spark, sf_dir, "profit"), "profit", "lgbm")
    return _trials(tuning.model_search(work, timeout_s=None), spark)


@register("tune_compare", [("method", "s"), ("trials", "i"), ("mean_score", "d6"), ("std_score", "d6"), ("best_params", "s"), ("is_best", "i")], None)
def q_tune_compare(spark, sf_dir):
    """TUN4: the three methods, each in its published space, on the same folds."""
    work = tuning.BoosterTrials(_fold_table(spark, sf_dir, "profit"), "profit", "xgb")
    winner, searches = tuning.compare_methods(work, model={"timeout_s": None})
    return tuning.comparison_table(spark, winner, searches).withColumn("is_best", F.col("is_best").cast("int"))


@register("importance_report", [("feature", "s"), ("rf_importance", "d6"), ("mi_importance", "d6"), ("combined_score", "d6")], None)
def q_importance(spark, sf_dir):
    """IMPT3-IMPT5: forest importance and nearest-neighbour mutual information of all numeric columns, joined on the feature."""
    d, names = _rows(spark, sf_dir)
    d = d.select(*dict.fromkeys([*names, "quantity", *RID])).checkpoint(eager=True)
    model = fit_many(bin_table(d, names, ["quantity"]), [Spec("rf", {}, "quantity")])[0]
    rf = spark.createDataFrame(list(model.importances().items()), "feature string, rf_importance double")
    mi = mutual_information(d, names, "quantity", key=RID)
    rep = rf.join(mi, "feature")
    return rep.withColumn("combined_score", (F.col("rf_importance") + F.col("mi_importance")) / 2).orderBy(F.desc("combined_score"))


def _mi_sql(features, target, bins=10):
    probs = "[" + ", ".join(repr(i / bins) for i in range(1, bins)) + "]"
    stacked = " UNION ALL ".join(f"SELECT '{c}' AS col, coalesce(CAST({c} AS DOUBLE), 0.0) AS v, "
                                 f"coalesce(CAST({target} AS DOUBLE), 0.0) AS yv FROM sf" for c in features)
    return (f"WITH st AS ({stacked}), cuts AS (SELECT col, quantile_cont(v, {probs}) AS c FROM st GROUP BY col), "
            f"tc AS (SELECT quantile_cont(coalesce(CAST({target} AS DOUBLE), 0.0), {probs}) AS c FROM sf), "
            f"b AS (SELECT st.col, len(list_filter(cuts.c, lambda x: x < st.v)) AS bx, len(list_filter(tc.c, lambda x: x < st.yv)) AS byy "
            f"FROM st JOIN cuts ON st.col = cuts.col, tc), "
            f"j AS (SELECT col, bx, byy, count(*) AS nxy FROM b GROUP BY col, bx, byy), "
            f"m AS (SELECT *, sum(nxy) OVER (PARTITION BY col, bx) AS nx, sum(nxy) OVER (PARTITION BY col, byy) AS ny, "
            f"sum(nxy) OVER (PARTITION BY col) AS n FROM j) "
            f"SELECT col AS feature, sum(nxy / n * ln(nxy * n / (nx * ny))) AS mi_importance FROM m GROUP BY col")


@register("mi_binned", [("feature", "s"), ("mi_importance", "d6")], _mi_sql(MODEL_FEATURES, "quantity"))
def q_mi(spark, sf_dir):
    """IMPT4 (binned estimator), oracle-checked."""
    return validation.binned_mutual_information(_sf_stored(spark, sf_dir, *MODEL_FEATURES, "quantity"), MODEL_FEATURES, "quantity", stored=True)


@register("mi_neighbours", [("feature", "s"), ("mi_importance", "d6")], None)
def q_mi_neighbours(spark, sf_dir):
    """IMPT4 (nearest neighbours), all numeric columns; no SQL, as it would compare all pairs of rows."""
    d, names = _rows(spark, sf_dir)
    return mutual_information(d, names, "quantity", key=RID)


@register("perm_importance", [("feature", "s"), ("importance_mean", "d6"), ("importance_std", "d6")], None)
def q_perm(spark, sf_dir):
    """IMPT2: ten permutations of every numeric feature of a forest."""
    d, names = _rows(spark, sf_dir)
    d = d.select(*names, "quantity").checkpoint(eager=True)
    model = fit_many(bin_table(d, names, ["quantity"]), [Spec("rf", {}, "quantity")])[0]
    scores = importance.permutation_scores(d, {"random_forest": model}, {"random_forest": 1.0}, "quantity", repeats=10)
    return spark.createDataFrame(scores, "feature string, importance_mean double, importance_std double")


ONEHOT = ["region", "category", "sub_category", "line_status"]
_ONEHOT_SQL = " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, product_id, l_suppkey, {i} AS number, '{c}' AS col, {c} AS v FROM sf" for i, c in enumerate(ONEHOT))
_SLOT_SQL = (f"WITH long AS ({_ONEHOT_SQL}), voc AS (SELECT number, v, row_number() OVER (PARTITION BY number ORDER BY v) - 1 AS code FROM "
             "(SELECT DISTINCT number, v FROM long WHERE v IS NOT NULL) x), "
             "kept AS (SELECT number, v, row_number() OVER (ORDER BY number, v) - 1 AS slot FROM voc WHERE code >= {first})")


@register("onehot_entries", [*ROW_ID, ("column", "s"), ("slot", "i")],
          _SLOT_SQL.format(first=1) + " SELECT l_orderkey, l_linenumber, product_id, l_suppkey, col AS \"column\", slot FROM long JOIN kept USING (number, v)")
def q_onehot_entries(spark, sf_dir):
    """ENC7: sparse one-hot entries, the first value of every column dropped."""
    d = _sf(spark, sf_dir)
    return onehot.onehot_entries(d, onehot.fit_onehot(d, ONEHOT, drop_first=True), ONEHOT, [c for c, _ in ROW_ID])


@register("onehot_scaled", [*ROW_ID, ("slot", "i"), ("scaled", "d6")],
          _SLOT_SQL.format(first=0).replace("FROM sf", "FROM sf WHERE l_orderkey % 5 <> 0") + ", n AS (SELECT count(*)::DOUBLE AS n FROM sf WHERE l_orderkey % 5 <> 0), "
          "s AS (SELECT slot, count(*) / any_value(n.n) AS p FROM long JOIN kept USING (number, v), n GROUP BY slot), "
          f"every AS ({_ONEHOT_SQL.replace('FROM sf', 'FROM sf WHERE l_orderkey % 5 = 0')}) "
          "SELECT l_orderkey, l_linenumber, product_id, l_suppkey, slot, 1.0 / CASE WHEN p < 1 THEN sqrt(p * (1 - p)) ELSE 1.0 END AS scaled "
          "FROM every JOIN kept USING (number, v) JOIN s USING (slot)")
def q_onehot_scaled(spark, sf_dir):
    """ENC6, ENC8, SCL5: vocabulary and scales of four fifths of the orders, applied to the rest: unseen values
    have no entry, entries are scaled without centring."""
    d = _sf(spark, sf_dir).select(*[c for c, _ in ROW_ID], *ONEHOT)
    fitted, rest = d.where(F.col("l_orderkey") % 5 != 0), d.where(F.col("l_orderkey") % 5 == 0)
    vocabulary = onehot.fit_onehot(fitted, ONEHOT)
    keys = [c for c, _ in ROW_ID]
    scales = onehot.fit_slot_scales(onehot.onehot_entries(fitted, vocabulary, ONEHOT, keys), fitted.count())
    return onehot.onehot_entries(rest, vocabulary, ONEHOT, keys).join(scales, "slot").select(*keys, "slot", (1 / F.col("scale")).alias("scaled"))


CANONICAL_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register("normalize_values", [("l_orderkey", "i"), ("l_linenumber", "i"), ("product_id", "i"), ("l_suppkey", "i"),
                               ("category_std", "s")], None)
def q_normalize(spark, sf_dir):
    """PRJ5 on data: the distinct values of the dirty category column (padded text, 'nan')
    are matched to the canonical category vocabulary by token-sort ratio (threshold 80), and the
    mapping is joined back to every row ('nan' matches no term and stays NULL)."""
    from ledgerlens.functions.fuzzy import normalize_values
    from ledgerlens.plans.registry_prep import _dirty

    d = _dirty(spark, sf_dir).select("l_orderkey", "l_linenumber", "product_id", "l_suppkey", "cat_dirty")
    return normalize_values(d, "cat_dirty", "category_std", CANONICAL_CATEGORIES, threshold=80.0)


@register("feature_table", None, None)
def q_feature_table(spark, sf_dir):
    """PIP1 + PIP2: the whole feature table."""
    base = feat.essential(_sales(spark, sf_dir), extra=["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice",
                                                        "sales", "customer_id"])
    return feat.business_indicators(feat.build_features(base))


@register("preprocess", None, None)
def q_preprocess(spark, sf_dir):
    """PIP3 on the row features of the sales view for target quantity."""
    base = feat.essential(_sales(spark, sf_dir), extra=["l_orderkey", "l_linenumber", "sales"])
    base = feat.interaction_features(feat.temporal_features(base))
    out, _ = pipeline.preprocess(base, "quantity", keep=("l_orderkey", "l_linenumber"))
    return out


@register("train_run", [("target", "s"), ("section", "s"), ("split", "s"), ("name", "s"), ("value", "d6")], None)
def q_train_run(spark, sf_dir):
    """PIP4, VAL4, RPT1 for both targets: row features, preprocessing, three members, evaluation with
    cross-validation, learning curve and importances; saved, loaded again and reported."""
    base = feat.essential(_sales(spark, sf_dir), extra=["l_orderkey", "l_linenumber", "sales"])
    base = feat.interaction_features(feat.temporal_features(base))
    config = training.RunConfig(feature_engineering=False, learning_sizes=(0.1, 1.0), importance_repeats=3, strings=("region", "category"))
    runs = training.run(base.checkpoint(eager=True), feat.TARGETS, config)
    path = shared_path(spark, "run")
    training.save_run(runs, path)
    loaded = [(t, "saved", "all", name, float(len(m.trees))) for t in runs for name, m in training.load_run(path, t)[0].items()]
    rows = spark.createDataFrame(loaded, "target string, section string, split string, name string, value double")
    return training.run_report(runs).drop("timestamp").where("name <> 'seconds'").unionByName(rows)


@register("batch_score", [("date", "date"), ("region", "s"), ("product", "s"), ("quantity_pred", "d4"), ("profit_pred", "d4")], None)
def q_batch_score(spark, sf_dir):
    """MDL12 + SNK4: the compact pipeline for both targets, fitted on the train split and used
    to score every (date, region, product) row of the test split."""
    d = _split(_sf(spark, sf_dir)).select(F.col("order_date").alias("date"), "region", F.col("product_name").alias("product"),
                                           "quantity", "profit", "is_test")
    fitted = models.train_compact(d.where(F.col("is_test") == 0))
    return models.score(fitted, d.where(F.col("is_test") == 1).select("date", "region", "product"))


@register("shapiro", [("region", "s"), ("category", "s"), ("year", "i"), ("n", "i"), ("statistic", "d6"), ("p_value", "d6"),
                      ("is_normal", "i")], None)
def q_shapiro(spark, sf_dir):
    """MET15 per segment (region, category, year) of the least-squares line's residuals."""
    from ledgerlens.modeling.normality import shapiro_by_group
    from ledgerlens.plans.registry_eval import line_fit

    d = _sf_stored(spark, sf_dir, "region", "category", "year", "sales", "quantity")
    a, b = line_fit(d)
    p = d.withColumn("pred", F.lit(a) + F.lit(b) * F.col("quantity"))
    return shapiro_by_group(p, "sales", "pred", ["region", "category", "year"])


@register("voting_classifier", [("model", "s"), ("accuracy", "d6")], None)
def q_voting_classifier(spark, sf_dir):
    """MDL2/MDL3/MDL8 + MET21: classifiers of the line status, soft and hard weighted votes."""
    from ledgerlens.modeling import metrics as mt
    from pyspark.ml.feature import StringIndexer

    d = _split(_sf(spark, sf_dir))
    d = StringIndexer(inputCol="line_status", outputCol="label", stringOrderType="alphabetAsc").fit(d).transform(d)
    d = models.assemble(d, MODEL_FEATURES)
    train, test = d.where(F.col("is_test") == 0), d.where(F.col("is_test") == 1)
    members = {}
    for fam, name in (("rf", "random_forest"), ("xgb", "xgboost")):
        m = models.make_model(fam, "classification", None, "features", "label", f"p_{name}")
        m.setProbabilityCol(f"prob_{name}").setRawPredictionCol(f"raw_{name}")
        members[name] = m.fit(train)
    scored = models.predict_members(members, test)
    w = ensemble.diversity_weights(list(members))
    scored = scored.withColumn("p_soft", ensemble.soft_vote({m: f"prob_{m}" for m in members}, w)) \
                   .withColumn("p_hard", ensemble.hard_vote({m: f"p_{m}" for m in members}, w))
    st = scored.select("label", F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("pred")) for n, c in
                                                    (("random_forest", "p_random_forest"), ("xgboost", "p_xgboost"),
                                                     ("soft_vote", "p_soft"), ("hard_vote", "p_hard"))])).alias("s"))
    return mt.accuracy(st.select("label", "s.*"), "label", "pred", ["model"])


@register("metrics_csv", TABLE_SPEC, None)
def q_metrics_csv(spark, sf_dir):
    """SNK1: the model table written as header CSV to the shared folder and read back."""
    from ledgerlens.plans.registry_eval import line_fit

    d = _split(_sf(spark, sf_dir))
    a, b = line_fit(d.where(F.col("is_test") == 0))
    test = d.where(F.col("is_test") == 1).withColumn("p_line", F.lit(a) + F.lit(b) * F.col("quantity"))
    table = ensemble.model_table(test, "sales", {"line": "p_line"})
    path = shared_path(spark, "metrics")
    ensemble.save_evaluation_results(table, path)
    return spark.read.option("header", True).schema("model string, mse double, rmse double, r2 double").csv(path)
