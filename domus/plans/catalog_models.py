"""Registered queries: model fits, explanations and the modelling pipeline
(M1, M2, M4–M6, M10, M11, C8, X1–X6, D6, G5, Q6).  Model outputs are not
bit-reproducible across engines, so these are rows-only checks; the unit
tests check their invariants (attributions sum to the prediction, OLS equals
a direct least-squares solve, folds partition the rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from domus.operators import evaluation as V
from domus.operators import explain as X
from domus.operators import models as M
from domus.operators.aggregates import CITY_MONTH_KEY
from domus.operators.splits import train_test_label
from domus.operators.windows import select_by_cumulative_share
from domus.plans import composite as C
from domus.plans.catalog_eval import SPLIT_SQL
from domus.plans.catalog_prep import BASE_CTE, MIN_COUNT, PCT_BELOW, PREP_VIEWS, base
from domus.plans.registry import oracle, register, rounded
from domus.session import written

REG_FEATURES = ["living_area", "num_rooms", "latitude", "longitude", "off_plan"]
CLS_FEATURES = ["living_area", "num_rooms", "latitude", "longitude", "off_plan", "price"]

#: rounds of the boosted models fitted here (the operator's own default is
#: ``models.BOOSTING_ROUNDS``); README gives the measured time of a round
ROUNDS = 100
CV_ROUNDS = 20  # of each model of a cross-validation or experiment
#: depth of the forests fitted here (the operator's default is
#: ``models.FOREST_DEPTH``); README gives the measured time of deeper ones
TREE_DEPTH = 10

_MODELS: dict = {}


def _split(df, id_col="transaction_id"):
    return train_test_label(df, id_col, 0.2, 42)


def _fitted(spark, d, name, fit):
    """One fit per session and folder, shared by the queries that explain or apply it."""
    key = (spark.sparkContext.applicationId, d, name)
    for other in [k for k in _MODELS if k[0] != key[0]]:
        del _MODELS[other]  # of a session that is gone
    if key not in _MODELS:
        _MODELS[key] = fit()
    return _MODELS[key]


def _base(spark, d):
    """The base rows, joined once a session and folder and written with the
    columns that models and labels need."""
    cols = ["transaction_id", "transaction_date", *CITY_MONTH_KEY, "building_type", "price", "price_per_m2", *REG_FEATURES]
    return _fitted(spark, d, "base rows", lambda: written(base(spark, d).select(*cols)))


def _labelled(spark, d):
    """The labelled rows from the written base, written likewise: fits, splits
    and quantiles read them several times."""
    cols = ["transaction_id", "transaction_date", "department", *CLS_FEATURES, "below_market"]
    return _fitted(spark, d, "labelled rows", lambda: written(C.labelled_base(_base(spark, d), MIN_COUNT, PCT_BELOW).select(*cols)))


def _forest(spark, d):
    return _fitted(spark, d, "forest", lambda: M.forest(_split(_base(spark, d)).where(F.col("split") == "train"), "price", REG_FEATURES, "regression",
                                                     max_depth=TREE_DEPTH))


def _gbt(spark, d):
    return _fitted(spark, d, "gbt", lambda: M.boosting(
        _split(_labelled(spark, d)).where(F.col("split") == "train"), "below_market", CLS_FEATURES, "classification", iters=ROUNDS))


def _packed(spark, d):
    from domus.operators.packed_trees import pack

    return _fitted(spark, d, "packed", lambda: pack({"model": _forest(spark, d)}))


# ------------------------------------------------------------------ M
@register("m1_ols")
def m1_ols(spark, d):
    return M.ols(base(spark, d), "price", ["living_area", "num_rooms", "off_plan", "transaction_month"])


@register("m1_ols_two_features", oracle(
    """WITH s AS (SELECT sum(living_area * living_area) AS s11, sum(living_area * num_rooms) AS s12,
                         sum(num_rooms * num_rooms) AS s22, sum(living_area * price) AS r1,
                         sum(num_rooms * price) AS r2, sum(price * price) AS yy, count(*) AS n
                  FROM base WHERE price IS NOT NULL AND living_area IS NOT NULL AND num_rooms IS NOT NULL),
            b AS (SELECT *, (r1 * s22 - r2 * s12) / (s11 * s22 - s12 * s12) AS b1,
                            (s11 * r2 - s12 * r1) / (s11 * s22 - s12 * s12) AS b2 FROM s),
            f AS (SELECT *, 1.0E0 - (yy - 2 * (b1 * r1 + b2 * r2)
                                     + (b1 * b1 * s11 + 2 * b1 * b2 * s12 + b2 * b2 * s22)) / yy AS r2_fit FROM b)
       SELECT 'living_area' AS feature, b1 AS coef, r2_fit AS r2, n FROM f
       UNION ALL SELECT 'num_rooms', b2, r2_fit, n FROM f""", ["tx", BASE_CTE], ["coef", "r2"], 4))
def m1_ols_two_features(spark, d):
    """Through-the-origin OLS on two features; coefficients and uncentred R²
    (the t / p columns of ``ols`` need Student's t, checked in unit tests)."""
    out = M.ols(base(spark, d), "price", ["living_area", "num_rooms"]).select("feature", "coef", "r2", "n")
    return rounded(out, 4)


@register("m2_backward_eliminate")
def m2_backward_eliminate(spark, d):
    return M.backward_eliminate(base(spark, d), "price",
                                ["living_area", "num_rooms", "off_plan", "transaction_month", "latitude"])


@register("m4_logistic")
def m4_logistic(spark, d):
    model = M.logistic(_labelled(spark, d), "below_market", ["living_area", "num_rooms", "latitude", "longitude"])
    coefs = list(model.coefficients.toArray())
    names = ["living_area", "num_rooms", "latitude", "longitude"]
    return spark.createDataFrame([(n, float(c)) for n, c in zip(names, coefs)] + [("intercept", float(model.intercept))],
                                 "feature string, coef double")


@register("m5_forest")
def m5_forest(spark, d):
    model = _forest(spark, d)
    test = _split(_base(spark, d)).where(F.col("split") == "test")
    scored = M.score_rows(model, test, REG_FEATURES)
    return V.regression_metrics(scored, "price", "prediction")


@register("m6_boosting")
def m6_boosting(spark, d):
    model = _gbt(spark, d)
    test = _split(_labelled(spark, d)).where(F.col("split") == "test")
    scored = M.score_rows(model, test, CLS_FEATURES)
    return V.binary_metrics(scored.withColumn("prediction", F.col("prediction").cast("int")), "below_market",
                            "prediction")


@register("m10_score_batch")
def m10_score_batch(spark, d):
    rows = _labelled(spark, d).select("transaction_id", *set(REG_FEATURES + CLS_FEATURES))
    out = M.score_batch(rows, REG_FEATURES, _forest(spark, d), CLS_FEATURES, _gbt(spark, d), packed=_packed(spark, d))
    return out.select("transaction_id", "predicted_price", "predicted_class", "probability_below_market")


@register("m11_class_probability")
def m11_class_probability(spark, d):
    test = _split(_labelled(spark, d)).where(F.col("split") == "test")
    scored = M.score_rows(_gbt(spark, d), test, CLS_FEATURES)
    return M.class_probability(scored, "probability_below_market").select("transaction_id",
                                                                          "probability_below_market")


@register("m9_fit_by_segment_trees")
def m9_fit_by_segment_trees(spark, d):
    """One forest per building type (fits submitted concurrently), each row
    scored by its segment's model in one pass, metrics per segment."""
    data = _split(_base(spark, d))
    train = data.where(F.col("split") == "train")
    types = [r[0] for r in train.select("building_type").distinct().orderBy("building_type").collect()]  # one row per type
    models = M.fit_by_segment(train, "building_type", types,
                              lambda part: M.forest(part, "price", REG_FEATURES, "regression", max_depth=TREE_DEPTH))
    scored = M.score_by_segment(data.where(F.col("split") == "test"), "building_type", models, REG_FEATURES)
    return V.regression_metrics(scored, "price", "prediction", by=["building_type"])


def _decision_data(spark, d):
    from domus.operators.frames import filter_above_quantile

    # Department 4, price at or above the 0.1-quantile of all prices
    return filter_above_quantile(_labelled(spark, d), "price", 0.1, where=F.col("department") == 4,
                                 inclusive=True).select("living_area", "price", "below_market")


@register("m4_decision_regions_logistic")
def m4_decision_regions_logistic(spark, d):
    data = _decision_data(spark, d)
    model = M.logistic(data, "below_market", ["living_area", "price"])
    return M.decision_grid(model, data, "living_area", "price", 50)


@register("m5_decision_regions_forest")
def m5_decision_regions_forest(spark, d):
    data = _decision_data(spark, d)
    model = M.forest(data, "below_market", ["living_area", "price"], "classification", max_depth=TREE_DEPTH)
    return M.decision_grid(model, data, "living_area", "price", 50)


# ------------------------------------------------------------------ C8
@register("c8_cross_validate")
def c8_cross_validate(spark, d):
    from domus.operators.splits import stratified_kfold_label

    lab = _labelled(spark, d).select("transaction_id", "transaction_date", "below_market", *CLS_FEATURES)
    folds = stratified_kfold_label(lab, "below_market", ["transaction_date", "transaction_id"], 5)

    def fit(train):
        return M.boosting(train, "below_market", CLS_FEATURES, "classification", iters=CV_ROUNDS)

    per, _, _ = M.cross_validate(folds, "below_market", CLS_FEATURES, "fold", 5, fit)
    return per


@register("c8_cross_validate_by_region")
def c8_cross_validate_by_region(spark, d):
    """Leave-one-region-out cross-validation of the boosted classifier on
    the engineered features (precision, recall, ROC AUC per fold)."""
    from domus.operators.encoding import reverse_one_hot
    from domus.operators.splits import group_label
    from domus.plans.catalog_features import BUILDING_TYPES, REGION_NAMES, annual, monthly, prepared

    tx, kept = prepared(spark, d)
    feats, _ = C.engineer_features(tx, C.city_features(kept), annual(spark, d), monthly(spark, d),
                                   BUILDING_TYPES, REGION_NAMES)
    xs = ["living_area", "num_rooms", "latitude", "longitude", "off_plan", "city_requested",
          "avg_price_per_m2_previous_month", "interest_rate", "debt_ratio"]
    data = reverse_one_hot(feats, "region_name", out="region", strict=False).where(F.col("region").isNotNull())
    folds = group_label(data.select("region", "below_market", *xs), "region")
    k = folds.select("fold").distinct().count()  # number of regions present (small)

    def fit(train):
        return M.boosting(train, "below_market", xs, "classification", iters=CV_ROUNDS)

    per, _, _ = M.cross_validate(folds, "below_market", xs, "fold", k, fit, metrics=["precision", "recall", "roc_auc"])
    return per


# ------------------------------------------------------------------ X
@register("x1_tree_importances")
def x1_tree_importances(spark, d):
    return X.tree_importances(_forest(spark, d), REG_FEATURES)


@register("x2_select_by_importance")
def x2_select_by_importance(spark, d):
    return select_by_cumulative_share(X.tree_importances(_forest(spark, d), REG_FEATURES), "feature",
                                      "importance", 0.8)


@register("x3_compare_models")
def x3_compare_models(spark, d):
    from domus.operators.models import forest
    from domus.operators.packed_trees import pack

    data = _split(_base(spark, d))
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    light_feats = [r["feature"] for r in select_by_cumulative_share(
        X.tree_importances(_forest(spark, d), REG_FEATURES), "feature", "importance", 0.8).collect()]
    light = forest(train, "price", light_feats, "regression", max_depth=TREE_DEPTH)
    parts = []
    for name, packed, feats in (("full", _packed(spark, d), REG_FEATURES), ("light", pack({"light": light}), light_feats)):
        for role, part in (("train", train), ("test", test)):
            s = M.packed_predictions(part.select("price", *feats), packed, feats).select("price", "prediction")
            parts.append(s.withColumn("model", F.lit(name)).withColumn("role", F.lit(role)))
    allp = parts[0]
    for p in parts[1:]:
        allp = allp.unionByName(p)
    return V.regression_metrics(allp, "price", "prediction", by=["model", "role"])


@register("x4_permutation_importance")
def x4_permutation_importance(spark, d):
    train = _split(_base(spark, d)).where(F.col("split") == "train")
    return X.permutation_importance(_forest(spark, d), train, REG_FEATURES, "price", "transaction_id",
                                    "r2", repeats=5, seed=42, packed=_packed(spark, d))


def _explained(spark, d):
    """All rows, train and test."""
    return _base(spark, d).select("transaction_id", *REG_FEATURES)


def _attributions(spark, d):
    return X.tree_attributions(_forest(spark, d), _explained(spark, d), REG_FEATURES, "transaction_id", packed=_packed(spark, d))


@register("x5_tree_attributions")
def x5_tree_attributions(spark, d):
    return _attributions(spark, d)


@register("x5_attribution_check", oracle("SELECT count(*) AS n, true AS agrees FROM base", ["tx", BASE_CTE]))
def x5_attribution_check(spark, d):
    """Base value and contributions of every row add up to the model's output
    (row by row: the fixture's ids may repeat)."""
    model = _forest(spark, d)
    scored = M.score_rows(model, _explained(spark, d), REG_FEATURES).select("transaction_id", *REG_FEATURES, "prediction")
    wide = X.path_contributions(model, scored, REG_FEATURES, _packed(spark, d))
    built = F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x)
    off = F.abs(built - F.col("prediction")) > 1e-9 * (1 + F.abs("prediction"))
    return wide.agg(F.count(F.lit(1)).alias("n"), (F.sum(F.when(F.coalesce(off, F.lit(True)), 1).otherwise(0)) == 0).alias("agrees"))


@register("x6_attribution_summary")
def x6_attribution_summary(spark, d):
    return X.attribution_summary(_attributions(spark, d))


@register("x6_attribution_breakdown")
def x6_attribution_breakdown(spark, d):
    """All contributions of one row (the smallest id), with its base
    value: the numbers behind a single-prediction waterfall."""
    return X.attribution_breakdown(_forest(spark, d), _explained(spark, d), REG_FEATURES, "transaction_id", packed=_packed(spark, d))


@register("x6_attribution_dependence")
def x6_attribution_dependence(spark, d):
    return X.attribution_dependence(_forest(spark, d), _explained(spark, d), REG_FEATURES, "living_area", "latitude", "transaction_id",
                                    packed=_packed(spark, d))


# ------------------------------------------------------------------ outputs that SQL can count
@register("m4_logistic_balance", oracle(
    "SELECT count(*) AS n, true AS balanced FROM labelled", PREP_VIEWS))
def m4_logistic_balance(spark, d):
    """At the optimum the unpenalised intercept makes the mean probability the
    share of positive labels."""
    xs = ["living_area", "num_rooms", "latitude", "longitude"]
    lab = _labelled(spark, d).select("below_market", *xs)
    scored = M.class_probability(M.score_rows(M.logistic(lab, "below_market", xs), lab, xs), "p")
    return scored.agg(F.count(F.lit(1)).alias("n"), (F.abs(F.avg("p") - F.avg("below_market")) < 1e-4).alias("balanced"))


@register("m10_score_batch_shape", oracle(
    """SELECT count(*) AS num_rows, count(DISTINCT transaction_id) AS ids, count(*) AS priced, count(*) AS probable, true AS consistent
       FROM labelled""", PREP_VIEWS))
def m10_score_batch_shape(spark, d):
    """Every row comes back once with both outputs; the class follows the probability."""
    out = m10_score_batch(spark, d)
    fits = (F.col("probability_below_market").between(0, 1)
            & (F.col("predicted_class") == F.when(F.col("probability_below_market") > 0.5, 1).otherwise(0)))
    return out.agg(F.count(F.lit(1)).alias("num_rows"), F.countDistinct("transaction_id").alias("ids"), F.count("predicted_price").alias("priced"),
                   F.count("probability_below_market").alias("probable"), F.min(fits).alias("consistent"))


@register("m11_class_probability_shape", oracle(
    f"SELECT count(*) AS num_rows, true AS within FROM labelled WHERE {SPLIT_SQL} = 'test'", PREP_VIEWS))
def m11_class_probability_shape(spark, d):
    p = m11_class_probability(spark, d)
    return p.agg(F.count("probability_below_market").alias("num_rows"), F.min(F.col("probability_below_market").between(0, 1)).alias("within"))


# ------------------------------------------------------------------ D6 / G5
OLD_FEATURES = CLS_FEATURES[:3]


def _periods(spark, d):
    from domus.operators.frames import assign_period

    return assign_period(_labelled(spark, d), "transaction_date", "1998-03", "1999-07")


@register("d6_score_by_period")
def d6_score_by_period(spark, d):
    """A model fitted on the first period, frozen and scored on each later one."""
    from domus.operators.drift import score_by_period

    lab = _periods(spark, d)
    model = _fitted(spark, d, "old", lambda: M.boosting(lab.where(F.col("period") == "pre"), "below_market", OLD_FEATURES, "classification", iters=ROUNDS))
    scored = M.score_rows(model, lab.where(F.col("period") != "pre"), OLD_FEATURES)
    return score_by_period(scored.withColumn("prediction", F.col("prediction").cast("int")), "period", "below_market", "prediction")


@register("g5_champion_challenger")
def g5_champion_challenger(spark, d):
    """The champion, fitted on the old period, is logged with its model and
    loaded from the log by run id to score the new period; the challenger has
    more features and is judged by cross-validation on the new period.  Both
    are logged and compared there."""
    import uuid

    from pyspark.ml.classification import GBTClassificationModel

    from domus.operators import runs as G
    from domus.operators.splits import stratified_kfold_label
    from domus.plans.experiment import SCORING, summary_metrics
    from domus.session import checkpoint_dir

    lab = _periods(spark, d).select("transaction_date", "transaction_id", "period", "below_market", *CLS_FEATURES)
    new = lab.where(F.col("period") != "pre")
    root = f"{checkpoint_dir(spark)}/champion-{uuid.uuid4().hex}"
    log = f"{root}/runs"

    def fit(xs):
        return lambda rows: M.boosting(rows, "below_market", xs, "classification", iters=CV_ROUNDS)

    old = fit(OLD_FEATURES)(lab.where(F.col("period") == "pre"))
    old.write().save(f"{root}/champion")
    first = G.append_run(spark, log, "periods", "champion-old", {"features": ",".join(OLD_FEATURES)}, {}, model_path=f"{root}/champion")

    path, xs = G.model_of_run(G.read_runs(spark, log), first)
    scored = M.score_rows(GBTClassificationModel.load(path), new, xs)
    got = V.binary_metrics(scored.withColumn("prediction", F.col("prediction").cast("int")), "below_market", "prediction").first()
    champion = G.append_run(spark, log, "periods", "champion-new", {"features": ",".join(xs)}, {m: got[m] for m in SCORING}, model_path=path)

    folds = stratified_kfold_label(new, "below_market", ["transaction_date", "transaction_id"], 5)
    _, summary, _ = M.cross_validate(folds, "below_market", CLS_FEATURES, "fold", 5, fit(CLS_FEATURES), metrics=SCORING)
    judged = {m: v for m, v in summary_metrics(summary).items()}
    challenger = G.append_run(spark, log, "periods", "challenger-new", {"features": ",".join(CLS_FEATURES)},
                              judged | {m: judged[f"average_test_{m}"] for m in SCORING})
    return G.compare_runs(G.read_runs(spark, log), champion, challenger, list(SCORING))


# ------------------------------------------------------------------ Q6
@register("q6_region_experiment")
def q6_region_experiment(spark, d):
    from domus.plans.catalog_features import annual, monthly, prepared, BUILDING_TYPES, REGION_NAMES
    from domus.plans.experiment import region_experiment

    tx, kept = prepared(spark, d)
    feats, _ = C.engineer_features(tx, C.city_features(kept), annual(spark, d), monthly(spark, d),
                                   BUILDING_TYPES, REGION_NAMES)
    features = ["living_area", "num_rooms", "latitude", "longitude", "off_plan", "city_requested",
                "avg_price_per_m2_previous_month", "num_transactions_previous_month", "interest_rate",
                "debt_ratio"]
    runs = region_experiment(feats, features, target="below_market", order=["transaction_year", "transaction_month",
                                                                            "transaction_id"],
                             years=(1995, 1997), iters=CV_ROUNDS, depth=5, tags={"data_version": "v1"})
    return rounded(runs, 6)
