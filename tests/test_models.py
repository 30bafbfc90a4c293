import numpy as np
from pyspark.sql import functions as F

from domus.operators import explain as X
from domus.operators import models as M


def _data(spark, n=300):
    rng = np.random.default_rng(0)
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    y = 3 * x1 - 2 * x2 + rng.normal(scale=0.1, size=n)
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    return spark.createDataFrame(rows, "id long, x1 double, x2 double, y double"), x1, x2, y


def test_ols_equals_lstsq(spark):
    df, x1, x2, y = _data(spark)
    got = {r["feature"]: r["coef"] for r in M.ols(df, "y", ["x1", "x2"]).collect()}
    exp, *_ = np.linalg.lstsq(np.column_stack([x1, x2]), y, rcond=None)
    assert abs(got["x1"] - exp[0]) < 1e-9 and abs(got["x2"] - exp[1]) < 1e-9


def test_backward_elimination_drops_noise(spark):
    df, *_ = _data(spark)
    df = df.withColumn("noise", F.sin(F.col("id").cast("double") * 12.9898))
    log = M.backward_eliminate(df, "y", ["x1", "x2", "noise"]).collect()
    assert log[0]["dropped"] == "noise"
    assert log[-1]["remaining"] == "x1,x2"


def test_attributions_sum_to_prediction(spark):
    df, *_ = _data(spark)
    model = M.forest(df, "y", ["x1", "x2"], "regression", trees=5, max_depth=4)
    attr = X.tree_attributions(model, df, ["x1", "x2"], "id")
    scored = model.transform(M.assemble(df, ["x1", "x2"]))
    worst = X.attribution_check(attr, scored, "id").agg(F.max("abs_diff")).collect()[0][0]
    assert worst < 1e-9


def test_most_frequent(spark):
    df = spark.createDataFrame([(1,), (0,), (0,)], "y int")
    assert {r["prediction"] for r in M.most_frequent(df, df, "y").collect()} == {0}


def test_simple_regression_grid(spark):
    df = spark.createDataFrame([(float(x), 2.0 * x + 1) for x in range(10)], "x double, y double")
    out = M.simple_regression(df, "x", "y", 100).orderBy("point").collect()
    assert len(out) == 100 and abs(out[0]["prediction"] - 1.0) < 1e-9 and abs(out[-1]["prediction"] - 19.0) < 1e-9


def test_cross_validate_roles_and_folds(spark):
    from domus.operators.splits import kfold_label

    df = spark.range(100).select(F.col("id"), (F.col("id") % 10 < 3).cast("int").alias("y"),
                                 (F.col("id") % 10).cast("double").alias("x"))
    folds = kfold_label(df, ["id"], 4)
    per, summary, model = M.cross_validate(folds, "y", ["x"], "fold", 4, lambda tr: M.MostFrequentModel(tr, "y"),
                                           refit=True)
    rows = per.collect()
    assert sorted((r["fold"], r["role"]) for r in rows) == sorted(
        (f, role) for f in range(4) for role in ("test", "train"))
    # the dummy always predicts 0 → accuracy = share of zeros in each part
    ys = [1 if i % 10 < 3 else 0 for i in range(100)]
    for r in rows:
        part = [ys[i] for i in range(100) if (i // 25 == r["fold"]) == (r["role"] == "test")]
        assert abs(r["accuracy"] - part.count(0) / len(part)) < 1e-9 and r["f1"] == 0.0
    assert model.value == 0.0
    assert {r["role"] for r in summary.collect()} == {"train", "test"}


def test_permutation_importance_ranks_informative_feature(spark):
    rng = np.random.default_rng(11)
    n = 400
    x1, x2 = rng.uniform(size=n), rng.uniform(size=n)
    y = 5 * x1 + rng.normal(scale=0.05, size=n)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x1, x2, y))],
                               "id long, x1 double, x2 double, y double")
    model = M.forest(df, "y", ["x1", "x2"], "regression", trees=10, max_depth=6)
    imp = {r["feature"]: r["importance_mean"] for r in
           X.permutation_importance(model, df, ["x1", "x2"], "y", "id", "r2", repeats=3).collect()}
    assert imp["x1"] > 0.5 and abs(imp["x2"]) < 0.1


def test_gbt_attributions_sum_to_prediction(spark):
    df, *_ = _data(spark)
    model = M.boosting(df, "y", ["x1", "x2"], "regression", iters=5, depth=3)
    attr = X.tree_attributions(model, df, ["x1", "x2"], "id", kind="gbt_regression")
    scored = model.transform(M.assemble(df, ["x1", "x2"]))
    worst = X.attribution_check(attr, scored, "id").agg(F.max("abs_diff")).collect()[0][0]
    assert worst < 1e-9


def test_forest_classification_attributions_sum_to_probability(spark):
    df, *_ = _data(spark)
    df = df.withColumn("label", (F.col("y") > 0).cast("int"))
    model = M.forest(df, "label", ["x1", "x2"], "classification", trees=5, max_depth=4)
    attr = X.tree_attributions(model, df, ["x1", "x2"], "id", kind="forest_classification")
    scored = M.class_probability(model.transform(M.assemble(df, ["x1", "x2"])), "p1")
    worst = X.attribution_check(attr, scored, "id", prediction="p1").agg(F.max("abs_diff")).collect()[0][0]
    assert worst < 1e-9


def test_logistic_matches_c_parametrised_objective(spark):
    rng = np.random.default_rng(2)
    n = 300
    X1 = rng.normal(size=(n, 2))
    p = 1 / (1 + np.exp(-(1.5 * X1[:, 0] - X1[:, 1] + 0.3)))
    yv = (rng.uniform(size=n) < p).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(X1, yv)], "a double, b double, y int")
    model = M.logistic(df, "y", ["a", "b"], c=1.0, max_iter=200)
    # Newton's method on  C·Σ logloss + ½‖w‖²  (intercept not penalised)
    Z = np.column_stack([X1, np.ones(n)])
    w = np.zeros(3)
    reg = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-Z @ w))
        grad = Z.T @ (mu - yv) + reg @ w
        hess = Z.T @ (Z * (mu * (1 - mu))[:, None]) + reg
        w -= np.linalg.solve(hess, grad)
    got = np.r_[model.coefficients.toArray(), model.intercept]
    assert np.allclose(got, w, rtol=1e-3, atol=1e-3), (got, w)


def test_student_t_p_values():
    # two-sided tail probabilities of Student's t (reference values)
    assert abs(M.t_two_sided_p(2.0, 10) - 0.07338803477074) < 1e-9
    assert abs(M.t_two_sided_p(1.959963984540054, 1e9) - 0.05) < 1e-6
    assert abs(M.t_two_sided_p(0.0, 5) - 1.0) < 1e-12
