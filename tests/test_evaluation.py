import random

from pyspark.sql import functions as F

from domus.operators import evaluation as V


def _auc_pairs(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_roc_auc_equals_pair_counting(spark):
    random.seed(5)
    rows = [(random.randint(0, 1), round(random.random(), 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    got = V.roc_auc(df, "y", "s").collect()[0]["roc_auc"]
    assert abs(got - _auc_pairs(rows)) < 1e-12
    grouped = V.roc_auc(df.withColumn("g", F.lit("a")), "y", "s", by=["g"]).collect()[0]["roc_auc"]
    assert abs(grouped - got) < 1e-12


def test_pr_curve_endpoints(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)]
    df = spark.createDataFrame(rows, "y int, s double")
    pts = {r["threshold"]: (r["precision"], r["recall"]) for r in V.pr_curve(df, "y", "s").collect()}
    assert pts[None] == (1.0, 0.0)
    assert pts[0.9] == (1.0, 0.5)
    assert pts[0.1] == (0.5, 1.0)
    auc = V.pr_auc(df, "y", "s").collect()[0]["pr_auc"]
    exp = 0.5 * (1 + 1) / 2 + 0.5 * (2 / 3 + 0.5) / 2  # trapezoids between recall 0, .5, 1
    assert abs(auc - exp) < 1e-12


def test_classification_report_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    rep = {r["label"]: r for r in V.classification_report(df, "y", "p").collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1"] == 0.0
    assert abs(rep["accuracy"]["precision"] - 2 / 3) < 1e-12
    cm = {(r["actual"], r["predicted"]): r["count"] for r in V.confusion_matrix(df, "y", "p").collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    m = V.regression_metrics(df, "y", "p").collect()[0]
    assert abs(m["rmse"] - (2 / 3) ** 0.5) < 1e-12
    assert abs(m["mae"] - 2 / 3) < 1e-12
    assert abs(m["r2"] - (1 - 2 / 8)) < 1e-12


def test_label_union_overlapping_groups(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    out = V.label_union(df, {"odd": F.col("x") % 2 == 1, "all": F.lit(True)})
    assert sorted((r["group"], r["x"]) for r in out.collect()) == [
        ("all", 1), ("all", 2), ("all", 3), ("odd", 1), ("odd", 3)]
