"""No row may vanish: NULL groups, classes, labels and features, constant
columns, one-class groups, empty sides, and exact quantile ranks."""

import datetime

import pytest
from pyspark.sql import functions as F

from domus.operators import drift as D
from domus.operators import evaluation as E
from domus.operators import models as M
from domus.operators import ordering as O
from domus.operators.aggregates import describe_columns, quantile
from domus.operators.joins import join_detail_aggregate
from domus.operators.splits import stratified_kfold_label


@pytest.fixture(params=[1_000_000, 0], ids=["window", "buckets"])
def ordering_path(spark, request):
    spark.conf.set("domus.order.singleTaskRows", str(request.param))
    yield
    spark.conf.unset("domus.order.singleTaskRows")


def test_quantile_rank_is_exact(spark, ordering_path):
    df = spark.range(1, 101).select(F.col("id").alias("v"))
    for q, want in ((0.55, 55), (0.07, 7), (0.5, 50), (1.0, 100)):
        assert quantile(df, "v", q).first()[0] == want


def test_quantile_of_dates(spark, ordering_path):
    df = spark.createDataFrame([(datetime.date(2020, 1, d),) for d in range(1, 31)], "v date")
    vc = df.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    assert O.locate_quantile(vc, "v", "c", 0.5).first()["value"] == datetime.date(2020, 1, 15)


def test_prefix_sums_keep_null_groups(spark, ordering_path):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), (None, 1, 5), (None, 3, 7)], "g string, v int, n int")
    got = {(r["g"], r["v"]): r["cum_n"] for r in O.prefix_sums(df, "v", ["n"], group_cols=["g"]).collect()}
    assert got == {("a", 1): 1, ("a", 2): 3, (None, 1): 5, (None, 3): 12}


def test_describe_and_box_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, 4.0)], "g string, v double")
    got = {r["g"]: r["q50"] for r in describe_columns(df, ["v"], by=["g"]).collect()}
    assert got == {"a": 2.0, None: 3.0}
    assert {r["g"] for r in E.box_stats(df, "v", ["g"]).collect()} == {"a", None}


def test_confusion_matrix_counts_nulls(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (0, None), (None, None)], "y int, p int")
    got = E.confusion_matrix(df, "y", "p")
    assert got.agg(F.sum("count")).first()[0] == 4 and got.count() == 9


def test_stratified_folds_keep_null_class(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(20)], "id int, y int")
    got = stratified_kfold_label(df, "y", ["id"], 5)
    assert got.count() == 20
    assert {r["count"] for r in got.groupBy("fold").count().collect()} == {4}


def test_constant_columns_and_one_class(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1, 0.3), (1.0, 3.0, 1, 0.6)], "x double, z double, y int, s double")
    assert [r["count"] for r in E.histogram(df, "x").collect()] == [2]
    assert [r["n"] for r in E.binned_profile(df, "x", "z").collect()] == [2]
    assert E.pred_vs_target(df, "x", "x")[1].first()["count"] == 2
    assert E.compare_distributions(df, ["x"], {"all": F.lit(True)}).first()["share"] == 1.0
    assert E.kde(df, "x").where("density is not null").count() == 0
    assert E.roc_auc(df, "y", "s").first()[0] is None
    assert E.roc_curve(df, "y", "s").count() == 3
    two = df.withColumn("g", F.lit("one")).unionByName(
        spark.createDataFrame([(1.0, 1.0, 1, 0.9, None), (1.0, 1.0, 0, 0.1, None)], "x double, z double, y int, s double, g string"))
    assert {r["g"]: r["roc_auc"] for r in E.roc_auc(two, "y", "s", ["g"]).collect()} == {"one": None, None: 1.0}
    assert E.pr_auc(df.withColumn("y", F.lit(0)), "y", "s").first()[0] is None


def test_drift_with_an_empty_side(spark):
    ref = spark.createDataFrame([(float(i), "a" if i % 2 else "b") for i in range(50)], "v double, c string")
    cur = ref.withColumn("v", F.lit(None).cast("double"))
    assert D.numeric_drift(ref, cur, ["v"]).first()["ks_statistic"] is None
    skew = ref.withColumn("c", F.when(F.col("v") < 35, "a").otherwise("b"))
    a, b = (D.categorical_drift(ref, skew, ["c"], with_p_value=p).first() for p in (True, False))
    assert (a["method"], a["drifted"]) == (b["method"], b["drifted"]) == ("chisquare", True)


def test_scoring_keeps_every_row(spark):
    rows = [(float(i), float(i % 7), float(3 * i), "a") for i in range(40)] + [(None, 1.0, 1.0, "a"), (1.0, 2.0, 3.0, None), (1.0, 1.0, 2.0, "z")]
    df = spark.createDataFrame(rows, "x1 double, x2 double, y double, g string")
    model = M.forest(df, "y", ["x1", "x2"], trees=3, max_depth=3)
    got = M.score_rows(model, df, ["x1", "x2"])
    assert got.count() == len(rows) and got.where("prediction is null").count() == 1
    by = M.score_by_segment(df, "g", {"a": model}, ["x1", "x2"])
    assert by.count() == len(rows) and by.where("prediction is null").count() == 3


def test_salts_hold_with_a_nested_hint(spark):
    small = spark.range(3).withColumnRenamed("id", "k")
    detail = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    agg = detail.join(F.broadcast(small), "k").groupBy("k").agg(F.sum("v").alias("s"))
    spark.conf.set("domus.broadcast.maxRows", "1")
    try:
        plan = join_detail_aggregate(detail, agg, ["k"], salts=8)
        assert "_salt" in plan._jdf.queryExecution().analyzed().toString() and plan.count() == 100
    finally:
        spark.conf.unset("domus.broadcast.maxRows")
