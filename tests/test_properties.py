"""Property checks of SURVEY §5: order/partitioning invariance and
cross-checks against MLlib evaluators."""

import random

from pyspark.sql import functions as F

from domus.operators import evaluation as V
from domus.plans import composite as C
from domus.sources import fixtures as fx


def test_labelled_rows_invariant_under_repartition(spark, small_dir):
    tx = fx.tx(spark, small_dir)
    a = C.labelled_transactions(tx, "1996-01-01", 0)
    b = C.labelled_transactions(tx.repartition(7, "transaction_id"), "1996-01-01", 0)
    cols = ["transaction_id", "below_market", "num_transactions_month"]
    assert a.select(*cols).exceptAll(b.select(*cols)).count() == 0
    assert b.select(*cols).exceptAll(a.select(*cols)).count() == 0


def test_metrics_agree_with_mllib_evaluators(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator

    random.seed(7)
    rows = [(float(random.randint(0, 1)), random.random(), random.gauss(0, 1), random.gauss(0, 1))
            for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, score double, y double, p double")
    m = V.regression_metrics(df, "y", "p").collect()[0]
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(df)
        assert abs(ev - m[name]) < 1e-9, name
    auc = V.roc_auc(df.withColumn("y1", F.col("label").cast("int")), "y1", "score").collect()[0]["roc_auc"]
    ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score",
                                       metricName="areaUnderROC").evaluate(df)
    assert abs(auc - ev) < 1e-9


def test_folds_partition_rows(spark):
    from domus.operators.splits import kfold_label, stratified_kfold_label

    df = spark.range(211).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    for out in (kfold_label(df, ["id"], 5), stratified_kfold_label(df, "y", ["id"], 5)):
        rows = out.collect()
        assert len(rows) == 211 and len({r["id"] for r in rows}) == 211
        assert {r["fold"] for r in rows} == {0, 1, 2, 3, 4}
