import os
import tempfile

from pyspark.sql import functions as F

from domus.operators import models as M
from domus.streaming.scoring import score_stream


def test_stream_scores_every_arriving_row(spark):
    rng = spark.range(400).select(
        F.col("id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    data = rng.withColumn("price", F.col("a") * 3 + F.col("b")).withColumn(
        "label", (F.col("a") > 3).cast("int"))
    reg = M.forest(data, "price", ["a", "b"], "regression", trees=3, max_depth=3)
    cls = M.boosting(data, "label", ["a", "b"], "classification", iters=3, depth=2)
    root = tempfile.mkdtemp(prefix="domus-stream-")
    src = os.path.join(root, "in")
    data.select("id", "a", "b").repartition(3).write.parquet(src)
    q = score_stream(spark, src, "id long, a double, b double", ["a", "b"], reg, ["a", "b"], cls,
                     os.path.join(root, "out"), os.path.join(root, "ckpt"), keep=["id"])
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(root, "out"))
    assert out.count() == 400
    assert out.where(F.col("probability_below_market").isNull()).count() == 0
