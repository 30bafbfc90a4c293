import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from domus.operators.ordering import locate_quantile, prefix_sums, with_global_index


@pytest.fixture(params=["single_task", "bucketed"])
def path(request, spark):
    """Run each ordering test through both execution paths."""
    if request.param == "bucketed":
        spark.conf.set("domus.order.singleTaskRows", "0")
    yield request.param
    spark.conf.unset("domus.order.singleTaskRows")


def test_prefix_sums_match_cumsum(spark, path):
    random.seed(1)
    rows = [(float(i), random.randint(0, 5), random.randint(0, 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "v double, a int, b int").repartition(7)
    out = prefix_sums(df, "v", ["a", "b"], buckets=16).orderBy("v").collect()
    ca = np.cumsum([r[1] for r in rows])
    cb = np.cumsum([r[2] for r in rows])
    assert [r["cum_a"] for r in out] == list(ca)
    assert [r["cum_b"] for r in out] == list(cb)


def test_prefix_sums_descending_grouped_with_next(spark, path):
    rows = [(g, float(v), 1) for g in ("x", "y") for v in range(50)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    out = prefix_sums(df, "v", ["n"], descending=True, group_cols=["g"], buckets=8, with_next=True).collect()
    for r in out:
        assert r["cum_n"] == 50 - int(r["v"])
        assert r["next_v"] == (None if r["v"] == 0 else r["v"] - 1)


def test_global_index_equals_row_number(spark):
    random.seed(2)
    # a hot first-column value holds a third of the rows
    rows = [(0 if i % 3 == 0 else random.randint(1, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, id int").repartition(5)
    got = with_global_index(df, ["k", "id"], "idx", partitions=6)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy("k", "id")) - 1)
    bad = got.join(ref, ["k", "id"]).where(F.col("idx") != F.col("rn")).count()
    assert bad == 0
    assert got.count() == 3000


def test_locate_quantile_is_percentile_disc(spark, path):
    random.seed(3)
    vals = [random.choice([1.0, 2.0, 2.0, 5.0]) + random.randint(0, 30) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    vc = df.groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    s = sorted(vals)
    for q in (0.0, 0.1, 0.25, 0.5, 0.8, 0.99, 1.0):
        pos = max(1, int(np.ceil(q * len(s))))
        exp = s[pos - 1]
        got = locate_quantile(vc, "x", "n", q, buckets=8).collect()[0]["value"]
        assert got == exp, q


def test_linear_quantiles_match_numpy(spark, path):
    from domus.operators.ordering import linear_quantiles

    random.seed(9)
    rows = [(random.choice("ab"), float(random.randint(0, 40))) for _ in range(301)] + [("c", 5.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], r["q"]): r["value"] for r in linear_quantiles(df, "x", [0.1, 0.5, 0.9], ["g"]).collect()}
    for g in "abc":
        xs = np.array([x for k, x in rows if k == g])
        for q in (0.1, 0.5, 0.9):
            assert abs(got[(g, q)] - np.quantile(xs, q)) < 1e-9
