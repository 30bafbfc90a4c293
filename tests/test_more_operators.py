import numpy as np
from pyspark.sql import functions as F

from domus.operators import aggregates as A
from domus.operators import evaluation as V
from domus.operators import joins as J
from domus.operators import models as M


def test_kde_integrates_to_one(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(x), "a" if i % 2 else "b") for i, x in enumerate(rng.normal(size=600))],
                               "x double, g string")
    pts = V.kde(df, "x", by=["g"]).orderBy("g", "point").collect()
    for g in ("a", "b"):
        xs = np.array([r["x"] for r in pts if r["g"] == g])
        ys = np.array([r["density"] for r in pts if r["g"] == g])
        assert len(xs) == 200
        assert abs(np.trapezoid(ys, xs) - 1.0) < 0.02


def test_histogram_and_shares(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    h = {r["bin"]: r["count"] for r in V.histogram(df, "x", 10).collect()}
    assert h == {b: 10 for b in range(10)}
    h2 = {r["bin"]: r["count"] for r in V.histogram(df, "x", 2, lo=0.0, hi=10.0).collect()}
    assert h2 == {0: 5, 1: 95}  # out-of-range values land in the edge bins
    shares = V.compare_distributions(df.withColumn("y", F.col("x") * 2), ["x", "y"],
                                     {"all": F.lit(True), "low": F.col("x") < 30}, 5)
    tot = {(r["group"], r["feature"]): 0.0 for r in shares.collect()}
    for r in shares.collect():
        tot[(r["group"], r["feature"])] += r["share"]
    assert all(abs(v - 1.0) < 1e-12 for v in tot.values())


def test_sampling_and_top_groups(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    s1 = [r["id"] for r in A.sample_rows(df, 25, "id", 42).collect()]
    s2 = [r["id"] for r in A.sample_rows(df.repartition(5), 25, "id", 42).collect()]
    assert sorted(s1) == sorted(s2) and len(set(s1)) == 25
    cols = A.sample_columns(df, ["id", "k"], 10, "id", 1)
    assert cols.count() == 10 and sorted(cols.columns) == ["id", "k", "slot"]
    top = {r["k"] for r in A.top_groups(df, "k", 2).collect()}
    assert top == {0, 1}  # 143 rows each for keys 0..5 → ties broken by key
    assert A.keep_top_groups(df, "k", 2).count() == 286


def test_restrict_to_scope_and_pivot(spark):
    df = spark.createDataFrame([("1", 10, 5.0), ("2", 20, 6.0), ("3", 30, 7.0)], "dep string, city int, v double")
    scope = spark.createDataFrame([(1, 10), (3, 31)], "dep int, city int")
    out = J.restrict_to_scope(df, scope, ["dep", "v"], casts={"dep": "int"}).collect()
    assert [(r["dep"], r["v"]) for r in out] == [(1, 5.0)]
    ev = spark.createDataFrame([("m1", 0), ("m1", 1), ("m2", 1)], "p string, t int")
    piv = {r["p"]: (r["0"], r["1"]) for r in A.class_evolution(ev, "p", "t", [0, 1]).collect()}
    assert piv == {"m1": (1, 1), "m2": (0, 1)}


def test_confident_errors_and_binned_profile(spark):
    df = spark.createDataFrame([(1, 0, 0.05), (1, 0, 0.3), (0, 1, 0.95), (0, 1, 0.6), (1, 1, 0.99)],
                               "y int, p int, s double")
    out = sorted((r["error_type"], r["s"]) for r in V.confident_errors(df, "y", "p", "s").collect())
    assert out == [("false_negative", 0.05), ("false_positive", 0.95)]
    prof = V.binned_profile(spark.createDataFrame([(float(i), float(i % 2)) for i in range(10)], "x double, y double"),
                            "x", "y", 2).orderBy("bin").collect()
    assert [r["n"] for r in prof] == [5, 5] and prof[0]["mean"] == 0.4


def test_decision_grid_and_segment_scoring(spark):
    df = spark.range(200).select((F.col("id") % 20).cast("double").alias("a"),
                                 (F.col("id") % 13).cast("double").alias("b"),
                                 (F.col("id") % 20 > 9).cast("int").alias("y"),
                                 F.when(F.col("id") % 2 == 0, "s1").otherwise("s2").alias("seg"))
    model = M.logistic(df, "y", ["a", "b"])
    grid = M.decision_grid(model, df, "a", "b", 10)
    assert grid.count() == 100
    classes = {r["predicted_class"] for r in grid.collect()}
    assert classes == {0, 1}
    models = M.fit_by_segment(df, "seg", ["s1", "s2"],
                              lambda part: M.forest(part, "y", ["a", "b"], "classification", trees=3, max_depth=3))
    scored = M.score_by_segment(df, "seg", models, ["a", "b"])
    assert scored.count() == 200


def test_drift_paths_agree(spark):
    from domus.operators import drift as D

    rng = np.random.default_rng(5)
    ref = spark.createDataFrame([(float(x), float(y)) for x, y in zip(rng.normal(size=400).round(2),
                                                                      rng.exponential(size=400).round(2))],
                                "a double, b double")
    cur = spark.createDataFrame([(float(x), float(y)) for x, y in zip(rng.normal(0.3, 1, 300).round(2),
                                                                      rng.exponential(size=300).round(2))],
                                "a double, b double")
    single = {r["column"]: r for r in D.numeric_drift(ref, cur, ["a", "b"]).collect()}
    spark.conf.set("domus.order.singleTaskRows", "0")
    try:
        bucketed = {r["column"]: r for r in D.numeric_drift(ref, cur, ["a", "b"]).collect()}
    finally:
        spark.conf.unset("domus.order.singleTaskRows")
    for c in ("a", "b"):
        assert abs(single[c]["ks_statistic"] - bucketed[c]["ks_statistic"]) < 1e-12
        assert abs(single[c]["wasserstein_norm"] - bucketed[c]["wasserstein_norm"]) < 1e-9
    assert single["a"]["ks_statistic"] > single["b"]["ks_statistic"]


def test_reverse_one_hot_strict_rejects_invalid_rows(spark):
    import pytest

    from domus.operators.encoding import reverse_one_hot

    ok = spark.createDataFrame([(1, 0)], "t_a int, t_b int")
    assert reverse_one_hot(ok, "t").collect()[0]["t"] == "a"
    bad = spark.createDataFrame([(1, 1)], "t_a int, t_b int")
    assert reverse_one_hot(bad, "t", strict=False).collect()[0]["t"] is None
    with pytest.raises(Exception):
        reverse_one_hot(bad, "t").collect()


def test_categorical_drift_new_category(spark):
    from domus.operators import drift as D

    ref = spark.createDataFrame([(c,) for c in "aaabbb"], "c string")
    cur = spark.createDataFrame([(c,) for c in "aabbcc"], "c string")
    r = D.categorical_drift(ref, cur, ["c"]).collect()[0]
    p = np.array([0.5, 0.5, 1e-4])
    p = p / p.sum()
    q = np.array([1 / 3, 1 / 3, 1 / 3])
    m = (p + q) / 2
    js = np.sqrt(0.5 * np.sum(p * np.log(p / m)) + 0.5 * np.sum(q * np.log(q / m)))
    assert abs(r["js_distance"] - js) < 1e-12 and r["dof"] == 2 and r["method"] == "chisquare"


def test_salted_join_equals_plain_join(spark):
    detail = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                                      F.col("id"))
    agg = detail.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    a = J.salted_join(detail, agg, ["k"], 8, ["id"])
    b = detail.join(agg, ["k"])
    assert a.count() == b.count() == 3000
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    spark.conf.set("domus.broadcast.maxRows", "1")
    try:
        c = J.join_detail_aggregate(detail, agg, ["k"], salts=4, salt_source=["id"])
        assert c.exceptAll(b.select(*c.columns)).count() == 0
    finally:
        spark.conf.unset("domus.broadcast.maxRows")


def test_small_side_broadcasts_only_proven_small_sides(spark):
    small = spark.createDataFrame([(i, str(i)) for i in range(10)], "k int, v string")
    assert J.sized_side(small)[1]
    spark.conf.set("domus.broadcast.maxRows", "5")
    spark.conf.set("domus.broadcast.maxBytes", "64")
    try:
        assert not J.sized_side(spark.range(100).withColumnRenamed("id", "k"))[1]
    finally:
        spark.conf.unset("domus.broadcast.maxRows")
        spark.conf.unset("domus.broadcast.maxBytes")
