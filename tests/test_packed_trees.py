"""Packed trees: scoring, dispatch and attributions against MLlib's own output."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from domus.operators import explain as X
from domus.operators import models as M
from domus.operators import packed_trees as T
from domus.operators.splits import stratified_kfold_label


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), float(3 * a - 2 * b + e), "pqr"[i % 3], int(a + b > 0)) for i, (a, b, e) in enumerate(rng.normal(size=(400, 3)))]
    rows += [(1000, None, 1.0, 1.0, "p", 1), (1001, 1.0, float("nan"), 1.0, "q", 0), (1002, 1.0, 1.0, 1.0, None, 1), (1003, 1.0, 1.0, 1.0, "z", 0)]
    df = spark.createDataFrame(rows, "id long, x1 double, x2 double, y double, seg string, label int")
    df.createOrReplaceTempView("packed_data")
    return df


XS = ["x1", "x2"]


@pytest.fixture(scope="module")
def fitted(spark, data):
    return {"forest_regression": M.forest(data, "y", XS, "regression", trees=7, max_depth=30),
            "forest_classification": M.forest(data, "label", XS, "classification", trees=7, max_depth=8),
            "gbt_regression": M.boosting(data, "y", XS, "regression", iters=6, depth=3),
            "gbt_classification": M.boosting(data, "label", XS, "classification", iters=6, depth=3)}


@pytest.mark.parametrize("chunk", [1, 1 << 24])
def test_margins_equal_the_models(spark, data, fitted, chunk, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_BYTES", chunk)  # one tree a chunk, or all in one
    packed = T.pack(fitted)
    assert packed.kinds == list(fitted) and len(packed.chunks) == (26 if chunk == 1 else 1)
    full = data.where(M.complete(XS))
    wide = T.margins(full, packed, XS)
    for i, (kind, model) in enumerate(fitted.items()):
        p, score = T.predicted(F.col("margins")[i], kind)
        own = {r["id"]: (r["p"], r["s"]) for r in wide.select("id", p.alias("p"), score.alias("s")).collect()}
        ref = M.score_rows(model, full, XS)
        if "classification" in kind:
            ref = M.class_probability(ref, "s")
        else:
            ref = ref.withColumn("s", F.lit(None).cast("double"))
        for r in ref.select("id", "prediction", "s").collect():
            assert abs(own[r["id"]][0] - r["prediction"]) < 1e-9
            assert r["s"] is None or abs(own[r["id"]][1] - r["s"]) < 1e-9


def test_dispatch_scores_each_row_with_its_segments_model(spark, data):
    models = M.fit_by_segment(data, "seg", ["p", "q", "absent"], lambda rows: M.forest(rows, "y", XS, "regression", trees=5, max_depth=5))
    assert set(models) == {"p", "q"}
    scored = M.score_by_segment(data, "seg", models, XS)
    got = {r["id"]: r["prediction"] for r in scored.collect()}
    assert set(got) == {r["id"] for r in data.collect()}
    assert all(got[i] is None for i in (1000, 1001, 1002, 1003, 2, 5))
    for s, m in models.items():
        for r in M.score_rows(m, data.where(F.col("seg") == s), XS).where("prediction is not null").collect():
            assert abs(got[r["id"]] - r["prediction"]) < 1e-9
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Relation") == 1 and "Union" not in plan


def test_cross_validation_reads_each_row_once(spark, data):
    folds = stratified_kfold_label(data, "label", ["id"], 4)
    fit = lambda rows: M.boosting(rows, "label", XS, "classification", iters=4, depth=3)
    models = [fit(folds.where(F.col("fold") != f)) for f in range(4)]
    scored = M.score_folds(models, folds, XS, "fold", "label")
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("MapInArrow") == 1
    assert scored.count() == 4 * 402
    per, summary, model = M.cross_validate(folds, "label", XS, "fold", 4, fit, refit=True, metrics=["f1", "roc_auc"])
    assert per.columns == ["fold", "role", "num_rows", "f1", "roc_auc"] and model is not None
    sizes = {(r["fold"], r["role"]): r["num_rows"] for r in per.collect()}
    for f in range(4):
        own = folds.where(M.complete(XS))
        assert sizes[f, "test"] == own.where(F.col("fold") == f).count() and sizes[f, "test"] + sizes[f, "train"] == 402
    by_hand = {(r["fold"], r["role"]): r["f1"] for r in per.collect()}
    for f, m in enumerate(models):
        s = M.score_rows(m, folds.where((F.col("fold") == f) & M.complete(XS)), XS).select("label", "prediction").toPandas()
        tp = ((s.label == 1) & (s.prediction == 1)).sum()
        assert abs(by_hand[f, "test"] - 2 * tp / max(1, (s.label == 1).sum() + (s.prediction == 1).sum())) < 1e-9
    assert {c for c in summary.columns} == {"role", "mean_f1", "mean_roc_auc", "std_f1", "std_roc_auc"}
    with pytest.raises(ValueError, match="unknown metrics"):
        M.cross_validate(folds, "label", XS, "fold", 4, fit, metrics=["f2"])


def test_cross_validation_of_other_models_chains_transforms(spark, data):
    folds = stratified_kfold_label(data, "label", ["id"], 3)
    per, _, _ = M.cross_validate(folds, "label", XS, "fold", 3, lambda rows: M.logistic(rows, "label", XS), metrics=["accuracy", "roc_auc"])
    rows = per.collect()
    assert len(rows) == 6 and all(r["accuracy"] > 0.9 and r["roc_auc"] > 0.95 for r in rows)


@pytest.mark.parametrize("kind", ["forest_regression", "forest_classification", "gbt_regression", "gbt_classification"])
@pytest.mark.parametrize("chunk", [1, 1 << 24])
def test_contributions_add_up(spark, data, fitted, kind, chunk, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_BYTES", chunk)
    full = data.where(M.complete(XS))
    packed = T.pack({"m": fitted[kind]})
    wide = X.path_contributions(fitted[kind], full, XS, packed)
    margin = T.margins(wide, packed, XS, "m")
    off = margin.select(F.abs(F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, x: a + x) - F.col("m")[0]).alias("d"))
    assert off.agg(F.max("d")).first()[0] < 1e-9


def test_breakdown_and_dependence(spark, data, fitted):
    model = fitted["forest_regression"]
    full = data.where(M.complete(XS))
    attr = {(r["id"], r["feature"]): r for r in X.tree_attributions(model, full, XS, "id").collect()}
    one = X.attribution_breakdown(model, full, XS, "id", 7).collect()
    assert [abs(r["contribution"]) for r in one] == sorted((abs(attr[7, f]["contribution"]) for f in XS), reverse=True)
    assert X.attribution_breakdown(model, full, XS, "id").first()["id"] == 0
    for r in X.attribution_dependence(model, full, XS, "x1", "x2", "id").collect():
        a = attr[r["id"], "x1"]
        assert (r["value"], r["colour_value"]) == (a["value"], attr[r["id"], "x2"]["value"]) and abs(r["contribution"] - a["contribution"]) < 1e-12
    with pytest.raises(ValueError, match="of kind"):
        X.tree_attributions(model, full, XS, "id", kind="gbt_regression")


def test_permutations_are_bijections_and_ignore_partitions(spark, data, fitted):
    for n in (1, 2, 3, 10, 97, 1000):
        for seed in (1, 42):
            got = spark.range(n).select(X.permuted(F.col("id"), n, seed).alias("p")).collect()
            assert sorted(r["p"] for r in got) == list(range(n))
    big = 10 ** 15 + 37
    p = [r["p"] for r in spark.createDataFrame([(big - 1,), (big - 2,), (0,)], "i long").select(X.permuted(F.col("i"), big, 5).alias("p")).collect()]
    a, b = X.bijection(big, 5)
    assert p == [(a * i + b) % big for i in (big - 1, big - 2, 0)]
    full = data.where(M.complete(XS))
    rows = [{r["feature"]: r["importance_mean"] for r in X.permutation_importance(
        fitted["gbt_regression"], full.repartition(k), XS, "y", "id", repeats=2).collect()} for k in (1, 5)]
    assert all(abs(rows[0][f] - rows[1][f]) < 1e-9 for f in XS) and min(rows[0].values()) > 0.1


def test_permutation_importance_joins_once_per_repeat(spark, data, fitted):
    plan = X.permutation_importance(fitted["gbt_regression"], data.where(M.complete(XS)), XS, "y", "id", repeats=3)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.splitlines() if "Join Inner" in line and "_to" in line]
    assert len(joins) == 3


def test_steps_reach_the_leaves_of_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3, 500))
    x[1, ::7] = np.nan
    left, right = np.array([1, 1, 3, 3, 4]), np.array([2, 1, 4, 3, 4])  # a leaf is its own child
    feature, threshold, value = np.array([1, 0, 2, 0, 0]), np.array([0.0, np.inf, 0.3, np.inf, np.inf]), rng.normal(size=5)
    tree = (0, np.stack([right, left], axis=1).ravel(), feature, threshold, value, 2)

    def plain(row):
        node = 0
        for _ in range(2):
            node = left[node] if row[feature[node]] <= threshold[node] else right[node]
        return node

    assert T._leaves(x, tree).tolist() == [plain(row) for row in x.T]
    assert T._leaves(x[:, :0], tree).tolist() == []


def test_packed_scores_of_a_batch_and_of_permuted_rows_equal_the_models(spark, data, fitted):
    reg, cls = fitted["forest_regression"], fitted["gbt_classification"]
    packed = T.pack({"model": reg})
    want, got = ({r["id"]: r for r in M.score_batch(data, XS, reg, XS, cls, **more).collect()} for more in ({}, {"packed": packed}))
    assert set(want) == set(got) and want[1000]["predicted_price"] is None and want[1001]["predicted_price"] is None
    for i, r in want.items():
        price = r["predicted_price"]
        assert got[i]["predicted_price"] == (price if price is None else pytest.approx(price, rel=1e-12))
        assert got[i]["probability_below_market"] == r["probability_below_market"] and got[i]["predicted_class"] == r["predicted_class"]
    rows = data.where(M.complete(XS))
    plain, quick = ({r["feature"]: r for r in X.permutation_importance(reg, rows, XS, "y", "id", repeats=2, **more).collect()}
                    for more in ({}, {"packed": packed}))
    for f in XS:
        assert quick[f]["importance_mean"] == pytest.approx(plain[f]["importance_mean"], rel=1e-9)
        assert quick[f]["importance_std"] == pytest.approx(plain[f]["importance_std"], rel=1e-9)


def test_queries_score_many_rows_by_packed_trees(spark, small_dir, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressionModel

    from domus.plans import catalog_models as C

    def refuse(self, *_):
        raise AssertionError("MLlib's own walk")

    monkeypatch.setattr(RandomForestRegressionModel, "transform", refuse)
    n = C._labelled(spark, small_dir).count()
    assert C.m10_score_batch(spark, small_dir).where("predicted_price IS NOT NULL").count() == n > 0
    assert C.x4_permutation_importance(spark, small_dir).count() == len(C.REG_FEATURES)
    assert C.x3_compare_models(spark, small_dir).count() == 4


def test_ranked_thresholds_lead_to_the_same_leaves():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(3, 400)), 1)
    x[1, ::7] = np.nan
    inf = np.inf
    trees = [(0, np.stack([np.array([2, 1, 4, 3, 4]), np.array([1, 1, 3, 3, 4])], axis=1).ravel(), np.array([f, 0, 2, 0, 0]), np.array([c, inf, 0.3, inf, inf]),
              rng.normal(size=5), 2) for f, c in ((1, 0.0), (0, -0.4), (1, 0.5), (2, 0.3))]
    edges, ranked = T._ranked(trees)
    assert [e.tolist() for e in edges] == [[-0.4], [0.0, 0.5], [0.3]] and all(t[3].dtype == np.uint8 for t in ranked)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(v) for v in x], names=["a", "b", "c"])
    coded = T._features(batch, ["a", "b", "c"], edges)
    for plain, own in zip(trees, ranked):
        assert T._leaves(T._features(batch, ["a", "b", "c"]), plain).tolist() == T._leaves(coded, own).tolist()
    leaf = (0, np.zeros(2, np.intp), np.zeros(1, np.intp), np.array([inf]), np.ones(1), 0)
    assert T._ranked([leaf])[0] == [] and T._leaves(T._features(batch, ["a"], []), T._ranked([leaf])[1][0]).tolist() == [0] * 400
    many = [(0, np.zeros(2, np.intp), np.zeros(1, np.intp), np.array([float(k)]), np.ones(1), 0) for k in range(256)]
    assert T._ranked(many) == (None, many) and T._ranked(many[:255])[0] is not None
