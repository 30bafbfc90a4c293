"""Trees grown from binned rows against MLlib's own."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from domus.operators import binned_trees as B
from domus.operators import models as M

XS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    x[:, 2] = np.floor(x[:, 2] * 2)
    y = 3 * x[:, 0] - 2 * x[:, 1] ** 2 + x[:, 2] + rng.normal(scale=0.3, size=len(x))
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    rows += [(9000, None, 1.0, 1.0, 1.0), (9001, 1.0, float("nan"), 1.0, 1.0), (9002, 1.0, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double").coalesce(2)


def _outputs(model, df):
    return np.array([r[1] for r in sorted(model.transform(M.assemble(df.where(M.complete(XS)), XS)).select("id", "prediction").collect())])


def _grown(monkeypatch, fit):
    """The model by MLlib and the one grown from binned rows, in blocks of few rows."""
    own = fit()
    monkeypatch.setattr(M, "BINNED_FOREST_ROWS", 1)
    monkeypatch.setattr(B, "BLOCK_ROWS", 700)
    return own, fit()


@pytest.mark.parametrize("collect", [B.COLLECT_BYTES, 0])
def test_trees_without_bags_are_those_of_mllib(data, monkeypatch, collect):
    monkeypatch.setattr(B, "COLLECT_BYTES", collect)
    est = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=2, maxDepth=5, maxBins=64, seed=42, featureSubsetStrategy="all", bootstrap=False)
    rows = data.where(M.complete([*XS, "y"])).select(*XS, "y")
    want, got = est.fit(M.fit_rows(data, "y", XS)), B.forest(est, rows, rows.count(), XS, "y", 2, 5, 64, 42, 2)
    assert type(got) is type(want) and got.treeWeights == want.treeWeights and got.getNumTrees == 2 and got.getMaxDepth() == 5
    splits = lambda m: [line.split("Predict")[0] for line in m.toDebugString.split("\n")[1:]]
    assert splits(got) == splits(want)
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray())
    assert np.allclose(_outputs(got, data), _outputs(want, data), rtol=1e-9, atol=1e-9)


def test_a_forest_is_as_good_as_mllibs(data, monkeypatch):
    monkeypatch.setattr(B, "STATS_BYTES", 1)  # a tree a pass
    want, got = _grown(monkeypatch, lambda: M.forest(data, "y", XS, trees=8, max_depth=4))
    truth = np.array([r["y"] for r in data.where(M.complete(XS)).orderBy("id").select(F.coalesce("y", F.lit(0.0)).alias("y")).collect()])
    error = lambda m: float(np.mean((_outputs(m, data) - truth) ** 2))
    assert abs(error(got) / error(want) - 1) < 0.1
    assert np.allclose(got.featureImportances.toArray(), want.featureImportances.toArray(), atol=0.03)
    assert got.getNumTrees == len(got.trees) == 8 and max(t.depth for t in got.trees) == 4
    # bags differ from tree to tree, are the same again, and hold all rows once on average
    bags = [B.bag(42, t, 0, 50_000) for t in (0, 0, 1)]
    assert (bags[0] == bags[1]).all() and (bags[0] != bags[2]).any() and abs(bags[0].mean() - 1) < 0.02 and abs((bags[0] == 0).mean() - 0.368) < 0.01


def test_nothing_is_kept_after_a_fit(spark, data, monkeypatch, tmp_path):
    import os

    monkeypatch.setattr(M, "BINNED_FOREST_ROWS", 1)
    monkeypatch.setattr(B, "checkpoint_dir", lambda _: str(tmp_path))
    M.forest(data, "y", XS, trees=2, max_depth=2)
    assert os.listdir(tmp_path) == []


def test_constant_labels_and_features_give_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(M, "BINNED_FOREST_ROWS", 1)
    df = spark.range(200).select(F.col("id").cast("int"), (F.col("id") % 7).cast("double").alias("a"), F.lit(1.0).alias("b"), F.lit(0.1).alias("y"))
    model = M.forest(df, "y", ["a", "b"], trees=3, max_depth=4)
    assert [t.numNodes for t in model.trees] == [1, 1, 1]
    assert all(abs(t.predict(model.trees[0].transform(M.assemble(df.limit(1), ["a", "b"])).first()["features"]) - 0.1) < 1e-12 for t in model.trees)
