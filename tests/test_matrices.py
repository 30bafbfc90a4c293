"""Cross products, correlations and least squares against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from domus.operators import aggregates as A
from domus.operators import matrices as MX
from domus.operators import models as M


def _table(spark, n, k, seed=1, missing=0.2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) * 10 ** rng.uniform(-2, 3, k) + rng.normal(size=k) * 100
    x[:, 1] = 3 * x[:, 0] + rng.normal(size=n)
    x[:, 2] = 7.0  # constant
    gone = rng.random((n, k)) < missing
    gone[:, 3] = True
    rows = [[None if g else (float("nan") if (i + j) % 97 == 0 else float(v)) for j, (v, g) in enumerate(zip(r, h))] for i, (r, h) in enumerate(zip(x, gone))]
    cols = [f"c_{j}" for j in range(k)]
    x[[[v is None or v != v for v in r] for r in rows]] = np.nan
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(4), x, cols


def _expected(x, i, j):
    ok = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
    a, b = x[ok, i], x[ok, j]
    if ok.sum() < 2 or np.ptp(a) == 0 or np.ptp(b) == 0:
        return None, int(ok.sum())
    return float(np.corrcoef(a, b)[0, 1]), int(ok.sum())


def test_correlation_pairs_of_a_wide_table(spark):
    df, x, cols = _table(spark, 300, 200)
    plan = A.correlation_pairs(df, cols)
    got = {(r["a"], r["b"]): (r["r"], r["n"]) for r in plan.collect()}
    assert len(got) == 200 * 199 // 2
    for i in range(0, 200, 13):
        for j in range(i + 1, 200):
            r, n = _expected(x, i, j)
            g = got[cols[i], cols[j]]
            assert g[1] == n and ((r is None and g[0] is None) or abs(g[0] - r) < 1e-9), (i, j)


def test_cross_products_do_not_depend_on_blocks(spark):
    df, _, cols = _table(spark, 100, 9)
    key = lambda rows: sorted(map(tuple, rows))
    a, b = (key(MX.cross_products(df, cols, block).collect()) for block in (4, 64))
    assert [r[:3] for r in a] == [r[:3] for r in b] and np.allclose([r[3:] for r in a], [r[3:] for r in b])
    assert A.correlation_pairs(df.limit(0), cols[:3]).where("n > 0 or r is not null").count() == 0


def test_correlation_far_from_zero(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=500)
    b = a + rng.normal(size=500)
    df = spark.createDataFrame([(float(x + 1e9), float(y - 1e9)) for x, y in zip(a, b)], "a double, b double")
    r = A.correlation_pairs(df, ["a", "b"]).first()["r"]
    assert abs(r - np.corrcoef(a + 1e9, b - 1e9)[0, 1]) < 1e-6


def test_triangular_factor(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 5))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x] + [(None, 1.0, 1.0, 1.0, 1.0), (float("nan"),) + (1.0,) * 4, (float("inf"),) + (1.0,) * 4],
                               "a double, b double, c double, d double, e double").repartition(7)
    monkeypatch.setattr(MX, "FAN_IN", 3)
    r, n = MX.triangular_factor(df, df.columns)
    assert n == 500 and np.allclose(r.T @ r, x.T @ x) and np.allclose(r, np.triu(r))
    r, n = MX.triangular_factor(df.limit(0), df.columns)
    assert n == 0 and not r.any()


def test_ols_of_badly_scaled_columns(spark):
    # the normal equations lose these coefficients
    rng = np.random.default_rng(6)
    a = rng.normal(size=400)
    b = a + 1e-7 * rng.normal(size=400)
    y = 2 * a - 3 * b
    df = spark.createDataFrame([(float(p), float(q), float(v)) for p, q, v in zip(a, b, y)], "a double, b double, y double")
    got = {r["feature"]: r["coef"] for r in M.ols(df, "y", ["a", "b"]).collect()}
    assert abs(got["a"] - 2) < 1e-4 and abs(got["b"] + 3) < 1e-4


def test_ols_names_cannot_collide(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 4))
    y = x @ [1, 2, 3, 4] + 0.1 * rng.normal(size=200)
    names = ["a", "b_c", "a_b", "c"]
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], ", ".join(f"{c} double" for c in [*names, "y"]))
    got = {r["feature"]: r["coef"] for r in M.ols(df, "y", names).collect()}
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose([got[c] for c in names], want)


@pytest.mark.parametrize("intercept", [False, True])
def test_ols_of_collinear_and_constant_columns(spark, intercept):
    rng = np.random.default_rng(8)
    x1, x2 = rng.normal(size=(2, 300))
    y = 3 * x1 - 2 * x2 + 5 + rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b), float(v)) for a, b, v in zip(x1, x2, y)], "x1 double, x2 double, y double").withColumns(
        {"copy": F.col("x1") - 2 * F.col("x2"), "zero": F.lit(0.0), "one": F.lit(4.0)})
    xs = ["x1", "x2", "copy", "zero", "one"]
    rows = {r["feature"]: r for r in M.ols(df, "y", xs, intercept=intercept).collect()}
    gone = {c for c, r in rows.items() if r["dropped"]}
    assert gone == ({"copy", "zero", "intercept"} if intercept else {"copy", "zero"})
    want = np.linalg.lstsq(np.column_stack([x1, x2, np.full(300, 4.0)]), y, rcond=None)[0]
    assert np.allclose([rows[c]["coef"] for c in ("x1", "x2", "one")], want)
    res = y - np.column_stack([x1, x2, np.full(300, 4.0)]) @ want
    total = ((y - y.mean()) ** 2).sum() if intercept else (y ** 2).sum()
    assert abs(rows["x1"]["r2"] - (1 - (res ** 2).sum() / total)) < 1e-9
    log = M.backward_eliminate(df, "y", xs, intercept=intercept).collect()
    assert {r["dropped"] for r in log} >= {"copy", "zero"} and {"x1", "x2"} <= set(log[-1]["remaining"].split(","))


def test_ols_with_intercept_statistics(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=120)
    y = 1.5 * x + 4 + rng.normal(size=120)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    rows = {r["feature"]: r for r in M.ols(df, "y", ["x"], intercept=True).collect()}
    z = np.column_stack([x, np.ones(120)])
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    s2 = ((y - z @ beta) ** 2).sum() / 118
    se = np.sqrt(np.diag(s2 * np.linalg.inv(z.T @ z)))
    assert np.allclose([rows["x"]["coef"], rows["intercept"]["coef"]], beta) and np.allclose([rows["x"]["std_err"], rows["intercept"]["std_err"]], se)


def test_ols_without_rows(spark):
    df = spark.createDataFrame([], "x double, y double")
    r = M.ols(df, "y", ["x"]).first()
    assert r["dropped"] and r["coef"] is None and r["n"] == 0
