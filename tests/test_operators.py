import math

from pyspark.sql import functions as F

from domus.operators import aggregates as A
from domus.operators import drift as D
from domus.operators import encoding as E
from domus.operators import frames as P
from domus.operators import windows as W


def test_drop_incomplete_nan_and_null(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 2.0), (3, float("nan")), (4, None)], "a int, b double")
    assert [r["a"] for r in P.drop_incomplete(df).collect()] == [1]


def test_below_reference_flag_null_is_zero(spark):
    df = spark.createDataFrame([(80.0, 100.0), (95.0, 100.0), (None, 100.0)], "v double, r double")
    assert [r["f"] for r in P.below_reference_flag(df, "v", "r", 0.1, "f").collect()] == [1, 0, 0]


def test_rolling_mean_needs_full_window(spark):
    rows = [("c", m, float(m)) for m in range(1, 9)]
    df = spark.createDataFrame(rows, "city string, m int, v double")
    out = W.add_rolling_mean(df, {"v": "r"}, ["city"], ["m"], 6).orderBy("m").collect()
    assert [r["r"] for r in out[:5]] == [None] * 5
    assert out[5]["r"] == 3.5 and out[7]["r"] == 5.5


def test_calendar_lag_skips_gaps(spark):
    rows = [("c", 2020, 1, 1.0), ("c", 2020, 2, 2.0), ("c", 2020, 4, 4.0)]
    df = spark.createDataFrame(rows, "city string, transaction_year int, transaction_month int, v double")
    order = ["transaction_year", "transaction_month"]
    out = W.add_lag(df, {"v": "lag"}, ["city"], order, calendar_index=W.month_index()).orderBy(*order).collect()
    assert [r["lag"] for r in out] == [None, 1.0, None]
    plain = W.add_lag(df, {"v": "lag"}, ["city"], order).orderBy(*order).collect()
    assert [r["lag"] for r in plain] == [None, 1.0, 2.0]


def test_time_rolling_mean_half_open(spark):
    rows = [(2020, m, float(m)) for m in (1, 2, 3, 7, 8)]
    df = spark.createDataFrame(rows, "year int, month int, x double")
    out = {r["month"]: r["x_rolling_6m"] for r in W.add_time_rolling_mean(df, "x", 6).collect()}
    assert out[7] == (2 + 3 + 7) / 3  # months 2..7; month 1 is exactly 6 months back → excluded
    assert out[8] == (3 + 7 + 8) / 3


def test_forward_fill(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, None), (4, 4.0)], "t int, v double")
    assert [r["v"] for r in W.forward_fill(df, ["v"], ["t"]).orderBy("t").collect()] == [1.0, 1.0, 1.0, 4.0]


def test_cumulative_share_includes_crossing_row(spark):
    df = spark.createDataFrame([("a", 50.0), ("b", 25.0), ("c", 15.0), ("d", 10.0)], "f string, w double")
    assert [r["f"] for r in W.select_by_cumulative_share(df, "f", "w", 0.8).orderBy(F.desc("w")).collect()] == \
        ["a", "b", "c"]


def test_one_hot_roundtrip(spark):
    df = spark.createDataFrame([(1, "Big House"), (2, "flat"), (3, "flat")], "id int, t string")
    oh = E.one_hot(df, "t")
    assert set(oh.columns) == {"id", "t_big_house", "t_flat"}
    back = E.reverse_one_hot(oh, "t")
    assert sorted((r["id"], r["t"]) for r in back.collect()) == [(1, "big_house"), (2, "flat"), (3, "flat")]


def test_scaler_fitted_on_train_only(spark):
    train = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    test1 = spark.createDataFrame([(5.0,)], "x double")
    test2 = spark.createDataFrame([(5.0,), (1000.0,)], "x double")
    p = E.fit_scaler(train, ["x"], "standard")
    a = E.apply_scaler(test1, p, ["x"]).collect()[0]["x"]
    b = E.apply_scaler(test2, p, ["x"]).orderBy("x").collect()[0]["x"]
    assert a == b == 3.0


def test_describe_and_quantile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "x double")
    d = A.describe_columns(df, ["x"]).collect()[0]
    assert d["count"] == 10 and d["min"] == 1.0 and d["max"] == 10.0 and d["q50"] == 5.5
    assert A.quantile(df, "x", 0.25).collect()[0]["value"] == 3.0


def test_ks_identical_samples(spark):
    df = spark.createDataFrame([(float(i % 17),) for i in range(300)], "x double")
    r = D.numeric_drift(df, df, ["x"], method="ks").collect()[0]
    assert r["ks_statistic"] == 0.0 and r["ks_p_value"] == 1.0 and not r["drifted"]


def test_ks_statistic_brute_force(spark):
    a = [float(i) for i in range(0, 100)]
    b = [float(i) + 30.5 for i in range(0, 80)]
    ref = spark.createDataFrame([(x,) for x in a], "x double")
    cur = spark.createDataFrame([(x,) for x in b], "x double")
    r = D.numeric_drift(ref, cur, ["x"]).collect()[0]
    pts = sorted(set(a) | set(b))
    exp = max(abs(sum(v <= p for v in a) / len(a) - sum(v <= p for v in b) / len(b)) for p in pts)
    assert abs(r["ks_statistic"] - exp) < 1e-12
    # Wasserstein-1 of two shifted uniform grids, normalised by the reference std
    w = sum(abs(sum(v <= p for v in a) / len(a) - sum(v <= p for v in b) / len(b)) * (q - p)
            for p, q in zip(pts, pts[1:]))
    sd = math.sqrt(sum((v - sum(a) / len(a)) ** 2 for v in a) / len(a))
    assert abs(r["wasserstein_norm"] - w / sd) < 1e-9


def test_js_zero_on_identical(spark):
    df = spark.createDataFrame([(c,) for c in "aabbbc"], "c string")
    r = D.categorical_drift(df, df, ["c"]).collect()[0]
    assert r["js_distance"] < 1e-12 and r["chi2_p_value"] > 0.99


def test_chi2_tail_probability(spark):
    df = spark.createDataFrame([(3.841458820694124, 1.0), (0.0, 3.0), (11.070497693516351, 5.0)], "x double, k double")
    got = [r[0] for r in df.select(D.chi2_sf("x", "k")).collect()]
    assert abs(got[0] - 0.05) < 1e-9 and got[1] == 1.0 and abs(got[2] - 0.05) < 1e-9


def test_date_rolling_mean_half_open_brute_force(spark):
    import datetime as dt

    import pandas as pd

    dates = [dt.date(2020, 1, 31), dt.date(2020, 2, 29), dt.date(2020, 3, 15), dt.date(2020, 7, 31),
             dt.date(2020, 8, 31), dt.date(2020, 9, 15), dt.date(2021, 2, 28)]
    rows = [(d, float(i + 1)) for i, d in enumerate(dates)]
    df = spark.createDataFrame(rows, "d date, x double")
    got = {r["d"]: r["x_rolling_6m"] for r in W.add_date_rolling_mean(df, "x", "d", 6).collect()}
    for t in dates:
        lo = (pd.Timestamp(t) - pd.DateOffset(months=6)).date()
        vals = [x for d, x in rows if lo < d <= t]
        assert abs(got[t] - sum(vals) / len(vals)) < 1e-12, t
