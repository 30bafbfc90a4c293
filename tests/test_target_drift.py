"""The whole output of the target drift."""

from domus.operators import drift as D


def test_target_drift_with_all_statistics(spark):
    ref = spark.createDataFrame([(float(i), "a" if i % 3 else "b") for i in range(60)], "v double, k string")
    cur = spark.createDataFrame([(float(i + 30), "a" if i % 2 else "b") for i in range(60)], "v double, k string")
    number = D.target_drift(ref, cur, "v", "k", [], details=True)[0].where("column = 'v'").first()
    want = D.numeric_drift(ref, cur, ["v"]).first()
    assert {c: number[c] for c in want.asDict()} == want.asDict()
    assert number["kind"] == "number" and number["statistic"] == want["ks_statistic"]
    label = D.target_drift(ref, cur, "v", "k", [], details=True)[0].where("column = 'k'").first()
    assert label["chi2_statistic"] == label["statistic"] and label["ks_statistic"] is None and label["chi2_p_value"] is not None
    short = D.target_drift(ref, cur, "v", "k", [])[0]
    assert short.columns == ["column", "kind", "n_ref", "n_cur", "statistic", "method", "drifted"]


def test_target_drift_query_keeps_its_statistics(spark, small_dir):
    from domus.plans.catalog_eval import d4_target_drift

    assert {"ks_statistic", "ks_p_value", "wasserstein_norm", "kind", "statistic"} <= set(d4_target_drift(spark, small_dir).columns)
