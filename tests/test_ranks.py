"""Two-level ranks and bracketed quantiles: right at every size, one job over
the input, hot values and hot classes split."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from domus.operators import ordering as O
from domus.operators import splits as S


def _index_matches(spark, df, order, **kw):
    got = O.with_global_index(df, order, "idx", **kw)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)) - 1)
    same = [got[c].eqNullSafe(want[c]) for c in df.columns]
    assert got.count() == df.count() and got.join(want, same).where(F.col("idx") == F.col("rn")).count() == df.count()
    return got


@pytest.fixture
def rows():
    rng = random.Random(4)
    out = []
    for i in range(3000):
        hot = i % 3 == 0
        day = datetime.date(2020, 1, 1) if hot else datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randint(-400, 400))
        out.append((None if i % 7 == 0 else day, None if i % 11 == 0 else rng.choice(["", "a", "aa", "longer than fourteen bytes a", "longer than fourteen bytes b", "é", "a\x00"]),
                    float("nan") if i % 13 == 0 else rng.choice([0.5, 1.5, -2.0]), i % 2 == 0, i))
    return out


@pytest.mark.parametrize("order", [["d", "i"], ["s", "i"], ["x", "s", "d", "i"], ["b", "i"], ["i"], ["s", "b", "x", "i"]])
@pytest.mark.parametrize("partitions,pieces", [(7, 6), (64, 3)])
def test_global_index_of_hot_and_missing_values(spark, rows, order, partitions, pieces, monkeypatch):
    monkeypatch.setattr(O, "STRING_PIECES", pieces)
    df = spark.createDataFrame(rows, "d date, s string, x double, b boolean, i long").repartition(5)
    _index_matches(spark, df, order, partitions=partitions)


def test_more_buckets_than_an_expression_holds(spark, rows, monkeypatch):
    monkeypatch.setattr(O, "MAX_CUTS", 4)
    df = spark.createDataFrame(rows, "d date, s string, x double, b boolean, i long")
    for order in (["d", "i"], ["i"], ["b", "s", "i"]):
        got = _index_matches(spark, df, order, partitions=16, bucket="bk")
        assert got.select("bk").distinct().count() > O.MAX_CUTS


def test_a_hot_value_is_split_over_buckets(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 9).alias("k"), F.col("id").alias("i"))
    got = O.with_global_index(df, ["k", "i"], "idx", partitions=20, bucket="bk")
    sizes = [r["count"] for r in got.groupBy("bk").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 20_000 / 20 * 3


@pytest.mark.parametrize("make", [lambda df: S.kfold_label(df, ["i"], 5), lambda df: S.time_series_folds(df, ["i"], 5),
                                  lambda df: S.stratified_kfold_label(df, "y", ["i"], 5)])
def test_the_input_is_computed_once(spark, make):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    src = spark.range(2000).select(F.col("id").alias("i"), (F.col("id") % 3).cast("int").alias("y")).repartition(6).mapInArrow(count, "i long, y int")
    assert make(src).count() == 2000
    assert seen.value == 2000


def test_stratified_folds_need_no_broadcast(spark):
    rng = random.Random(3)
    y = [0 if rng.random() < 0.9 else None if rng.random() < 0.2 else rng.randint(1, 30) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(y)), "i int, y int")
    want = {r["i"]: r["fold"] for r in S.stratified_kfold_label(df, "y", ["i"], 4).collect()}
    first = list(dict.fromkeys(y))
    ranked = sorted(range(4000), key=lambda i: (first.index(y[i]), i))
    sizes = {(c, f): 0 for c in first for f in range(4)}
    for p, i in enumerate(ranked):
        sizes[y[i], p % 4] += 1
    expected = {}
    for c in first:
        own = [i for i in range(4000) if y[i] == c]
        at = 0
        for f in range(4):
            expected.update(dict.fromkeys(own[at:at + sizes[c, f]], f))
            at += sizes[c, f]
    assert want == expected
    spark.conf.set("domus.broadcast.maxRows", "10")
    try:
        got = S.stratified_kfold_label(df, "y", ["i"], 4)
        assert {r["i"]: r["fold"] for r in got.collect()} == want
    finally:
        spark.conf.unset("domus.broadcast.maxRows")


def test_group_label_beyond_the_broadcast_limit(spark):
    rows = [(i, None if i % 10 == 0 else "hot" if i % 2 else f"g{i % 50:02d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, g string")
    names = sorted({g for _, g in rows if g is not None})
    want = {i: None if g is None else names.index(g) for i, g in rows}
    spark.conf.set("domus.broadcast.maxRows", "3")
    try:
        out = S.group_label(df, "g")
        assert {r["i"]: r["fold"] for r in out.collect()} == want
        assert "_salt" in out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("domus.broadcast.maxRows")


@pytest.mark.parametrize("whole", [40, 10_000])
def test_quantiles_by_bracket(spark, monkeypatch, whole):
    monkeypatch.setattr(O, "WHOLE_GROUP", whole)
    if whole < 100:  # brackets of a few rows need a margin of a step
        monkeypatch.setattr(O, "SKETCH_STEPS", 16)
        monkeypatch.setattr(O, "NARROW_STEPS", 8)
    rng = np.random.default_rng(2)
    groups = {"wide": rng.normal(size=2500), "few": rng.integers(0, 4, 1500).astype(float), "hot": np.r_[np.zeros(900), rng.normal(size=300)],
              "one": np.array([3.0]), "two": np.array([1.0, 2.0]), None: rng.exponential(size=700)}
    df = spark.createDataFrame([(g, float(v)) for g, x in groups.items() for v in x] + [("wide", None), ("void", None)], "g string, x double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    lin = {(r["g"], r["q"]): r["value"] for r in O.linear_quantiles(df, "x", qs, ["g"]).collect()}
    disc = {(r["g"], r["q"]): r["value"] for r in O.discrete_quantiles(df, "x", qs, ["g"]).collect()}
    assert set(lin) == set(disc) == {(g, q) for g in groups for q in qs}
    for g, x in groups.items():
        s = np.sort(x)
        for q in qs:
            assert abs(lin[g, q] - np.quantile(x, q)) < 1e-9, (g, q)
            assert disc[g, q] == s[max(1, int(np.ceil(q * len(s) - 1e-12))) - 1], (g, q)


def test_quantiles_hold_no_cached_table(spark):
    from domus.operators.aggregates import describe_columns, quantile

    spark.catalog.clearCache()
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("x"), (F.col("id") % 3).alias("g"))
    assert quantile(df, "x", 0.5).first()[0] == np.sort([i * 7919 % 20_011 for i in range(20_000)])[9999]
    describe_columns(df, ["x"], by=["g"]).collect()
    assert quantile(df.limit(0), "x", 0.5).first()[0] is None
    dates = df.select(F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("x").cast("int")).alias("d"))
    assert quantile(dates, "d", 0.0).first()[0] == datetime.date(2020, 1, 1)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()
