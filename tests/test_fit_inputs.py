"""What the fits read: joined once, in a bounded number of partitions."""

from pyspark.sql import functions as F

from domus.operators import models as M
from domus.plans import catalog_models as C
from domus.plans import catalog_prep


def test_fit_rows_have_a_bounded_number_of_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(0, 4000, 1, 20 * cores).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y"))
    rows = M.fit_rows(df, "y", ["x"])
    assert rows.rdd.getNumPartitions() == M.FIT_PARTITIONS * cores
    assert rows.count() == 4000
    assert M.fit_rows(df.coalesce(2), "y", ["x"]).rdd.getNumPartitions() == 2


def test_models_read_written_rows_not_the_joins(spark, small_dir):
    for got, want in ((C._base(spark, small_dir), catalog_prep.base(spark, small_dir)),
                      (C._labelled(spark, small_dir), catalog_prep.labelled(spark, small_dir))):
        assert not any("lineitem" in f for f in got.inputFiles())
        want = want.select(*got.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0


def _sizes(df):
    return df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()


def _uneven(spark, n):
    """All rows in one of four partitions."""
    data = spark.range(0, n, 1, 4).select((F.col("id") * 7 % n).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"),
                                          (F.col("id") % 2).cast("int").alias("y"))
    return data.repartition(4, F.lit(1))


def test_partitions_of_a_tree_fit():
    least, most = M.TREE_ROWS_LEAST, M.TREE_ROWS_MOST
    assert [M.tree_partitions(n, 8) for n in (0, least - 1, 3 * least, 8 * least, 8 * most)] == [0, 0, 3, 8, 8]
    assert M.tree_partitions(8 * most + 1, 8) == 16
    assert M.tree_partitions(10**9, 8) == 8 * M.FIT_PARTITIONS


def test_tree_fits_read_evenly_dealt_rows(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import RandomForestRegressor

    monkeypatch.setattr(M, "TREE_ROWS_LEAST", 10)
    cores, seen = spark.sparkContext.defaultParallelism, []
    for cls in (RandomForestRegressor, GBTClassifier):
        monkeypatch.setattr(cls, "fit", lambda self, rows, params=None: seen.append(_sizes(rows)))
    df = _uneven(spark, 1000 * cores)
    assert max(_sizes(df)) == 1000 * cores
    M.forest(df, "y", ["x", "z"], trees=2, max_depth=3)
    M.boosting(df, "y", ["x", "z"], iters=1, depth=2)
    for sizes in seen:
        assert len(sizes) == cores and sum(sizes) == 1000 * cores
        assert max(sizes) < 1100
    assert len(seen) == 2


def test_few_rows_of_a_tree_fit_stay_as_they_lie(spark):
    df = _uneven(spark, 400)
    assert _sizes(M.tree_rows(df, "y", ["x", "z"])) == _sizes(M.fit_rows(df, "y", ["x", "z"]))


def test_forest_settings_leave_the_trees_as_they_are(spark):
    from pyspark.ml.regression import RandomForestRegressor

    df = _uneven(spark, 3000)
    got = M.forest(df, "x", ["z", "y"], trees=5, max_depth=6)
    plain = RandomForestRegressor(featuresCol="features", labelCol="x", numTrees=5, maxDepth=6, maxBins=64, seed=42,
                                  featureSubsetStrategy="all").fit(M.fit_rows(df, "x", ["z", "y"]))
    assert got.getCacheNodeIds() and not plain.getCacheNodeIds()
    assert got.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]


def test_a_level_of_a_forest_is_one_pass_over_the_rows(spark):
    sc, xs = spark.sparkContext, ["a", "b", "c", "d", "e"]
    df = spark.range(0, 6000, 1, 2).select(*[(F.xxhash64("id", F.lit(x)) % 1000).cast("double").alias(x) for x in [*xs, "y"]]).persist()
    df.count()

    def jobs(depth):
        sc.setJobGroup(group := f"forest of depth {depth}", "")
        M.forest(df, "y", xs, trees=20, max_depth=depth)
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(group))

    try:
        assert jobs(10) - jobs(4) == 6
    finally:
        df.unpersist()
