from domus.sources import io


def test_nan_is_null_on_ingest(spark, tmp_path):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, 1.5, None), (3, None, "c")], "i long, x double, s string")
    df.write.parquet(f"{tmp_path}/t")
    df.write.option("header", "true").csv(f"{tmp_path}/c")
    for got in (io.read_table(spark, f"{tmp_path}/t"), io.read_csv(spark, f"{tmp_path}/c", df.schema)):
        assert {r["i"]: r["x"] for r in got.collect()} == {1: None, 2: 1.5, 3: None} and got.columns == ["i", "x", "s"]
    kept = io.read_table(spark, f"{tmp_path}/t", nan_as_null=False).where("isnan(x)").collect()
    assert [r["i"] for r in kept] == [1]
    assert io.read_table(spark, f"{tmp_path}/t", columns=["s"]).columns == ["s"]
