"""Adapters from the driver tables to the transaction data model.

Each function returns a lazy DataFrame with the schema the operators expect
(see FIXTURES.md part B).  Only the columns a view needs are read, so the
Parquet scans carry a narrow ReadSchema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMPTY = "{}"
NOT_EMPTY = '{"a":1}'


# Declared schemas of the driver tables: no footer-inference job per read,
# and a type drift in the files fails fast instead of changing results.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def _row_id() -> F.Column:
    return ((((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_partkey"))
             * 10000) + F.col("l_suppkey"))


def _city_id() -> F.Column:
    return (F.col("c_nationkey") * 100 + F.ascii("c_mktsegment")).cast("int")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions (lineitem ⋈ orders ⋈ customer ⋈ part)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    part = table(spark, sf_dir, "part", "p_partkey", "p_type")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(cust, F.col("o_custkey") == cust.c_custkey)
         .join(part, F.col("l_partkey") == part.p_partkey))

    def marker(cond):
        return F.when(cond, F.lit(NOT_EMPTY)).otherwise(F.lit(EMPTY))

    pk = F.col("l_partkey") % 50
    return j.select(
        _row_id().alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.col("c_nationkey").alias("department"),
        F.col("c_mktsegment").alias("city"),
        _city_id().alias("city_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("living_area"),
        F.col("l_linenumber").alias("num_rooms"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).cast("int").alias("off_plan"),
        F.col("p_type").alias("building_type"),
        (F.lit(40.0) + F.col("c_nationkey") * F.lit(0.5) + F.col("l_discount")).alias("latitude"),
        (F.col("l_tax") * F.lit(10.0)).alias("longitude"),
        marker(pk == 0).alias("surface_terrains_nature"),
        marker(pk == 1).alias("surface_terrains_sols"),
        marker(pk == 2).alias("surface_terrains_agricoles"),
        marker(pk == 3).alias("surface_locaux_industriels"),
        marker(F.col("l_linenumber") == 7).alias("surface_dependances"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("department_code"),
        F.col("n_name").alias("department_name"),
        F.col("r_regionkey").cast("string").alias("region_code"),
        F.col("r_name").alias("region_name"),
    )


def _order_year() -> F.Column:
    return F.year("o_orderdate").cast("int")


def debt_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderdate", "o_totalprice")
    return (o.groupBy(_order_year().alias("date"))
            .agg((F.avg("o_totalprice") / F.lit(10000.0)).alias("debt_ratio")))


def financial_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderdate", "o_totalprice", "o_custkey", "o_orderpriority")

    def share(v):
        return F.avg(F.when(F.col("o_orderpriority") == v, F.lit(1.0)).otherwise(F.lit(0.0)))

    return o.groupBy(_order_year().alias("date")).agg(
        (F.sum("o_totalprice") / F.countDistinct("o_custkey")).alias("euros_per_capita"),
        share("1-URGENT").alias("bank_deposit_share"),
        share("2-HIGH").alias("life_insurance_share"),
    )


def _month_start(c: str) -> F.Column:
    return F.trunc(F.col(c).cast("date"), "month")


def interest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_shipdate", "l_discount")
    return (li.groupBy(_month_start("l_shipdate").alias("date"))
            .agg((F.avg("l_discount") * F.lit(100.0)).alias("taux")))


def new_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderdate")
    return (o.groupBy(_month_start("o_orderdate").alias("date"))
            .agg(F.count(F.lit(1)).alias("loans_million_eur")))


def rent_reference_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_shipdate", "l_tax")
    return (li.where(F.month("l_shipdate").isin(1, 4, 7, 10))
            .groupBy(_month_start("l_shipdate").alias("date"))
            .agg((F.avg("l_tax") * F.lit(100.0)).alias("IRL")))


def tax_households(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_nationkey", "c_mktsegment", "c_acctbal")
    return (c.groupBy("c_nationkey", "c_mktsegment")
            .agg(F.count(F.lit(1)).alias("n_foyers_fiscaux"),
                 F.avg("c_acctbal").alias("revenu_fiscal_moyen"))
            .select(F.col("c_nationkey").cast("string").alias("department"),
                    F.col("c_mktsegment").alias("city"),
                    _city_id().alias("city_id"),
                    "n_foyers_fiscaux", "revenu_fiscal_moyen"))


def scored_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_quantity", "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part", "p_partkey", "p_type", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey)
    return j.select(
        _row_id().alias("id"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").alias("x"),
        F.col("l_extendedprice").alias("y"),
        (F.col("p_retailprice") * F.col("l_quantity")).alias("prediction"),
    )


def scored_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
               "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    return li.select(
        _row_id().alias("id"),
        F.col("l_shipdate").cast("date").alias("d"),
        F.col("l_linestatus").alias("segment"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int").alias("y"),
        (F.col("l_quantity") / F.lit(50.0)).alias("score"),
        F.when(F.col("l_quantity") >= 40, 1).otherwise(0).cast("int").alias("prediction"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "user_id", "event_type", "value")
    return (e.groupBy("user_id", "event_type")
            .agg((F.avg("value") / F.lit(500.0)).alias("average_test_f1"),
                 F.count(F.lit(1)).alias("num_rows"))
            .select(F.col("user_id").alias("run_id"), F.col("event_type").alias("experiment"),
                    F.when(F.col("user_id") % 5 == 0, F.lit("FAILED"))
                    .otherwise(F.lit("FINISHED")).alias("status"),
                    "average_test_f1", "num_rows"))
