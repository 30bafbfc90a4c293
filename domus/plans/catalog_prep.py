"""Registered queries: preparation pipeline and its operators (S, P, J, A, O, U, Q1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from domus.operators import aggregates as A
from domus.operators import frames as P
from domus.operators import joins as J
from domus.plans import composite as C
from domus.plans.registry import oracle, register, rounded
from domus.sources import fixtures as fx

# Fixed parameters of the registered queries (FIXTURES.md, suggested values).
SINCE = "1996-01-01"
MIN_COUNT = 4
DEPT_Q = 0.25
TOP_REGIONS = 3
PCT_BELOW = 0.1

SURF = P.SURFACE_COLUMNS

BASE_CTE = f"""base AS (
  SELECT * EXCLUDE ({", ".join(SURF)}),
         CAST(month(transaction_date) AS INT) AS transaction_month,
         CAST(year(transaction_date) AS INT) AS transaction_year,
         price / NULLIF(living_area, 0) AS price_per_m2
  FROM tx
  WHERE transaction_date >= DATE '{SINCE}'
    AND {" AND ".join(f"{c} = '{{}}'" for c in SURF)}
)"""

KEYS5 = "department, city, city_id, transaction_year, transaction_month"

STATS_CTE = f"""stats_all AS (
  SELECT {KEYS5}, avg(price_per_m2) AS avg_price_per_m2,
         count(price_per_m2) AS num_transactions_month
  FROM base GROUP BY {KEYS5}
)"""

KEPT_CTE = f"""kept AS (SELECT * FROM stats_all WHERE num_transactions_month > {MIN_COUNT})"""

LABELLED_CTE = f"""labelled AS (
  SELECT b.*, k.avg_price_per_m2, k.num_transactions_month,
         CASE WHEN b.price_per_m2 < k.avg_price_per_m2 - {PCT_BELOW}E0 * k.avg_price_per_m2
              THEN 1 ELSE 0 END AS below_market
  FROM base b JOIN kept k USING ({KEYS5})
)"""

PREP_VIEWS = ["tx", BASE_CTE, STATS_CTE, KEPT_CTE, LABELLED_CTE]

BASE_DOUBLES = ["price", "living_area", "latitude", "longitude", "price_per_m2"]


def base(spark, d):
    return C.prepared_base(fx.tx(spark, d), SINCE)


def kept_stats(spark, d):
    kept, _ = A.city_month_stats(base(spark, d), min_count=MIN_COUNT)
    return kept


def labelled(spark, d):
    return C.labelled_transactions(fx.tx(spark, d), SINCE, MIN_COUNT, PCT_BELOW)


# ---------------------------------------------------------------- minimum slice
@register("slice_label_share_by_department", oracle(
    """SELECT department, count(*) AS num_rows, avg(CAST(below_market AS DOUBLE)) AS label_share
       FROM labelled GROUP BY department""",
    PREP_VIEWS, ["label_share"]))
def slice_label_share_by_department(spark, d):
    lab = labelled(spark, d)
    return rounded(lab.groupBy("department").agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.avg(F.col("below_market").cast("double")).alias("label_share")))


# ---------------------------------------------------------------- Q1
Q1_SQL = f"""
dept AS (SELECT department, count(*) AS n FROM labelled GROUP BY department),
thr AS (SELECT quantile_disc(n, {DEPT_Q}E0) AS t FROM dept),
kept_dept AS (SELECT department FROM dept, thr WHERE n > t),
reg AS (SELECT department_code, department_name, region_code, region_name,
               CAST(department_code AS INT) AS department, CAST(region_code AS INT) AS region
        FROM regions),
joined AS (
  SELECT l.*, r.department_code, r.department_name, r.region_code, r.region_name, r.region
  FROM labelled l JOIN kept_dept USING (department) LEFT JOIN reg r USING (department)),
top AS (SELECT region FROM joined WHERE region IS NOT NULL GROUP BY region
        ORDER BY count(*) DESC, region LIMIT {TOP_REGIONS})"""


@register("q1_prepare_transactions", oracle(
    "SELECT * FROM joined WHERE region IN (SELECT region FROM top)",
    PREP_VIEWS + ["regions", Q1_SQL.strip()],
    BASE_DOUBLES + ["avg_price_per_m2"]))
def q1_prepare_transactions(spark, d):
    out, _ = C.prepare_transactions(fx.tx(spark, d), fx.regions(spark, d), SINCE, MIN_COUNT,
                                    PCT_BELOW, DEPT_Q, TOP_REGIONS)
    return rounded(out)


# ---------------------------------------------------------------- S: sources / sinks
@register("s1_read_table", oracle(
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
    [], ["o_totalprice"]))
def s1_read_table(spark, d):
    from domus.sources.io import read_table

    df = read_table(spark, f"{d}/orders.parquet",
                    columns=["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"])
    return rounded(df)


@register("s2_read_csv", oracle(
    "SELECT * FROM regions", ["regions"]))
def s2_read_csv(spark, d):
    """Land the region dimension as CSV in the shared scratch folder, read it
    back with a declared schema."""
    import uuid

    from pyspark.sql.types import StringType, StructField, StructType

    from domus.session import checkpoint_dir
    from domus.sources.io import read_csv

    path = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    fx.regions(spark, d).write.mode("overwrite").option("header", "true").csv(path)
    schema = StructType([StructField(c, StringType()) for c in
                         ["department_code", "department_name", "region_code", "region_name"]])
    return read_csv(spark, path, schema)


@register("s3_write_table", oracle(
    "SELECT transaction_id, transaction_year, price_per_m2 FROM base",
    ["tx", BASE_CTE], ["price_per_m2"]))
def s3_write_table(spark, d):
    """Write the prepared rows partitioned by year, read them back."""
    import uuid

    from domus.session import checkpoint_dir
    from domus.sources.io import read_table, write_table

    path = f"{checkpoint_dir(spark)}/tx-{uuid.uuid4().hex}"
    write_table(base(spark, d).select("transaction_id", "transaction_year", "price_per_m2"),
                path, partition_by=["transaction_year"])
    back = read_table(spark, path)
    return rounded(back.withColumn("transaction_year", F.col("transaction_year").cast("int")))


# ---------------------------------------------------------------- P: projections / filters
@register("p1_add_ratio", oracle(
    "SELECT transaction_id, price_per_m2 FROM base", ["tx", BASE_CTE], ["price_per_m2"]))
def p1_add_ratio(spark, d):
    return rounded(base(spark, d).select("transaction_id", "price_per_m2"))


@register("p2_filter_since", oracle(
    f"""SELECT CAST(year(transaction_date) AS INT) AS y, count(*) AS n FROM tx
        WHERE transaction_date >= DATE '{SINCE}' GROUP BY 1""", ["tx"]))
def p2_filter_since(spark, d):
    df = P.filter_since(fx.tx(spark, d), "transaction_date", F.to_date(F.lit(SINCE)))
    return df.groupBy(F.year("transaction_date").cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n"))


@register("p3_keep_plain_rows", oracle(
    f"""SELECT transaction_id, department, building_type FROM tx
        WHERE {" AND ".join(f"{c} = '{{}}'" for c in SURF)}""", ["tx"]))
def p3_keep_plain_rows(spark, d):
    return P.keep_plain_rows(fx.tx(spark, d)).select("transaction_id", "department", "building_type")


@register("p4_equality_filter_projection", oracle(
    "SELECT transaction_id, living_area, num_rooms, price FROM base WHERE department = 7",
    ["tx", BASE_CTE], ["living_area", "price"]))
def p4_equality_filter_projection(spark, d):
    b = base(spark, d)
    return rounded(b.where(F.col("department") == 7).select("transaction_id", "living_area", "num_rooms", "price"))


@register("p5_between", oracle(
    """SELECT transaction_id, transaction_date FROM base
       WHERE transaction_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""", ["tx", BASE_CTE]))
def p5_between(spark, d):
    b = base(spark, d)
    return P.between(b, "transaction_date", F.to_date(F.lit("1997-01-01")),
                     F.to_date(F.lit("1997-12-31"))).select("transaction_id", "transaction_date")


@register("p6_keep_members", oracle(
    """SELECT transaction_id, department FROM base
       WHERE department IN (SELECT CAST(department_code AS INT) FROM regions WHERE region_name = 'EUROPE')""",
    ["tx", "regions", BASE_CTE]))
def p6_keep_members(spark, d):
    members = (fx.regions(spark, d).where(F.col("region_name") == "EUROPE")
               .select(F.col("department_code").cast("int").alias("department")))
    return P.keep_members(base(spark, d), "department", members).select("transaction_id", "department")


@register("p7_exclude_values", oracle(
    "SELECT transaction_id, building_type FROM base WHERE building_type NOT IN ('ECONOMY', 'STANDARD')",
    ["tx", BASE_CTE]))
def p7_exclude_values(spark, d):
    return P.exclude_values(base(spark, d), "building_type", ["ECONOMY", "STANDARD"]).select(
        "transaction_id", "building_type")


@register("p8_filter_above_quantile", oracle(
    """SELECT transaction_id, price FROM base
       WHERE price > (SELECT quantile_disc(price, 0.75E0) FROM base) AND building_type = 'PROMO'""",
    ["tx", BASE_CTE], ["price"]))
def p8_filter_above_quantile(spark, d):
    out = P.filter_above_quantile(base(spark, d), "price", 0.75, where=F.col("building_type") == "PROMO")
    return rounded(out.select("transaction_id", "price"))


@register("p8_cities_above_quantile", oracle(
    """WITH mins AS (SELECT department, city, city_id, min(num_transactions_month) AS m
                     FROM stats_all GROUP BY department, city, city_id),
            top AS (SELECT * FROM mins WHERE m > (SELECT quantile_disc(m, 0.75E0) FROM mins))
       SELECT 'min_num_transactions_month' AS "column", count(m) AS count,
              CAST(sum(CASE WHEN m IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
              avg(m) AS mean, stddev_samp(m) AS std, CAST(min(m) AS DOUBLE) AS min,
              quantile_cont(m, 0.25E0) AS q25, quantile_cont(m, 0.5E0) AS q50, quantile_cont(m, 0.75E0) AS q75,
              CAST(max(m) AS DOUBLE) AS max FROM top""",
    ["tx", BASE_CTE, STATS_CTE], ["mean", "std", "q25", "q50", "q75"], 6))
def p8_cities_above_quantile(spark, d):
    """Cities whose smallest monthly count is above the 0.75-quantile of
    those minima, described (the exploratory step of the preparation)."""
    _, all_groups = A.city_month_stats(base(spark, d), min_count=MIN_COUNT)
    mins = A.city_min_monthly_count(all_groups)
    top = P.filter_above_quantile(mins, "min_num_transactions_month", 0.75)
    return rounded(A.describe_columns(top, ["min_num_transactions_month"]), 6)


LAGGED_CTE = f"""lagged AS (
  SELECT *, lag(avg_price_per_m2) OVER (PARTITION BY department, city, city_id
                                        ORDER BY transaction_year, transaction_month) AS prev_avg
  FROM kept)"""


@register("p9_drop_incomplete", oracle(
    f"""SELECT {KEYS5}, avg_price_per_m2, num_transactions_month, prev_avg FROM lagged
        WHERE prev_avg IS NOT NULL AND NOT isnan(prev_avg) AND NOT isnan(avg_price_per_m2)""",
    ["tx", BASE_CTE, STATS_CTE, KEPT_CTE, LAGGED_CTE], ["avg_price_per_m2", "prev_avg"]))
def p9_drop_incomplete(spark, d):
    from domus.operators.windows import add_lag

    lagged = add_lag(kept_stats(spark, d), {"avg_price_per_m2": "prev_avg"}, A.CITY_KEY,
                     ["transaction_year", "transaction_month"])
    return rounded(P.drop_incomplete(lagged))


@register("p10_cast_columns", oracle(
    """SELECT transaction_id, CAST(department AS VARCHAR) AS department,
              CAST(num_rooms AS BIGINT) AS num_rooms FROM base""", ["tx", BASE_CTE]))
def p10_cast_columns(spark, d):
    out = P.cast_columns(base(spark, d), {"department": "string", "num_rooms": "bigint"})
    return out.select("transaction_id", "department", "num_rooms")


@register("p11_split_metadata", oracle(
    """SELECT * EXCLUDE (transaction_date, city_id, city, department, price_per_m2, avg_price_per_m2)
       FROM labelled""", PREP_VIEWS, ["price", "living_area", "latitude", "longitude"]))
def p11_split_metadata(spark, d):
    from domus.plans.composite import METADATA_COLUMNS

    features, _ = P.split_metadata(labelled(spark, d), METADATA_COLUMNS, "transaction_id")
    return rounded(features)


@register("p12_rename_columns", oracle(
    "SELECT transaction_id, price AS sale_price, living_area AS surface FROM base",
    ["tx", BASE_CTE], ["sale_price", "surface"]))
def p12_rename_columns(spark, d):
    out = P.rename_columns(base(spark, d), {"price": "sale_price", "living_area": "surface"})
    return rounded(out.select("transaction_id", "sale_price", "surface"))


@register("p13_below_reference_flag", oracle(
    f"""SELECT b.transaction_id,
               CASE WHEN b.price_per_m2 < k.avg_price_per_m2 - 0.2E0 * k.avg_price_per_m2
                    THEN 1 ELSE 0 END AS flag_20pct
        FROM base b JOIN kept k USING ({KEYS5})""", PREP_VIEWS[:4]))
def p13_below_reference_flag(spark, d):
    j = J.join_detail_aggregate(base(spark, d), kept_stats(spark, d), A.CITY_MONTH_KEY)
    return P.below_reference_flag(j, "price_per_m2", "avg_price_per_m2", 0.2, "flag_20pct").select(
        "transaction_id", "flag_20pct")


@register("p14_assign_period", oracle(
    """SELECT CASE WHEN strftime(transaction_date, '%Y-%m') < '1998-03' THEN 'pre'
                   WHEN strftime(transaction_date, '%Y-%m') <= '1999-07' THEN 'during'
                   ELSE 'post' END AS period, count(*) AS n
       FROM base GROUP BY 1""", ["tx", BASE_CTE]))
def p14_assign_period(spark, d):
    out = P.assign_period(base(spark, d), "transaction_date", "1998-03", "1999-07")
    return out.groupBy("period").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- J: joins
@register("j1_join_detail_aggregate", oracle(
    "SELECT transaction_id, avg_price_per_m2, num_transactions_month FROM labelled",
    PREP_VIEWS, ["avg_price_per_m2"]))
def j1_join_detail_aggregate(spark, d):
    return rounded(labelled(spark, d).select("transaction_id", "avg_price_per_m2", "num_transactions_month"))


@register("j3_join_on_date", oracle(
    "SELECT * FROM debt_ratio JOIN financial_assets USING (date)",
    ["debt_ratio", "financial_assets"],
    ["debt_ratio", "euros_per_capita", "bank_deposit_share", "life_insurance_share"]))
def j3_join_on_date(spark, d):
    return rounded(J.join_on_date(fx.debt_ratio(spark, d), fx.financial_assets(spark, d)))


@register("j4_add_region", oracle(
    """SELECT b.transaction_id, b.department, r.region_name, CAST(r.region_code AS INT) AS region
       FROM base b LEFT JOIN regions r ON b.department = CAST(r.department_code AS INT)""",
    ["tx", "regions", BASE_CTE]))
def j4_add_region(spark, d):
    out = J.add_region(base(spark, d), fx.regions(spark, d))
    return out.select("transaction_id", "department", "region_name", "region")


@register("j7_restrict_to_scope", oracle(
    """SELECT CAST(department AS INT) AS department, city_id, city, n_foyers_fiscaux, revenu_fiscal_moyen
       FROM tax_households
       WHERE (CAST(department AS INT), city_id) IN (SELECT DISTINCT department, city_id FROM kept)""",
    ["tx", BASE_CTE, STATS_CTE, KEPT_CTE, "tax_households"], ["revenu_fiscal_moyen"]))
def j7_restrict_to_scope(spark, d):
    scope = kept_stats(spark, d).select("department", "city_id")
    out = J.restrict_to_scope(fx.tax_households(spark, d), scope,
                              ["department", "city_id", "city", "n_foyers_fiscaux", "revenu_fiscal_moyen"],
                              casts={"department": "int"})
    return rounded(out)


@register("j8_attach_metadata", oracle(
    """SELECT l.transaction_id, l.below_market, t.transaction_date, t.city
       FROM labelled l LEFT JOIN tx t USING (transaction_id)""", PREP_VIEWS))
def j8_attach_metadata(spark, d):
    lab = labelled(spark, d).select("transaction_id", "below_market")
    return J.attach_metadata(lab, fx.tx(spark, d), "transaction_id", ["transaction_date", "city"])


# ---------------------------------------------------------------- A: aggregations
@register("a1_city_month_stats", oracle(
    "SELECT * FROM kept", ["tx", BASE_CTE, STATS_CTE, KEPT_CTE], ["avg_price_per_m2"]))
def a1_city_month_stats(spark, d):
    return rounded(kept_stats(spark, d))


@register("a2_city_min_monthly_count", oracle(
    """SELECT department, city, city_id, min(num_transactions_month) AS min_num_transactions_month
       FROM stats_all GROUP BY department, city, city_id""", ["tx", BASE_CTE, STATS_CTE]))
def a2_city_min_monthly_count(spark, d):
    _, all_groups = A.city_month_stats(base(spark, d), min_count=MIN_COUNT)
    return A.city_min_monthly_count(all_groups)


@register("a2_city_coverage", oracle(
    """SELECT k.kept_cities, a.all_cities, 100.0E0 * k.kept_cities / a.all_cities AS pct_cities
       FROM (SELECT count(*) AS kept_cities FROM (SELECT DISTINCT department, city, city_id FROM kept)) k,
            (SELECT count(*) AS all_cities FROM (SELECT DISTINCT department, city, city_id FROM stats_all)) a""",
    ["tx", BASE_CTE, STATS_CTE, KEPT_CTE], ["pct_cities"]))
def a2_city_coverage(spark, d):
    kept, all_groups = A.city_month_stats(base(spark, d), min_count=MIN_COUNT)
    return rounded(A.city_coverage(kept, all_groups))


@register("a3_group_share", oracle(
    f"""SELECT {KEYS5}, 100.0E0 * (CAST(num_transactions_month AS DOUBLE)
              / sum(num_transactions_month) OVER (PARTITION BY department, transaction_year, transaction_month))
              AS city_transaction_ratio
        FROM kept""", ["tx", BASE_CTE, STATS_CTE, KEPT_CTE], ["city_transaction_ratio"]))
def a3_group_share(spark, d):
    out = A.group_share(kept_stats(spark, d), "num_transactions_month",
                        ["department", "transaction_year", "transaction_month"], "city_transaction_ratio")
    return rounded(out.drop("avg_price_per_m2", "num_transactions_month"))


@register("a4_quantile", oracle(
    """SELECT 0.1E0 AS q, quantile_disc(price, 0.1E0) AS value FROM base
       UNION ALL SELECT 0.5E0, quantile_disc(price, 0.5E0) FROM base
       UNION ALL SELECT 0.9E0, quantile_disc(price, 0.9E0) FROM base
       UNION ALL SELECT 0.25E0, quantile_disc(price_per_m2, 0.25E0) FROM base""",
    ["tx", BASE_CTE], ["value"]))
def a4_quantile(spark, d):
    b = base(spark, d)
    parts = [A.quantile(b, "price", q).select(F.lit(q).alias("q"), "value") for q in (0.1, 0.5, 0.9)]
    parts.append(A.quantile(b, "price_per_m2", 0.25).select(F.lit(0.25).alias("q"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out)


@register("a4_quantile_linear", oracle(
    "SELECT quantile_cont(price, 0.5E0) AS median_price FROM base", ["tx", BASE_CTE],
    ["median_price"], overrides={"median_price": 4}))
def a4_quantile_linear(spark, d):
    out = A.quantile(base(spark, d), "price", 0.5, method="linear").withColumnRenamed("value", "median_price")
    return rounded(out, overrides={"median_price": 4})


@register("a5_value_counts", oracle(
    "SELECT department, building_type, count(*) AS count FROM base GROUP BY ALL", ["tx", BASE_CTE]))
def a5_value_counts(spark, d):
    return A.value_counts(base(spark, d), ["department", "building_type"])


@register("a6_class_evolution", oracle(
    """SELECT strftime(transaction_date, '%Y-%m') AS period, below_market, count(*) AS count
       FROM labelled GROUP BY ALL""", PREP_VIEWS))
def a6_class_evolution(spark, d):
    lab = labelled(spark, d).withColumn("period", F.date_format("transaction_date", "yyyy-MM"))
    return A.class_evolution(lab, "period", "below_market")


@register("a6_class_evolution_pivot", oracle(
    """SELECT strftime(transaction_date, '%Y-%m') AS period,
              count(*) FILTER (WHERE below_market = 0) AS "0",
              count(*) FILTER (WHERE below_market = 1) AS "1"
       FROM labelled GROUP BY ALL""", PREP_VIEWS))
def a6_class_evolution_pivot(spark, d):
    lab = labelled(spark, d).withColumn("period", F.date_format("transaction_date", "yyyy-MM"))
    return A.class_evolution(lab, "period", "below_market", pivot_values=[0, 1])


@register("a7_drop_small_groups", oracle(
    """SELECT department, n AS count FROM
         (SELECT department, count(*) AS n FROM labelled GROUP BY department)
       WHERE n > (SELECT quantile_disc(n, 0.25E0) FROM
                    (SELECT count(*) AS n FROM labelled GROUP BY department))""", PREP_VIEWS))
def a7_drop_small_groups(spark, d):
    _, kept = A.drop_small_groups(labelled(spark, d), "department", DEPT_Q)
    return kept


@register("a7_drop_small_groups_rows", oracle(
    """SELECT transaction_id, department FROM labelled WHERE department IN (
         SELECT department FROM (SELECT department, count(*) AS n FROM labelled GROUP BY department)
         WHERE n > (SELECT quantile_disc(n, 0.25E0) FROM
                      (SELECT count(*) AS n FROM labelled GROUP BY department)))""", PREP_VIEWS))
def a7_drop_small_groups_rows(spark, d):
    rows, _ = A.drop_small_groups(labelled(spark, d), "department", DEPT_Q)
    return rows.select("transaction_id", "department")


DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT building_type, '{c}' AS "column", count({c}) AS count,
               CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
               avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
               quantile_cont({c}, 0.25E0) AS q25, quantile_cont({c}, 0.5E0) AS q50,
               quantile_cont({c}, 0.75E0) AS q75, CAST(max({c}) AS DOUBLE) AS max
        FROM base GROUP BY building_type""" for c in ["price", "living_area", "price_per_m2"])


@register("a8_describe_columns", oracle(
    DESCRIBE_SQL, ["tx", BASE_CTE], ["mean", "std", "min", "q25", "q50", "q75", "max"], digits=6))
def a8_describe_columns(spark, d):
    out = A.describe_columns(base(spark, d), ["price", "living_area", "price_per_m2"], by=["building_type"])
    return rounded(out, 6)


@register("a9_group_series", oracle(
    f"""SELECT {KEYS5}, avg_price_per_m2, num_transactions_month,
          lag(avg_price_per_m2) OVER w AS avg_price_per_m2_lag,
          CASE WHEN count(avg_price_per_m2) OVER w6 = 6 THEN avg(avg_price_per_m2) OVER w6 END
            AS avg_price_per_m2_rolling_6
        FROM kept
        WINDOW w AS (PARTITION BY department, city, city_id ORDER BY transaction_year, transaction_month),
               w6 AS (PARTITION BY department, city, city_id ORDER BY transaction_year, transaction_month
                      ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    ["tx", BASE_CTE, STATS_CTE, KEPT_CTE],
    ["avg_price_per_m2", "avg_price_per_m2_lag", "avg_price_per_m2_rolling_6"]))
def a9_group_series(spark, d):
    out = A.group_series(kept_stats(spark, d), A.CITY_KEY, ["transaction_year", "transaction_month"],
                         lags={"avg_price_per_m2": "avg_price_per_m2_lag"},
                         rolling={"avg_price_per_m2": "avg_price_per_m2_rolling_6"})
    return rounded(out)


CORR_COLS = ["price", "living_area", "num_rooms", "latitude", "longitude", "price_per_m2"]
CORR_SQL = " UNION ALL ".join(
    f"""SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r,
               count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n FROM base"""
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:])


@register("a10_correlation_pairs", oracle(CORR_SQL, ["tx", BASE_CTE], ["r"], digits=6))
def a10_correlation_pairs(spark, d):
    return rounded(A.correlation_pairs(base(spark, d), CORR_COLS), 6)


@register("a11_strong_pairs", oracle(
    f"SELECT a, b, r, n FROM ({CORR_SQL}) WHERE abs(r) > 0.3E0", ["tx", BASE_CTE], ["r"], digits=6))
def a11_strong_pairs(spark, d):
    return rounded(A.strong_pairs(A.correlation_pairs(base(spark, d), CORR_COLS), 0.3), 6)


def _prune_sql() -> str:
    """Greedy keep-first, one step per column: kept unless strongly correlated with a kept one."""
    n = range(len(CORR_COLS))
    pair = lambda i, j: f"max(CASE WHEN a = '{CORR_COLS[j]}' AND b = '{CORR_COLS[i]}' AND abs(r) > 0.3E0 THEN 1 ELSE 0 END) AS s_{i}_{j}"
    ctes = [f"prs AS ({CORR_SQL})", "k AS (SELECT " + ", ".join(pair(i, j) for i in n for j in range(i)) + " FROM prs)"]
    last = "k"
    for i in n:
        lost = " + ".join([f"s_{i}_{j} * kept_{j}" for j in range(i)] or ["0"])
        ctes.append(f"k{i} AS (SELECT *, CASE WHEN {lost} > 0 THEN 0 ELSE 1 END AS kept_{i} FROM {last})")
        last = f"k{i}"
    place = lambda i: " + ".join([f"kept_{j}" for j in range(i)] or ["0"])
    rows = " UNION ALL ".join(f"SELECT CAST({place(i)} AS INT) AS position, '{CORR_COLS[i]}' AS feature FROM {last} WHERE kept_{i} = 1" for i in n)
    return "WITH " + ",\n".join(ctes) + "\n" + rows


@register("a11_prune_correlated", oracle(_prune_sql(), ["tx", BASE_CTE]))
def a11_prune_correlated(spark, d):
    """Greedy keep-first pruning over the pair table (schema-sized)."""
    kept = A.prune_correlated(A.correlation_pairs(base(spark, d), CORR_COLS), CORR_COLS, 0.3)
    return spark.createDataFrame([(i, f) for i, f in enumerate(kept)], "position int, feature string")


# ---------------------------------------------------------------- O: sorts / top-k
@register("o1_sort_rows", oracle(
    f"SELECT * FROM kept ORDER BY {KEYS5}", ["tx", BASE_CTE, STATS_CTE, KEPT_CTE], ["avg_price_per_m2"]))
def o1_sort_rows(spark, d):
    return rounded(A.sort_rows(kept_stats(spark, d), A.CITY_MONTH_KEY))


@register("o2_keep_top_groups", oracle(
    """SELECT transaction_id, building_type FROM base WHERE building_type IN (
         SELECT building_type FROM base GROUP BY building_type
         ORDER BY count(*) DESC, building_type LIMIT 3)""", ["tx", BASE_CTE]))
def o2_keep_top_groups(spark, d):
    return A.keep_top_groups(base(spark, d), "building_type", 3).select("transaction_id", "building_type")


@register("o3_head", oracle(
    "SELECT transaction_id, price FROM base ORDER BY price DESC, transaction_id LIMIT 20",
    ["tx", BASE_CTE], ["price"]))
def o3_head(spark, d):
    b = base(spark, d).select("transaction_id", "price")
    return rounded(b.orderBy(F.col("price").desc(), "transaction_id").limit(20))


@register("o4_sort_desc", oracle(
    "SELECT department, count(*) AS count FROM base GROUP BY department ORDER BY count DESC, department",
    ["tx", BASE_CTE]))
def o4_sort_desc(spark, d):
    return A.value_counts(base(spark, d), "department").orderBy(F.col("count").desc(), "department")


@register("o5_best_by", oracle(
    """SELECT run_id, experiment, status, average_test_f1, num_rows FROM (
         SELECT *, row_number() OVER (PARTITION BY experiment
                                      ORDER BY average_test_f1 DESC NULLS LAST, run_id) AS rn
         FROM runs WHERE status = 'FINISHED') WHERE rn = 1""", ["runs"], ["average_test_f1"]))
def o5_best_by(spark, d):
    r = fx.runs(spark, d).where(F.col("status") == "FINISHED")
    return rounded(A.best_by(r, ["experiment"], "average_test_f1", tie="run_id"))


@register("o6_sample_rows", oracle(
    """SELECT transaction_id, price FROM base
       ORDER BY (transaction_id % 1000003) * 7919 % 1000003, transaction_id LIMIT 100""",
    ["tx", BASE_CTE], ["price"]))
def o6_sample_rows(spark, d):
    from domus.operators.splits import portable_hash

    b = base(spark, d).select("transaction_id", "price")
    return rounded(A.sample_rows(b, 100, "transaction_id", pick=portable_hash("transaction_id", 0)))


@register("o6_sample_columns", oracle(
    " ".join(["WITH"] + [",".join(
        f"""s{j} AS (SELECT CAST(row_number() OVER (ORDER BY ((transaction_id % 1000003) * 7919 + {42 + j}) % 1000003,
                                              transaction_id) - 1 AS INT) AS slot, {c}
                   FROM base ORDER BY ((transaction_id % 1000003) * 7919 + {42 + j}) % 1000003, transaction_id
                   LIMIT 50)""" for j, c in enumerate(["price", "living_area", "building_type"]))]) +
    " SELECT s0.slot, price, living_area, building_type FROM s0 JOIN s1 USING (slot) JOIN s2 USING (slot)",
    ["tx", BASE_CTE], ["price", "living_area"]))
def o6_sample_columns(spark, d):
    out = A.sample_columns(base(spark, d), ["price", "living_area", "building_type"], 50, "transaction_id", 42)
    return rounded(out.withColumn("slot", F.col("slot").cast("int")))


# ---------------------------------------------------------------- U: labelled union
@register("u1_label_union", oracle(
    """SELECT "group", segment, count(*) AS n, avg(score) AS mean_score FROM (
         SELECT 'false_negative' AS "group", segment, score FROM scored_binary WHERE y = 1 AND prediction = 0
         UNION ALL SELECT 'all', segment, score FROM scored_binary) GROUP BY ALL""",
    ["scored_binary"], ["mean_score"]))
def u1_label_union(spark, d):
    from domus.operators.evaluation import label_union

    sb = fx.scored_binary(spark, d)
    u = label_union(sb, {"false_negative": (F.col("y") == 1) & (F.col("prediction") == 0),
                         "all": F.lit(True)})
    return rounded(u.groupBy("group", "segment").agg(F.count(F.lit(1)).alias("n"),
                                                    F.avg("score").alias("mean_score")))
