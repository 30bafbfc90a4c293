"""Registered queries: feature engineering (W, E, J2/J5/J6/J9/J10, Q2–Q5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from domus.operators import encoding as E
from domus.operators import joins as J
from domus.operators import windows as W
from domus.operators.splits import train_test_label
from domus.plans import composite as C
from domus.plans.catalog_prep import (BASE_CTE, DEPT_Q, KEPT_CTE, KEYS5, MIN_COUNT, PCT_BELOW, PREP_VIEWS,
                                      Q1_SQL, SINCE, STATS_CTE, TOP_REGIONS, base, kept_stats)
from domus.plans.registry import oracle, register, rounded
from domus.sources import fixtures as fx

# Fixed category lists (deterministic one-hot schema on the driver data).
BUILDING_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

STATS_VIEWS = ["tx", BASE_CTE, STATS_CTE, KEPT_CTE]
CITY_W = "PARTITION BY department, city, city_id ORDER BY transaction_year, transaction_month"

# ------------------------------------------------------------------ Q2 pieces
Q2_CTE = f"""shares AS (
  SELECT *, 100.0E0 * (CAST(num_transactions_month AS DOUBLE)
         / sum(num_transactions_month) OVER (PARTITION BY department, transaction_year, transaction_month)) AS _share
  FROM kept),
share_thr AS (SELECT quantile_disc(_share, 0.8E0) AS _t FROM shares),
flagged AS (SELECT s.* EXCLUDE (_share), CASE WHEN s._share > t._t THEN 1 ELSE 0 END AS city_requested
            FROM shares s, share_thr t),
city_feat_all AS (
  SELECT *, lag(avg_price_per_m2) OVER w AS avg_price_per_m2_previous_month,
         lag(num_transactions_month) OVER w AS num_transactions_previous_month,
         CASE WHEN count(avg_price_per_m2) OVER w6 = 6 THEN avg(avg_price_per_m2) OVER w6 END
           AS avg_price_per_m2_rolling_6m,
         CASE WHEN count(num_transactions_month) OVER w6 = 6 THEN avg(num_transactions_month) OVER w6 END
           AS num_transactions_rolling_6m
  FROM flagged
  WINDOW w AS ({CITY_W}), w6 AS ({CITY_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
city_feat AS (
  SELECT * FROM city_feat_all
  WHERE avg_price_per_m2_previous_month IS NOT NULL AND num_transactions_previous_month IS NOT NULL
    AND avg_price_per_m2_rolling_6m IS NOT NULL AND num_transactions_rolling_6m IS NOT NULL
    AND avg_price_per_m2 IS NOT NULL AND NOT isnan(avg_price_per_m2)
    AND NOT isnan(avg_price_per_m2_previous_month)
    AND NOT isnan(avg_price_per_m2_rolling_6m) AND NOT isnan(num_transactions_rolling_6m))"""

Q2_DOUBLES = ["avg_price_per_m2", "avg_price_per_m2_previous_month", "avg_price_per_m2_rolling_6m",
              "num_transactions_rolling_6m"]

# ------------------------------------------------------------------ Q3 pieces
Q3_CTE = """m_join AS (
  SELECT i.date, i.taux, n.loans_million_eur, CAST(year(i.date) AS INT) AS year,
         CAST(month(i.date) AS INT) AS month
  FROM interest_rate i JOIN new_loans n USING (date)),
r_idx AS (SELECT CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, IRL
          FROM rent_reference_index),
m_left AS (SELECT m.*, r.IRL FROM m_join m LEFT JOIN r_idx r USING (year, month)),
m_fill AS (
  SELECT date, taux AS interest_rate, loans_million_eur, year, month,
         last_value(IRL IGNORE NULLS) OVER (ORDER BY year, month
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rent_reference_index
  FROM m_left),
m_diff AS (
  SELECT *, interest_rate - lag(interest_rate) OVER (ORDER BY year, month) AS interest_rate_change,
         interest_rate - 2 * lag(interest_rate) OVER (ORDER BY year, month)
           + lag(interest_rate, 2) OVER (ORDER BY year, month) AS interest_rate_acceleration
  FROM m_fill),
monthly AS (
  SELECT *, avg(interest_rate_change) OVER (ORDER BY year * 12 + month
             RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS interest_rate_change_rolling_6m
  FROM m_diff)"""

Q3_VIEWS = ["interest_rate", "new_loans", "rent_reference_index", Q3_CTE]
Q3_DOUBLES = ["interest_rate", "rent_reference_index", "interest_rate_change", "interest_rate_acceleration",
              "interest_rate_change_rolling_6m"]

# ------------------------------------------------------------------ Q4 pieces
Q4_CTE = """a_join AS (SELECT * FROM debt_ratio JOIN financial_assets USING (date)),
annual AS (
  SELECT *, debt_ratio - lag(debt_ratio) OVER (ORDER BY date) AS debt_ratio_change,
         debt_ratio - 2 * lag(debt_ratio) OVER (ORDER BY date) + lag(debt_ratio, 2) OVER (ORDER BY date)
           AS debt_ratio_acceleration
  FROM a_join)"""

Q4_VIEWS = ["debt_ratio", "financial_assets", Q4_CTE]
Q4_DOUBLES = ["debt_ratio", "euros_per_capita", "bank_deposit_share", "life_insurance_share",
              "debt_ratio_change", "debt_ratio_acceleration"]


def monthly(spark, d):
    return C.monthly_macro(fx.interest_rate(spark, d), fx.new_loans(spark, d), fx.rent_reference_index(spark, d))


def annual(spark, d):
    return C.annual_macro(fx.debt_ratio(spark, d), fx.financial_assets(spark, d))


def city_feats(spark, d):
    return C.city_features(kept_stats(spark, d))


def prepared(spark, d):
    out, kept = C.prepare_transactions(fx.tx(spark, d), fx.regions(spark, d), SINCE, MIN_COUNT,
                                       PCT_BELOW, DEPT_Q, TOP_REGIONS)
    return out, kept


# ------------------------------------------------------------------ W
@register("w1_add_lag", oracle(
    f"""SELECT {KEYS5}, lag(avg_price_per_m2) OVER (PARTITION BY department, city, city_id
              ORDER BY transaction_year, transaction_month) AS prev_avg,
            CASE WHEN (transaction_year * 12 + transaction_month)
                      - lag(transaction_year * 12 + transaction_month) OVER (PARTITION BY department, city, city_id
                          ORDER BY transaction_year, transaction_month) = 1
                 THEN lag(avg_price_per_m2) OVER (PARTITION BY department, city, city_id
                          ORDER BY transaction_year, transaction_month) END AS prev_calendar_avg
        FROM kept""", STATS_VIEWS, ["prev_avg", "prev_calendar_avg"]))
def w1_add_lag(spark, d):
    k = kept_stats(spark, d)
    order = ["transaction_year", "transaction_month"]
    out = W.add_lag(k, {"avg_price_per_m2": "prev_avg"}, ["department", "city", "city_id"], order)
    out = W.add_lag(out, {"avg_price_per_m2": "prev_calendar_avg"}, ["department", "city", "city_id"], order,
                    calendar_index=W.month_index())
    return rounded(out.select(*KEYS5.split(", "), "prev_avg", "prev_calendar_avg"))


@register("w2_add_rolling_mean", oracle(
    f"""SELECT {KEYS5},
          CASE WHEN count(num_transactions_month) OVER w = 6 THEN avg(num_transactions_month) OVER w END
            AS rolling_count
        FROM kept WINDOW w AS ({CITY_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
    STATS_VIEWS, ["rolling_count"]))
def w2_add_rolling_mean(spark, d):
    out = W.add_rolling_mean(kept_stats(spark, d), {"num_transactions_month": "rolling_count"},
                             ["department", "city", "city_id"], ["transaction_year", "transaction_month"], 6)
    return rounded(out.select(*KEYS5.split(", "), "rolling_count"))


@register("w3_add_differences", oracle("SELECT * FROM annual", Q4_VIEWS, Q4_DOUBLES))
def w3_add_differences(spark, d):
    return rounded(annual(spark, d))


@register("w4_time_rolling_mean", oracle(
    "SELECT date, year, month, interest_rate_change_rolling_6m FROM monthly", Q3_VIEWS,
    ["interest_rate_change_rolling_6m"]))
def w4_time_rolling_mean(spark, d):
    return rounded(monthly(spark, d).select("date", "year", "month", "interest_rate_change_rolling_6m"))


@register("w4_date_rolling_mean", oracle(
    """WITH daily AS (SELECT CAST(l_shipdate AS DATE) AS d, avg(l_discount) AS discount FROM lineitem GROUP BY 1)
       SELECT d, discount,
              (sum(discount) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 MONTH PRECEDING AND CURRENT ROW)
               - coalesce(sum(discount) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 MONTH PRECEDING
                                                            AND INTERVAL 6 MONTH PRECEDING), 0))
              / CAST(count(discount) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 MONTH PRECEDING AND CURRENT ROW)
                     - coalesce(count(discount) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 MONTH PRECEDING
                                                                  AND INTERVAL 6 MONTH PRECEDING), 0) AS DOUBLE)
                AS discount_rolling_6m
       FROM daily""", [], ["discount", "discount_rolling_6m"], 6))
def w4_date_rolling_mean(spark, d):
    """Daily series (one row per shipping day) with a 6-calendar-month
    half-open rolling mean."""
    li = fx.table(spark, d, "lineitem", "l_shipdate", "l_discount")
    daily = li.groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(F.avg("l_discount").alias("discount"))
    return rounded(W.add_date_rolling_mean(daily, "discount", "d", 6), 6)


@register("w5_forward_fill", oracle(
    "SELECT date, year, month, rent_reference_index FROM monthly", Q3_VIEWS, ["rent_reference_index"]))
def w5_forward_fill(spark, d):
    return rounded(monthly(spark, d).select("date", "year", "month", "rent_reference_index"))


@register("w6_flag_top_quantile", oracle(
    f"SELECT {KEYS5}, city_requested FROM flagged", STATS_VIEWS + [Q2_CTE]))
def w6_flag_top_quantile(spark, d):
    return W.city_demand_flag(kept_stats(spark, d)).select(*KEYS5.split(", "), "city_requested")


@register("w7_select_by_cumulative_share", oracle(
    """SELECT building_type, n, share FROM (
         SELECT building_type, n, share,
                coalesce(sum(share) OVER (ORDER BY n DESC, building_type
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
         FROM (SELECT building_type, n, n / sum(n) OVER () AS share
               FROM (SELECT building_type, CAST(count(*) AS DOUBLE) AS n FROM base GROUP BY building_type)))
       WHERE before < 0.8E0""", ["tx", BASE_CTE], ["n", "share"]))
def w7_select_by_cumulative_share(spark, d):
    counts = base(spark, d).groupBy("building_type").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return rounded(W.select_by_cumulative_share(counts, "building_type", "n", 0.8))


# ------------------------------------------------------------------ J (feature side)
@register("j2_join_city_features", oracle(
    f"""SELECT l.transaction_id, c.city_requested, c.avg_price_per_m2_previous_month
        FROM labelled l JOIN city_feat c USING ({KEYS5})""",
    PREP_VIEWS + [Q2_CTE], ["avg_price_per_m2_previous_month"]))
def j2_join_city_features(spark, d):
    from domus.plans.catalog_prep import labelled

    city = city_feats(spark, d).drop("avg_price_per_m2", "num_transactions_month")
    out = J.join_detail_aggregate(labelled(spark, d), city, KEYS5.split(", "))
    return rounded(out.select("transaction_id", "city_requested", "avg_price_per_m2_previous_month"))


@register("j5_add_economic_context", oracle(
    """SELECT b.transaction_id, a.debt_ratio, a.debt_ratio_change, m.interest_rate, m.rent_reference_index
       FROM base b
       LEFT JOIN annual a ON b.transaction_year = a.date
       LEFT JOIN monthly m ON b.transaction_year = m.year AND b.transaction_month = m.month""",
    ["tx", BASE_CTE] + Q4_VIEWS + Q3_VIEWS,
    ["debt_ratio", "debt_ratio_change", "interest_rate", "rent_reference_index"]))
def j5_add_economic_context(spark, d):
    out = J.add_economic_context(base(spark, d), annual(spark, d), monthly(spark, d))
    return rounded(out.select("transaction_id", "debt_ratio", "debt_ratio_change", "interest_rate",
                              "rent_reference_index"))


@register("j6_left_join_quarterly", oracle(
    "SELECT date, year, month, IRL FROM m_left", Q3_VIEWS, ["IRL"]))
def j6_left_join_quarterly(spark, d):
    m = J.join_on_date(fx.interest_rate(spark, d), fx.new_loans(spark, d), "date")
    m = m.withColumns({"year": F.year("date"), "month": F.month("date")})
    r = fx.rent_reference_index(spark, d).select(F.year("date").alias("year"), F.month("date").alias("month"), "IRL")
    return rounded(J.join_small(m, r, ["year", "month"], "left").select("date", "year", "month", "IRL"))


@register("j9_group_total_share", oracle(
    f"""SELECT transaction_id, 100.0E0 * (price / sum(price) OVER (PARTITION BY {KEYS5})) AS share_of_city_month
        FROM base""", ["tx", BASE_CTE], ["share_of_city_month"]))
def j9_group_total_share(spark, d):
    from domus.operators.aggregates import group_share

    out = group_share(base(spark, d), "price", KEYS5.split(", "), "share_of_city_month")
    return rounded(out.select("transaction_id", "share_of_city_month"))


# ------------------------------------------------------------------ E
ONE_HOT_SQL = ", ".join(
    f"CASE WHEN building_type = '{v}' THEN 1 ELSE 0 END AS building_type_{E.slug(v)}" for v in BUILDING_TYPES)


@register("e1_one_hot", oracle(f"SELECT transaction_id, {ONE_HOT_SQL} FROM base", ["tx", BASE_CTE]))
def e1_one_hot(spark, d):
    b = base(spark, d).select("transaction_id", "building_type")
    return E.one_hot(b, "building_type")  # categories discovered by a small distinct job


@register("e2_reverse_one_hot", oracle(
    "SELECT transaction_id, lower(building_type) AS building_type FROM base", ["tx", BASE_CTE]))
def e2_reverse_one_hot(spark, d):
    b = base(spark, d).select("transaction_id", "building_type")
    return E.reverse_one_hot(E.one_hot(b, "building_type", BUILDING_TYPES), "building_type")


SPLIT_SQL = "CASE WHEN ((transaction_id % 1000003) * 7919 + 42) % 1000003 % 10000 < 2000 THEN 'test' ELSE 'train' END"


def _scaler_sql(kind: str) -> str:
    cols = ["price", "living_area"]
    if kind == "standard":
        stats = ", ".join(f"avg({c}) AS {c}_a, stddev_pop({c}) AS {c}_b" for c in cols)
        expr = ", ".join(f"({c} - {c}_a) / CASE WHEN {c}_b = 0 OR {c}_b IS NULL THEN 1.0E0 ELSE {c}_b END AS {c}"
                         for c in cols)
    else:
        stats = ", ".join(f"CAST(min({c}) AS DOUBLE) AS {c}_a, CAST(max({c}) AS DOUBLE) AS {c}_b" for c in cols)
        expr = ", ".join(f"({c} - {c}_a) / CASE WHEN {c}_b - {c}_a = 0 THEN 1.0E0 ELSE {c}_b - {c}_a END AS {c}"
                         for c in cols)
    return f"""SELECT s.transaction_id, s.split, {expr}
       FROM (SELECT transaction_id, price, living_area, {SPLIT_SQL} AS split FROM base) s,
            (SELECT {stats} FROM (SELECT * , {SPLIT_SQL} AS split FROM base) WHERE split = 'train') p"""


def _scaled(spark, d, kind):
    b = train_test_label(base(spark, d).select("transaction_id", "price", "living_area"), "transaction_id", 0.2, 42)
    train = b.where(F.col("split") == "train")
    params = E.fit_scaler(train, ["price", "living_area"], kind)
    return rounded(E.apply_scaler(b, params, ["price", "living_area"], kind), 6)


@register("e3_standard_scaler", oracle(_scaler_sql("standard"), ["tx", BASE_CTE], ["price", "living_area"], 6))
def e3_standard_scaler(spark, d):
    return _scaled(spark, d, "standard")


@register("e4_minmax_scaler", oracle(_scaler_sql("minmax"), ["tx", BASE_CTE], ["price", "living_area"], 6))
def e4_minmax_scaler(spark, d):
    return _scaled(spark, d, "minmax")


@register("e5_assemble", oracle(
    "SELECT transaction_id, [price, living_area, CAST(num_rooms AS DOUBLE)] AS features FROM base",
    ["tx", BASE_CTE]))
def e5_assemble(spark, d):
    from pyspark.ml.functions import vector_to_array

    v = E.assemble(base(spark, d).select("transaction_id", "price", "living_area", "num_rooms"),
                   ["price", "living_area", "num_rooms"])
    return v.select("transaction_id", vector_to_array("features").alias("features"))


@register("j10_slice_by_value", oracle(
    "SELECT transaction_id, price FROM base WHERE building_type = 'PROMO'", ["tx", BASE_CTE], ["price"]))
def j10_slice_by_value(spark, d):
    oh = E.one_hot(base(spark, d).select("transaction_id", "price", "building_type"), "building_type", BUILDING_TYPES)
    return rounded(J.slice_by_value(oh, "building_type_promo", 1).select("transaction_id", "price"))


# ------------------------------------------------------------------ Q2–Q5
@register("q2_city_features", oracle("SELECT * FROM city_feat", STATS_VIEWS + [Q2_CTE], Q2_DOUBLES))
def q2_city_features(spark, d):
    return rounded(city_feats(spark, d))


@register("q3_monthly_macro", oracle("SELECT * FROM monthly", Q3_VIEWS, Q3_DOUBLES))
def q3_monthly_macro(spark, d):
    return rounded(monthly(spark, d))


@register("q4_annual_macro", oracle("SELECT * FROM annual", Q4_VIEWS, Q4_DOUBLES))
def q4_annual_macro(spark, d):
    return rounded(annual(spark, d))


REGION_HOT_SQL = ", ".join(
    f"CASE WHEN region_name = '{v}' THEN 1 ELSE 0 END AS region_name_{E.slug(v)}" for v in REGION_NAMES)
Q5_NUMERIC = ["price", "living_area", "num_rooms", "off_plan", "latitude", "longitude", "transaction_month",
              "transaction_year", "below_market", "num_transactions_month", "city_requested",
              "avg_price_per_m2_previous_month", "num_transactions_previous_month", "avg_price_per_m2_rolling_6m",
              "num_transactions_rolling_6m", "debt_ratio", "euros_per_capita", "bank_deposit_share",
              "life_insurance_share", "debt_ratio_change", "debt_ratio_acceleration", "interest_rate",
              "loans_million_eur", "rent_reference_index", "interest_rate_change", "interest_rate_acceleration",
              "interest_rate_change_rolling_6m", "transaction_id"]
Q5_DOUBLES = ["price", "living_area", "latitude", "longitude", "avg_price_per_m2_previous_month",
              "avg_price_per_m2_rolling_6m", "num_transactions_rolling_6m"] + Q4_DOUBLES + Q3_DOUBLES

Q5_CTE = f"""prepared AS (SELECT * FROM joined WHERE region IN (SELECT region FROM top)),
eng AS (
  SELECT p.*, c.city_requested, c.avg_price_per_m2_previous_month, c.num_transactions_previous_month,
         c.avg_price_per_m2_rolling_6m, c.num_transactions_rolling_6m,
         a.debt_ratio, a.euros_per_capita, a.bank_deposit_share, a.life_insurance_share,
         a.debt_ratio_change, a.debt_ratio_acceleration,
         m.interest_rate, m.loans_million_eur, m.rent_reference_index, m.interest_rate_change,
         m.interest_rate_acceleration, m.interest_rate_change_rolling_6m
  FROM prepared p JOIN city_feat c USING ({KEYS5})
  LEFT JOIN annual a ON p.transaction_year = a.date
  LEFT JOIN monthly m ON p.transaction_year = m.year AND p.transaction_month = m.month),
features AS (
  SELECT {", ".join(Q5_NUMERIC)},
         {", ".join(f"CASE WHEN building_type = '{v}' THEN 1 ELSE 0 END AS building_type_{E.slug(v)}"
                    for v in BUILDING_TYPES)},
         {REGION_HOT_SQL}
  FROM eng
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in Q5_NUMERIC)}
    AND {" AND ".join(f"NOT isnan({c})" for c in Q5_DOUBLES)})"""


@register("q5_engineer_features", oracle(
    "SELECT * FROM features",
    PREP_VIEWS + ["regions", Q1_SQL.strip(), Q2_CTE] + Q4_VIEWS + Q3_VIEWS + [Q5_CTE], Q5_DOUBLES))
def q5_engineer_features(spark, d):
    tx, kept = prepared(spark, d)
    city = C.city_features(kept)
    features, _ = C.engineer_features(tx, city, annual(spark, d), monthly(spark, d), BUILDING_TYPES, REGION_NAMES)
    return rounded(features)
